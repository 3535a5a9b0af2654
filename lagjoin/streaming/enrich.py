"""Lag enrichment of a streaming fact source.

The long lag join is a stream-static LEFT join (facts stream on the left,
observation table static on the right), which Structured Streaming runs
per micro-batch without state: every arriving fact meets the frames of the
observation table and is fanned out over the lags.  A file sink with a
checkpoint location makes the output exactly-once and restartable after a
lost executor or driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lagjoin.operators.lagged import lag_join_long


def enrich_stream(facts_stream: DataFrame, obs: DataFrame, **lag_kwargs) -> DataFrame:
    """Streaming DataFrame of (fact, lag) rows with origin/destination
    observations; ``lag_kwargs`` as for :func:`lag_join_long`."""
    if not facts_stream.isStreaming:
        raise ValueError("facts_stream must be a streaming DataFrame")
    return lag_join_long(facts_stream, obs, **lag_kwargs)


def start_enrichment(facts_stream: DataFrame, obs: DataFrame, out_path: str, checkpoint: str,
                     available_now: bool = False, **lag_kwargs):
    """Start the enrichment into a parquet sink; returns the StreamingQuery."""
    w = (enrich_stream(facts_stream, obs, **lag_kwargs).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(out_path)


def enrich_available(facts_stream: DataFrame, obs: DataFrame, out_path: str, checkpoint: str,
                     timeout: float = 3600, **lag_kwargs) -> DataFrame:
    """Enrich everything that the stream holds now, and read the sink back as
    a batch DataFrame.  A run that does not end within ``timeout`` seconds is
    stopped and raises; its checkpoint lets the next run go on."""
    q = start_enrichment(facts_stream, obs, out_path, checkpoint, available_now=True, **lag_kwargs)
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"the enrichment was still running after {timeout} seconds")
    return facts_stream.sparkSession.read.parquet(out_path)
