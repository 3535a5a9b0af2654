"""Frequency dictionaries of string columns (M1), computed and kept as tables.

A value's index is its rank by frequency (most frequent 0, ties by the value's
bytes).  All columns are counted in one pass; the (value, count) rows are
range-sorted, numbered within each range, and each range's numbers are shifted
by the rows before it.  The driver sees one row per range and column, never a
value, so a column may have any number of them.  Indexes are joined back by
the value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagjoin.functions import scalar as S
from lagjoin.session import written

#: Dictionaries of at most this many values are small enough to broadcast.
SMALL = 10_000


@dataclass
class Dictionary:
    """``ranks`` (column, value, idx) of ``columns``; ``sizes``: how many
    values have an index of their own; ``limit``: categories at most."""

    columns: list[str]
    ranks: DataFrame
    sizes: dict[str, int]
    limit: int | None = None

    def transform(self, df: DataFrame, handle_invalid: str = "error") -> DataFrame:
        """Replace each column by its index (double).  A NULL, unknown or (by
        the limit) rare value is an error, an index of its own after all
        others ('keep'), or drops the row ('skip')."""
        if handle_invalid not in ("error", "keep", "skip"):
            raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
        out = df
        for k, c in enumerate(self.columns):
            known = self.ranks.where(F.col("column") == k).select(F.col("value").alias("__value"), F.col("idx").alias("__idx"))
            if self.limit is not None and self.limit <= SMALL:
                known = F.broadcast(known)  # fewer rows than the limit
            out = out.join(known, S.qcol(c).cast("string") == F.col("__value"), "left")
            own = F.col("__idx").cast("double")
            if handle_invalid == "keep":
                own = F.coalesce(own, F.lit(float(self.sizes[c])))
            elif handle_invalid == "skip":
                out = out.where(F.col("__idx").isNotNull())
            else:
                own = F.when(F.col("__idx").isNotNull(), own).otherwise(
                    F.raise_error(F.lit(f"column {c!r} holds a NULL or unknown value")))
            nominal = {"ml_attr": {"name": c, "type": "nominal", "num_vals": self.sizes[c] + 1}}
            own = own.alias(c, metadata=nominal) if self.limit is not None else own.alias(c)
            out = out.select(*[own if x == c else S.qcol(x) for x in df.columns])
        return out


def fit_dictionary(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> Dictionary:
    """The dictionary of ``df``'s columns.  ``limit``: the ``limit - 1`` most
    frequent values of a column keep an index of their own, all others share
    one with NULL, so no column has more than ``limit`` categories."""
    columns = list(columns)
    if limit is not None and limit < 2:
        raise ValueError(f"limit must be 2 or more, got {limit}")
    pairs = F.array(*[F.struct(F.lit(k).alias("column"), S.qcol(c).cast("string").alias("value"))
                      for k, c in enumerate(columns)])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").where("value is not null")
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    keys = [F.col("column"), F.col("n").desc(), F.col("value")]
    ordered = written(counts.repartitionByRange(*keys).sortWithinPartitions(*keys)
                      .withColumn("place", F.monotonically_increasing_id()), "dictionary")
    task = F.shiftright("place", 33).alias("task")
    ranges = ordered.groupBy("column", task).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("column").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranges.select("column", "task", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    ranks = (ordered.withColumn("task", task).join(shift, ["column", "task"])
             .select("column", "value", (F.col("shift") + F.col("place")).alias("idx")))
    sizes = {columns[r["column"]]: r["n"] for r in ordered.groupBy("column").agg(F.count("*").alias("n")).collect()}
    sizes = {c: sizes.get(c, 0) for c in columns}
    if limit is not None:
        ranks = ranks.where(F.col("idx") < limit - 1)
        sizes = {c: min(n, limit - 1) for c, n in sizes.items()}
    return Dictionary(columns, ranks, sizes, limit)
