"""Shard files are searched by blocks, against the tokens in memory."""

import io

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lagjoin.llm import jaccard, wavelet


class CountedReads(io.BytesIO):
    taken = 0

    def read(self, *size):
        data = super().read(*size)
        self.taken += len(data)
        return data


@pytest.mark.parametrize("n,top,bits", [(0, 5, 64), (1, 1, 64), (64, 9, 64), (65, 300, 64), (3000, 700, 512),
                                        (1024, 70_000, 512)])
def test_blocks_answer_like_the_tokens(n, top, bits):
    rng = np.random.default_rng(n)
    x = np.minimum(rng.zipf(1.3, n) - 1, top - 1).astype(np.uint32)
    data = wavelet.shard_bytes([1, None], np.array([n, 0]), x, bits)
    shard = wavelet.ShardFile(io.BytesIO(data), 3)
    ids, lengths = shard.documents()
    assert ids == [1, None] and lengths.tolist() == [n, 0]
    assert shard.values().tolist() == x.tolist()
    assert [shard.access(i) for i in range(n)] == x.tolist()
    for token in {0, 1, 2, top - 1, top + 9, 1 << 20}:
        at = np.flatnonzero(x == token)
        for lo, hi in ((0, n), (n // 3, n // 2), (0, bits if bits <= n else n)):
            assert shard.count(token, lo, hi) == (x[lo:hi] == token).sum()
        assert [shard.locate(token, k) for k in range(len(at))] == at.tolist()
        with pytest.raises(IndexError):
            shard.locate(token, len(at))
    for outside in (-1, n):
        with pytest.raises(IndexError):
            shard.access(outside)


def test_one_token_reads_a_small_part_of_the_file():
    x = np.random.default_rng(1).integers(0, 50_000, 2_000_000).astype(np.uint32)
    data = wavelet.shard_bytes([1], np.array([len(x)]), x)
    file = CountedReads(data)
    shard = wavelet.ShardFile(file)
    assert shard.access(1_234_567) == x[1_234_567]
    assert shard.count(int(x[0]), 10, 1_900_000) == (x[10:1_900_000] == x[0]).sum()
    assert shard.read_blocks <= 3 * 16 and file.taken < len(data) / 3


def test_corpus_counts_and_positions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    shards = wavelet.write_shards(docs, "doc_id", "text", shard_tokens=30_000)
    coder = wavelet.ByteEncoder(wavelet.tokenizer_path("byte_bpe_50k.json"))
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    every = np.concatenate([np.append(t, wavelet.END_ID) for t in coder.encode(texts)])
    some = [int(every[0]), int(every[777]), wavelet.END_ID, 49_999_999]
    got = {r["token"]: r["n"] for r in wavelet.count_tokens(shards, some).collect()}
    assert shards.count() > 3 and got == {t: int((every == t).sum()) for t in some}
    for token in some[1:]:
        at = sorted(r["position"] for r in wavelet.find_token(shards, token).collect())
        assert at == np.flatnonzero(every == token).tolist()


def test_group_lookup_by_broadcast_or_shuffle(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = jaccard.join(docs)
    least = {r["group_key"]: r["m"] for r in found.where("group_key is not null")
             .groupBy("group_key").agg(F.min("doc_id").alias("m")).collect()}
    want = sorted((r["doc_id"], least.get(r["group_key"], r["doc_id"])) for r in found.collect())
    for most in (jaccard.MAX_WANTED, 0):
        monkeypatch.setattr(jaccard, "MAX_WANTED", most)
        got = jaccard.query(spark, SF_SMALL).select("doc_id", "group_id").collect()
        assert sorted(map(tuple, got)) == want
