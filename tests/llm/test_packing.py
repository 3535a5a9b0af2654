"""Harmonic packing: every token once, sequences without gaps, little padding."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagjoin.llm import packing
from lagjoin.llm.bpe import tokenizer_path

CLASH = ("ids", "part", "seq", "start", "length", "class_order", "rank", "sequence_id", "offset", "nth")


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(2)
    odd = [None, "", " \n", "one", "same text twice " * 30, "same text twice " * 30, "<|endoftext|> mid <|startoftext|>",
           "Ünïcödé ΑΣ ΟΔΟΣ İstanbul 'S don't 123 45", "long words " * 20000, "a" * 3000, "aé" * 2000]
    odd += ["".join(rng.choice(list("etaoin shé1'.ßΣ😀\n"), 300)) for _ in range(100)]
    rows = [(None if k == 3 else 10**6 + k, t) for k, t in enumerate(odd)]
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    return (base.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
            .withColumns({c: F.lit("clash") for c in CLASH}).repartition(6).cache())


@pytest.fixture(scope="module")
def want(docs):
    library = Tokenizer.from_file(tokenizer_path())
    return {r[0]: [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]
            for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def pieces(docs):
    return packing.pieces(docs)


def padding(totals, capacity):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in totals)


def by_sequence(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        out.setdefault(r["sequence_id"], []).append(r)
    return out


@pytest.mark.parametrize("capacity", [64, 4096])
def test_every_token_once_and_no_gaps(docs, want, capacity):
    rows = packing.place(packing.pieces(docs, capacity=capacity), capacity).collect()
    held = by_sequence(rows)
    for packed in held.values():
        assert [r["offset"] for r in packed] == np.cumsum([0, *(r["length"] for r in packed[:-1])]).tolist()
        assert 0 < sum(r["length"] for r in packed) <= capacity
    assert sorted(held) == list(range(len(held)))
    texts = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and r["start"] == len(texts.setdefault(r["doc_id"], []))
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        texts[r["doc_id"]] += ids
    assert texts == want
    totals = [sum(r["length"] for r in packed) for packed in held.values()]
    assert padding(totals, capacity) < 0.02 * sum(totals)


def test_checksums_are_those_of_the_tokens(pieces):
    whole = Counter((r["doc_id"], r["start"], r["length"], zlib.crc32(r["ids"]), r["doc_tokens"], r["sequence_id"], r["offset"])
                    for r in packing.place(pieces).collect())
    assert Counter(map(tuple, packing.place(pieces, payload="crc32").collect())) == whole


def test_sequences_hold_their_pieces(pieces):
    placed = packing.place(pieces).cache()
    held = by_sequence(placed.collect())
    made = packing.sequences(placed).collect()
    assert len(made) == len(held)
    for r in made:
        assert bytes(r["ids"]) == b"".join(p["ids"] for p in held[r["sequence_id"]])
        assert r["doc_ids"] == [p["doc_id"] for p in held[r["sequence_id"]]]
        assert r["n_tokens"] == sum(r["lengths"]) == len(r["ids"]) // 4


def test_cut_covers_every_length():
    for n in range(1, 9000):
        parts = packing.cut(n)
        assert sum(k for _, k in parts) == n
        assert all(0 < k <= 4096 // order for order, k in parts)
        assert all(4096 // order - k <= packing.SLACK * (4096 // order) for order, k in parts)
    assert len({order for n in range(1, 4097) for order, _ in packing.cut(n)}) < 2 * 64


def test_full_sequences_hold_a_fixed_number(pieces):
    """Sequences of a class hold as many pieces as its order says."""
    n = {r[0]: r[1] for r in pieces.groupBy("class_order").count().collect()}
    full = sum(k // order for order, k in n.items())
    sizes = Counter(r["sequence_id"] for r in packing.place(pieces, payload="crc32").collect())
    assert Counter(k for s, k in sizes.items() if s < full) == Counter({o: k // o for o, k in n.items() if k // o})


def test_no_rows(spark):
    none = packing.place(packing.pieces(spark.createDataFrame([], "doc_id long, text string")), payload="crc32")
    assert none.collect() == [] and "sequence_id" in none.columns
