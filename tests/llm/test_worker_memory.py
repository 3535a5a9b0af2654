"""What a Python worker holds follows its chunks, not the Arrow batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lagjoin.llm import bpe, langid, secrets
from lagjoin.llm.pretok import WordTable


def traced(work) -> tuple[int, int]:
    """Bytes held after ``work`` and at most, besides those before."""
    tracemalloc.start()
    try:
        kept = work()  # held while measured
        return tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
        del kept


@pytest.fixture(scope="module")
def texts() -> pa.Array:
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(2000)]
    return pa.array([" ".join(rng.choices(words, k=700)) for _ in range(3000)])  # 15 MB


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, "the cat", "en"), (2, "le chat", "fr")], "doc_id long, text string, lang string")


@pytest.mark.parametrize("operator, limit", [
    (lambda d: langid.predict(d, ["doc_id"], MODEL), 30e6),
    (lambda d: langid.train(d), 24e6),
    (lambda d: bpe.roundtrip(d, ["doc_id"]), 24e6),
    (lambda d: secrets.redact(d.select("doc_id", "text")), 12e6)], ids=["predict", "train", "roundtrip", "redact"])
def test_a_batch_is_worked_on_by_chunks(docs, texts, monkeypatch, operator, limit):
    found, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, *a: found.append((f, df.columns)) or plain(df, f, *a))
    operator(docs)
    run, columns = found[0]
    of = {"doc_id": pa.array(range(len(texts))), "text": texts, "lang": pa.array(["en", "fr"] * (len(texts) // 2))}
    batch = pa.RecordBatch.from_arrays([of[c] for c in columns], columns)
    list(run(iter([batch.slice(0, 10)])))  # tables of its own
    rows = []
    _, most = traced(lambda: rows.extend(b.num_rows for b in run(iter([batch]))))
    assert most < limit
    if columns[0] == "doc_id":
        assert sum(rows) == len(texts)


def test_the_language_stage_works_by_chunks(spark, docs, texts, monkeypatch):
    found, plain = [], langid.F.arrow_udf
    monkeypatch.setattr(langid.F, "arrow_udf", lambda kind: lambda f: found.append(f) or plain(kind)(f))
    langid.stage(spark, docs, "")
    found[0](texts.slice(0, 10))
    out = []
    _, most = traced(lambda: out.append(found[0](texts)))
    assert len(out[0]) == len(texts)
    assert most < 30e6


def test_a_known_word_takes_few_bytes():
    n, words = 200_000, [f"{k:06d}" for k in range(200_000)]
    cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    starts = np.arange(0, 6 * n, 6)
    table = WordTable(lambda new: [[int(w), 7] for w in new])

    def work():
        for a in range(0, n, 10_000):
            table.lookup("".join(words), cp, starts[a:a + 10_000], starts[a:a + 10_000] + 6)

    work()  # tables of its own
    table.clear()
    held, _ = traced(work)
    assert held < 75 * n  # 16 of its hash and slot, 16 of its place, 8 of its ids, arrays doubled
    ids, lengths = table.gather(table.lookup("".join(words), cp, starts[::-1], starts[::-1] + 6))
    assert (lengths == 2).all() and (ids[::2] == np.arange(n)[::-1]).all()


MODEL = (["en", "fr"], np.log(np.random.default_rng(1).dirichlet(np.ones(langid.BUCKETS), 2).T + 1e-9))
