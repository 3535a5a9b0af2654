"""Tokenizer alignment against a plain version with sets of ends."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagjoin.llm import align
from lagjoin.llm.bpe import byte_symbols

CLASH = ("kind", "n_a", "pairs", "part", "seq", "groups", "n_best", "pair", "best")


def brute(texts):
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    made = []
    for text in texts:
        text = text or ""
        a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
        a_raw = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        b_raw = [bytes([int(b_tok.id_to_piece(i)[3:-1], 16)]) if b_tok.is_byte(i)
                 else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or {b"".join(a_raw), b"".join(b_raw)} != {(" " + text).encode()}:
            made.append(None)
            continue
        a_ends, b_ends = np.cumsum(list(map(len, a_raw))).tolist(), np.cumsum(list(map(len, b_raw))).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            i2, j2 = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        made.append((a, b, groups))
    links = [Counter((x, y) for ga, gb in (m[2] if m else ()) for x in ga for y in gb) for m in made]
    held = Counter(p for one in links for p in one)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    for m, one in zip(made, links):
        if m is None:
            yield (0,) * 6 + ("",)
            continue
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in m[2])
        yield (len(m[0]), len(m[1]), len(m[2]), sum(one.values()),
               sum(n for p, n in one.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in one.items()),
               hashlib.sha256(text.encode()).hexdigest())


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    odd = [None, "", " ", "  ", "\n", "\n\n x", "a▁b", " a", "a  b ", "\t\ta\r\n\r\nb", "<|endoftext|> x</s><s>",
           "<0x41> 中文字符测试没有空格的句子", "x" * 5000, "日本" * 3000, "é é    z", "don't I'LL 12345 1.5", "\0\x01 a\0",
           "😀😀 👩‍👩‍👧", "again and again", "again and again",
           "".join(chr(c) for c in rng.integers(0x20, 0x3000, 4000) if c != 0x2581)]
    odd += ["".join(rng.choice(list("ab  \n\n\tés'1.<>\r"), 80)) for _ in range(200)]
    extra = spark.createDataFrame([(None if k == 7 else 10**6 + k // 2, t) for k, t in enumerate(odd)],
                                  "doc_id long, text string")
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    return base.unionByName(extra).withColumns({c: F.lit("clash") for c in CLASH}).repartition(4).cache()


@pytest.fixture(scope="module")
def want(docs):
    rows = docs.select("doc_id", "text").collect()
    return Counter((r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows])))


@pytest.fixture(scope="module")
def aligned(docs):
    return align.align(docs, digest=True)


@pytest.mark.parametrize("hot", [1 << 20, 300, 0])
def test_alignment_is_brute_force(aligned, want, hot):
    """Whatever share of the pairs is sent to all tasks."""
    got = align.scored(aligned, align.pair_counts(aligned), hot)
    assert Counter(map(tuple, got.collect())) == want


def test_small_chunks_and_large_groups_agree(docs, want, monkeypatch, spark):
    """Slices of links and distinct ids of large groups change nothing."""
    coder = align.loaded(align.tokenizer_path("byte_bpe_50k.json"), align.tokenizer_path("piece_bpe_32k.model"))
    texts = ["x" * 5000 + " y", "日本" * 800, "plain words here"]
    a, at_a, b, at_b = coder.encode(texts)
    i, j = align.common_ends(np.cumsum(coder.a_len[a]), at_a, np.cumsum(coder.b_len[b]), at_b)
    n_a, n_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    doc = np.searchsorted(at_a, i, "right") - 1
    span = len(coder.a_len) * len(coder.b_len)
    whole = align.link_pairs(a, b, n_a, n_b, doc, len(coder.b_len), span)
    monkeypatch.setattr(align, "LARGE_GROUP", 3)
    monkeypatch.setattr(align, "LINKS", 7)
    for x, y in zip(whole, align.link_pairs(a, b, n_a, n_b, doc, len(coder.b_len), span)):
        assert np.array_equal(x, y)


def test_galloping_finds_what_sets_find():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes, a, b, at_a, at_b, base = rng.integers(1, 900, 6), [], [], [0], [0], 0
        for n in sizes:
            top = int(n) * 3 + 5
            for side, at in ((a, at_a), (b, at_b)):
                k = int(rng.integers(0, top - 1))
                side.extend(sorted({*(rng.choice(top - 1, k, replace=False) + base + 1).tolist(), base + top}))
                at.append(len(side))
            base += top
        i, j = align.common_ends(np.array(a), np.array(at_a), np.array(b), np.array(at_b))
        assert [a[k] for k in i] == [b[k] for k in j] == sorted(set(a) & set(b))


def test_groups_are_kept_as_text(spark):
    one = spark.createDataFrame([(1, "unbelievable things")], "doc_id long, text string")
    got = align.align(one).where("kind = 'doc'").first()["groups"]
    assert hashlib.sha256(got.encode()).hexdigest() == list(brute(["unbelievable things"]))[0][-1]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    aligned = align.align(none)
    out = align.scored(aligned, align.pair_counts(aligned))
    assert out.collect() == [] and "count_sum" in out.columns
