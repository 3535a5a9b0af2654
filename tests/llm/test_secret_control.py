"""The error control of the secret scan: false alarms are what it limits."""

import random
import re

import numpy as np
import pytest
from conftest import SF_CHECK

from lagjoin.llm import secrets
from lagjoin.llm.bpe import tokenizer_path


@pytest.fixture(scope="module")
def null():
    return secrets.ordinary(tokenizer_path())


def key(rng, encoding, n):
    return "".join(rng.choice(secrets.ALPHABETS[encoding]) for _ in range(n))


def test_identifiers_are_no_secrets():
    for text in ("node_modules/lodash/fp/convert2", "Lorem2ipsumDolorSitAmet99", "sha256sumOfTheWholeArchive1",
                 "org/apache/spark/sql/catalyst/Version4", "2024-01-15T10_30_00-backup-final-v2", "a1" * 30):
        assert not secrets.random_spans(f"see {text} there", []), text


def test_false_alarms_on_words_of_the_documents(spark, null):
    """Identifiers of words that the null distribution has not seen."""
    texts = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("text is not null").limit(300).collect()
    words = sorted({w for r in texts for w in re.findall("[a-z]{3,12}", r["text"])})
    rng, alarms, n = random.Random(11), 0, 0
    for encoding in ("base36", "alphanumeric", "base64", "base64url"):
        for length in (20, 26, 35, 60):
            for _ in range(150):
                token = secrets.ordinary_token(rng, words, encoding, length)
                alarms += bool(secrets.random_spans(token, [], null=null))
                n += 1
    assert alarms / n < 0.08


def test_keys_are_found(null):
    rng = random.Random(5)
    for encoding, n, least in (("alphanumeric", 20, 0.85), ("base64url", 24, 0.9), ("base36", 32, 0.9), ("hex", 20, 0.9),
                               ("base32", 40, 0.9), ("base64", 64, 0.97)):
        texts = [key(rng, encoding, n) for _ in range(200)]
        texts = [t for t in texts if re.search(r"\d", t) and re.search("[A-Za-z]", t)]
        assert sum(bool(secrets.random_spans(f"k {t} k", [], null=null)) for t in texts) >= least * len(texts), encoding


def test_share_of_false_alarms_among_many(null):
    """Texts of ten keys among forty ordinary tokens."""
    rng, wrong, right = random.Random(2), 0, 0
    words = ["archive", "window", "server", "handler", "quick", "river", "format", "invoice", "market", "yellow", "jazz"]
    for _ in range(20):
        plain = {secrets.ordinary_token(rng, words, rng.choice(("alphanumeric", "base64url", "base36")), rng.randrange(20, 50))
                 for _ in range(40)}
        hidden = {key(rng, "alphanumeric", rng.randrange(24, 48)) for _ in range(10)}
        tokens = sorted(plain | hidden, key=lambda t: rng.random())
        text = " ".join(tokens)
        found = {text[a:b] for a, b, _ in secrets.random_spans(text, [], null=null)}
        wrong, right = wrong + len(found & plain), right + len(found & hidden)
    assert right > 170 and wrong / (wrong + right) < 0.1


def test_spans_by_brute_force(null):
    """Every token's p-value by counting all ordinary ones, every possible
    number of rejections tried."""
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "record", "system"]
    for _ in range(30):
        tokens = [key(rng, "alphanumeric", rng.randrange(20, 60)) if rng.random() < 0.4
                  else secrets.ordinary_token(rng, words, "alphanumeric", rng.randrange(20, 60)) for _ in range(12)]
        tokens = [t for t in tokens if re.search(r"\d", t) and re.search("[A-Za-z]", t)]
        text = " ".join(tokens)
        ps = []
        for t in tokens:
            name = next(e for e, a in secrets.ALPHABETS.items() if set(t) <= set(a))
            at_most = max(n for n in secrets.LENGTHS if n <= len(t))
            cell = null[name, at_most][0]
            value = sum(np.log(max(p, 1e-300)) for p in secrets.battery(t, name))
            top = cell[-(len(cell) // 10):]
            ps.append(0.1 * np.exp((top[0] - value) / (np.mean(top) - top[0])) if value > top[0]
                      else (sum(c >= value for c in cell) + 1) / (len(cell) + 1))
        mean = sum(map(len, tokens)) / len(tokens)
        q = [p * mean / len(t) for p, t in zip(ps, tokens)]
        limit = max((k * secrets.LEVEL / len(q) for k in range(1, len(q) + 1)
                     if sum(x <= k * secrets.LEVEL / len(q) for x in q) >= k), default=-1)
        want = [t for t, x in zip(tokens, q) if x <= limit]
        assert [text[a:b] for a, b, _ in sorted(secrets.random_spans(text, [], null=null))] == want


def test_weights_and_empty():
    assert secrets.rejected([]) == []
    assert secrets.rejected([(0.04, 10), (0.04, 10)]) == [True, True]
    # the longer token may use more of the level
    assert secrets.rejected([(0.03, 60), (0.9, 20)]) == [True, False] and secrets.rejected([(0.03, 20), (0.9, 60)]) == [False, False]
