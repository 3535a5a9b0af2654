"""Secret scans: fixed patterns and a battery of randomness tests.

Patterns give the base spans.  Besides, every long token is tested: its
encoding is inferred from its characters, and four statistics measure how far
it is from uniform and independent symbols - chi-squared of the symbol counts,
chi-squared of the counts pooled into digits, frequent and other letters and
signs (short tokens have enough expected in each pool), runs about the middle
of the alphabet, and serial correlation.  The sum of their log p-values is
held against ordinary tokens of the same encoding and length: identifiers,
paths, slugs and numbered names built from the words of a public vocabulary.
So the hypothesis is "an ordinary token", its p-value is the share of ordinary
tokens that look as random, and a rejection is a secret; that the statistics
depend on each other is in the null distribution.  Where no encoding fits, the
token is split at the characters of the other base64 form, both ways, and
every long piece is tested.  Of a token that base spans touch, the parts they
leave are tested; those too short for that, beside a key of letters and
digits, are tested together.  Within a text the hypotheses are judged together
by the Benjamini-Hochberg rule with weights by length, as longer tokens give
the tests more power: of the spans it adds, about LEVEL are false alarms.

Defined results: a null text is empty; a text without a span has an empty
span list and the digest of the empty string; repeated rows are scanned each;
a table without rows gives none.  A text of any length is scanned whole, and
its tokens are judged together.  Spans count code points, the end is
exclusive, and method spans never overlap base ones or each other: random
pieces that overlap are one span.  Of extra columns only those asked for are
carried; the stage keeps all, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.llm.bpe import tokenizer_path
from lagjoin.llm.shared import byte_chunks, runs, ship, table, texts_of

#: The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}

SHORTEST = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Pieces of a token in one of the two forms of base64, long and of any length.
ONE_FORM = (re.compile(r"[A-Za-z0-9_-]{20,}={0,2}"), re.compile(r"[A-Za-z0-9+/]{20,}={0,2}"))
ONE_FORM_RUN = (re.compile(r"[A-Za-z0-9_-]+={0,2}"), re.compile(r"[A-Za-z0-9+/]+={0,2}"))
LEVEL = 0.05
#: Alphabets of the encodings, narrowest first.
ALPHABETS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "alphanumeric": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: The letters that ordinary words use most.
FREQUENT = "etaoinsrl"
#: Lengths and number of the ordinary tokens that a token is held against.
LENGTHS = (20, 22, 24, 28, 32, 40, 52, 72)
ORDINARY = 800
_PLACES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
_IS_TOKEN = np.zeros(256, bool)
_IS_TOKEN[[ord(c) for c in ALPHABETS["base64"] + "-_"]] = True


def _upper(z: float) -> float:
    """P(normal > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _encoding(body: str) -> str | None:
    return next((name for name, p in _PLACES.items() if all(c in p for c in body)), None)


def _pool(c: str) -> str:
    if c.isdigit() or not c.isalnum():
        return "digit" if c.isdigit() else "sign"
    return ("upper" if c.isupper() else "lower") + (" frequent" if c.lower() in FREQUENT else "")


_POOL = {c: _pool(c) for a in ALPHABETS.values() for c in a}
_POOLS = {name: Counter(_POOL[c] for c in a) for name, a in ALPHABETS.items()}


def _p_chi(chi: float, df: int) -> float:
    """P(chi-squared > chi), by the cube-root normal approximation."""
    spread = 2 / (9 * df)
    return _upper(((max(chi, 0) / df) ** (1 / 3) - 1 + spread) / math.sqrt(spread))


def battery(body: str, encoding: str) -> tuple[float, float, float, float]:
    """p-values of the four tests under uniform, independent symbols."""
    place, pools = _PLACES[encoding], _POOLS[encoding]
    n, m = len(body), len(place)
    x = [place[c] for c in body]
    p_chi = _p_chi(sum(c * c for c in Counter(x).values()) * m / n - n, m - 1)
    seen = Counter(_POOL[c] for c in body)
    p_pools = _p_chi(sum((seen[k] - n * e / m) ** 2 * m / (n * e) for k, e in pools.items()), len(pools) - 1)
    high = [v >= m / 2 for v in x]
    n1 = sum(high)
    n2 = n - n1
    if n1 and n2:
        mean = 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        r = 1 + sum(a != b for a, b in zip(high, high[1:]))
        p_runs = 2 * _upper(abs(r - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2 * 0.5 ** n
    mu = sum(x) / n
    total = sum((v - mu) ** 2 for v in x)
    serial = sum((a - mu) * (b - mu) for a, b in zip(x, x[1:])) / total if total else 1.0
    return p_chi, p_pools, min(p_runs, 1.0), min(2 * _upper(abs(serial + 1 / n) * math.sqrt(n)), 1.0)


def randomness(body: str, encoding: str) -> float:
    """Joint statistic of the battery: the sum of the log p-values."""
    return sum(math.log(max(p, 1e-300)) for p in battery(body, encoding))


def ordinary_token(rng: random.Random, words: list[str], encoding: str, n: int) -> str:
    """An ordinary token of ``n`` characters in an encoding: words joined as
    identifiers, paths and slugs join them and a number, or dates and counters
    for the hexadecimal ones."""
    number = str(rng.randrange(1, 10_000))
    if encoding in ("hex", "HEX"):
        letters = "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5)))
        digits = f"{rng.randrange(1990, 2040)}{rng.randrange(1, 13):02d}{rng.randrange(1, 29):02d}"
        body = (digits + letters + str(rng.randrange(100_000)).zfill(n))[:n]
        return body if encoding == "hex" else body.upper()
    sign = {"base64": "/", "base64url": rng.choice("-_")}.get(encoding, "")
    if encoding == "base32":
        number = "".join(rng.choice("234567") for _ in number)
    turn = {"base32": str.upper, "BASE36": str.upper, "base36": str, "alphanumeric": str.capitalize}.get(
        encoding) or rng.choice((str, str, str.capitalize))
    first = rng.random() < 0.3 and encoding != "base32"  # the number is at the end or inside
    parts, size = [], 0
    while size < n:
        parts.append(number if first and len(parts) == 1 else turn(rng.choice(words)))
        size += len(parts[-1]) + len(sign)
    body = sign.join(parts)
    return body[:n] if first else body[:n - len(number)] + number


@lru_cache(4)
def ordinary(path: str, size: int = ORDINARY) -> dict[tuple[str, int], tuple[list[float], float]]:
    """The null distribution: for every encoding and length the sorted
    statistics of ``size`` ordinary tokens, and the mean excess of the
    greatest tenth.  It depends on the vocabulary file alone."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = sorted(w.removesuffix("</w>") for w in vocabulary if re.fullmatch(r"[a-z]{3,12}</w>", w))
    out = {}
    for encoding in ALPHABETS:
        for n in LENGTHS:
            rng = random.Random(f"{encoding} {n}")
            found = sorted(randomness(ordinary_token(rng, words, encoding, n), encoding) for _ in range(size))
            top = found[-(size // 10):]
            out[encoding, n] = found, max(sum(top) / len(top) - top[0], 1e-9)
    return out


def p_value(body: str, null: dict) -> float | None:
    """How probable it is that an ordinary token of this encoding and (at
    most this) length looks as random; beyond the greatest tenth the tail is
    taken as exponential.  None if no encoding fits."""
    encoding = _encoding(body)
    if encoding is None:
        return None
    found, excess = null[encoding, LENGTHS[max(bisect_right(LENGTHS, len(body)) - 1, 0)]]
    value, edge = randomness(body, encoding), found[-(len(found) // 10)]
    if value > edge:
        return 0.1 * math.exp((edge - value) / excess)
    return (len(found) - bisect_left(found, value) + 1) / (len(found) + 1)


def rejected(tested: list[tuple[float, int]], level: float = LEVEL) -> list[bool]:
    """Weighted Benjamini-Hochberg: which (p-value, length) lose their
    hypothesis; weights are proportional to the length, their mean is 1."""
    m = len(tested)
    mean = sum(n for _, n in tested) / max(m, 1)
    q = [p * mean / n for p, n in tested]
    order = sorted(range(m), key=q.__getitem__)
    last = max((k + 1 for k, i in enumerate(order) if q[i] <= level * (k + 1) / m), default=0)
    gone = set(order[:last])
    return [i in gone for i in range(m)]


def base_spans(text: str, long_run: bool) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if long_run:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            out += [(*m.span(), kind) for m in pattern.finditer(text) if len(m[0]) >= LEAST[kind]]
    return out


def _length(text: str, a: int, b: int) -> int:
    return len(text[a:b].rstrip("="))


def _pieces(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The long pieces of a token that are in one encoding: itself if one
    fits, else those of both splits."""
    if _encoding(text[a:b].rstrip("=")):
        return [(a, b)]
    return sorted({m.span() for form in ONE_FORM for m in form.finditer(text, a, b)})


def _parts(a: int, b: int, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """What the sorted spans of ``taken`` leave of a token."""
    out = []
    for s, e, _ in taken:
        if s < b and a < e:
            if a < s:
                out.append((a, s))
            a = max(a, e)
    return out + [(a, b)] if a < b else out


def _hypotheses(text: str, a: int, b: int, taken: list[tuple[int, int, str]]):
    """(tested symbols, spans they decide on) of one token."""
    parts = _parts(a, b, taken)
    for part in parts:
        if _length(text, *part) >= SHORTEST:
            yield from ((text[s:e].rstrip("="), [(s, e)]) for s, e in _pieces(text, *part))
    # a keyword is no part of a key, so what stands before it is none either
    if not any(s < b and a < e for s, e, kind in taken if kind != "assign"):
        return
    short = [part for part in parts if 0 < _length(text, *part) < SHORTEST]
    rest = "".join(text[s:e].rstrip("=") for s, e in short)
    if _encoding(rest):
        yield rest, short
    else:
        for form in ONE_FORM_RUN:
            at = [m.span() for s, e in short for m in form.finditer(text, s, e)]
            yield "".join(text[s:e].rstrip("=") for s, e in at), at


def random_spans(text: str, taken: list[tuple[int, int, str]], level: float = LEVEL,
                 null: dict | None = None) -> list[tuple[int, int, str]]:
    """Tokens of letters and digits, or what ``taken`` leaves of them, that
    look more random than ordinary tokens do."""
    null, taken = null or ordinary(tokenizer_path()), sorted(taken)
    found, tested = [], []
    for m in TOKEN.finditer(text):
        for body, spans in _hypotheses(text, *m.span(), taken):
            if re.search(r"\d", body) and re.search(r"[A-Za-z]", body):
                found.append(spans)
                tested.append((p_value(body, null), len(body)))
    out: list[tuple[int, int, str]] = []
    for a, b in sorted(s for spans, ok in zip(found, rejected(tested, level)) if ok for s in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), "random")
        else:
            out.append((a, b, "random"))
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _rows(column: pa.Array, level: float, null: dict):
    """Text, base spans and method spans of every row."""
    for a, b, raw, offsets in byte_chunks(column):
        starts, ends, by_row = runs(_IS_TOKEN[raw], offsets)
        long_at = np.flatnonzero(ends - starts >= 20)
        has_long = np.zeros(b - a, bool)
        has_long[np.searchsorted(by_row, long_at, "right") - 1] = True
        for text, long_run in zip(texts_of(column.slice(a, b - a)).to_pylist(), has_long.tolist()):
            base = base_spans(text, long_run)
            yield text, base, random_spans(text, base, level, null) if long_run else []


def _null(spark: SparkSession):
    """The null distribution, of bounded size, sent to all tasks."""
    ship(spark)
    return spark.sparkContext.broadcast(ordinary(tokenizer_path()))


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """``keep``, counts per kind, the digest of the base spans, all spans."""
    null = _null(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for _, base, extra in _rows(batch.column(len(keep)), level, null.value):
                kinds = Counter(k for _, _, k in base)
                out.append((kinds["assign"], kinds["access"], kinds["hex"],
                            hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + extra)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *(pa.array(c, pa.int64()) for c in cols[:3]),
                 *(pa.array(c, pa.string()) for c in cols[3:])],
                [*keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    schema = docs.select(*keep).schema
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"),
                       ("spans", "string")):
        schema = schema.add(name, kind)
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def redacted_text(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, marked."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """``docs`` with the secrets of ``text_col`` marked; a null stays null."""
    null = _null(docs.sparkSession)
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a, b, _, _ in byte_chunks(batch.column(at)):
                arrays = batch.slice(a, b - a).columns
                gone_at = arrays[at].is_null().to_pylist()
                texts = [None if gone else redacted_text(text, base + extra) if base or extra else text
                         for gone, (text, base, extra) in zip(gone_at, _rows(arrays[at], level, null.value))]
                arrays[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the secrets of every document."""
    return scan(table(spark, sf_dir, "documents"), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are marked in the texts, and n_chars follows;
    every document stays."""
    clean = redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
