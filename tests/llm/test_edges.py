"""Odd trees, repeated payloads and empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import regex
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lagjoin.llm import bpe, chat, langid, quality, toxicity, warc

TREE = "tree long, node long, parent long, role string, text string, score double"


def plain_paths(rows):
    """Root-to-leaf texts by tree and leaf, walking parent by parent."""
    trees = defaultdict(dict)
    for tree, node, *rest in rows:
        rest = ((rest[0] is not None, rest[0] or 0), rest[1] or "", rest[2] or "", rest[3] or 0.0)
        trees[tree][node] = min(trees[tree].get(node, rest), rest)
    out = {}
    for tree, nodes in trees.items():
        up = {n: r[0][1] for n, r in nodes.items() if r[0][0] and r[0][1] in nodes}
        for n in nodes:
            seen = [n]
            while seen[-1] in up and up[seen[-1]] not in seen:
                seen.append(up[seen[-1]])
            if up.get(seen[-1], "root") == n and n == min(seen):
                del up[n]
        for leaf in set(nodes) - set(up.values()):
            path = [leaf]
            while path[-1] in up:
                path.append(up[path[-1]])
            out[tree, leaf] = [(nodes[n][1], nodes[n][2]) for n in reversed(path)]
    return out


def test_chat_cycles_orphans_and_repeats(spark):
    rng = random.Random(5)
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 1.0),       # parents of each other
            (2, 7, 7, "user", "own parent", None),
            (3, 1, 99, "user", "no such parent", 1.0), (3, 2, 1, None, None, None),
            (4, 1, None, "user", "r", 1.0), (4, 1, None, "user", "r", 1.0), (4, 2, 1, "user", "x", 1.0),
            (4, 2, 1, "user", "x", 1.0), (4, 2, 1, "user", "w", 1.0),
            (5, 1, None, "user", "r", 1.0), (5, None, 1, "assistant", "null id", 1.0)]
    rows += [(t, n, rng.choice([None, *range(14)]), "user", f"{t}.{n}", 0.5) for t in range(10, 40) for n in range(12)]
    rows += [(t, rng.randrange(12), rng.randrange(12), "assistant", "again", 0.5) for t in range(10, 40)]
    df = spark.createDataFrame(rows, TREE).withColumn("leaf", F.lit("x")).withColumn("path_score", F.lit(None))
    got = {(r["tree"], r["leaf"]): chat.parse_turns(r["formatted"]) for r in chat.format_trees(df, None).collect()}
    assert got == plain_paths(rows)
    assert got[1, 2] == [("user", "a"), ("assistant", "b")] and got[4, 2] == [("user", "r"), ("user", "w")]
    assert {k[0] for k in got} == {r[0] for r in rows}


def page_rows():
    a, b, c = "a" * 150, "b" * 150, "c" * 150
    return [*((k, "u", a) for k in range(10, 30)), (1, None, b), (2, "v", b), (2, "v", b), (3, "w", c), (None, "n", c),
            (4, "x", "d" * 150), (5, "y", "short"), (6, "y", "short"), (7, None, None)]


def test_warc_digests_beyond_the_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(page_rows(), "id long, url string, body string").withColumn("digest", F.lit("clash"))
    sent = warc.with_revisits(df, "id", "url", "body").drop("payload").collect()
    monkeypatch.setattr(warc, "MAX_SENT", 1)
    rows = warc.with_revisits(df, "id", "url", "body")
    assert Counter(map(tuple, rows.drop("payload").select(
        "digest", "id", "url", "n_bytes", "refers_to").collect())) == Counter(
        (r["digest"], r["id"], r["url"], r["n_bytes"], r["refers_to"]) for r in sent)
    first = {body: min(i for i, _, t in page_rows() if t == body and i is not None) for _, _, body in page_rows()}
    want = Counter((i, first[t] if len(t or "") >= 100 and i != first[t] else None) for i, _, t in page_rows())
    got = warc.read_records(warc.write_archives(rows)).collect()
    assert Counter((r["id"], r["refers_to"]) for r in got) == want
    texts = {i: t for i, _, t in page_rows()}
    assert all(bytes(r["payload"]).decode() == (texts[r["id"]] or "") for r in got if r["refers_to"] is None)


def test_warc_reads_bounded_payloads(spark):
    """Well compressible payloads: a batch holds about ``read_bytes`` of them, however few bytes they fill on disk."""
    pages = spark.range(60, numPartitions=1).select("id", F.lit(None).cast("string").alias("url"),
                                                    F.repeat(F.lit("x"), 100_000).alias("body"))
    index = warc.write_archives(warc.with_revisits(pages, "id", "url", "body", min_revisit=1 << 30))
    assert index.agg(F.sum("length")).first()[0] < 60_000
    sizes = warc.read_records(index, read_bytes=250_000).select(
        F.spark_partition_id().alias("p"), F.length("payload").alias("n")).collect()
    assert [r["n"] for r in sizes] == [100_000] * 60
    body = b"x" * 1_000_000
    member = warc.record_bytes(1, None, body, len(body), hashlib.sha256(body).hexdigest(), None)
    assert warc.parse_record(member)["payload_bytes"] == len(body)


def test_empty_tables(spark):
    none = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.write_archives(warc.with_revisits(pages, "page_id", "url", "html"))).count() == 0
    assert chat.format_trees(spark.createDataFrame([], TREE)).count() == 0
    assert bpe.digests(bpe.roundtrip(none, ["doc_id"]), ["doc_id"]).count() == 0
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert toxicity.predict(none, ["doc_id"], toxicity.train(none, labels)).count() == 0
    blank = toxicity.predict(docs, ["doc_id"], toxicity.train(docs, labels.where("false"))).collect()
    assert len(blank) == docs.count() and not any(r["toxic"] for r in blank)
    model = langid.train(none)
    assert langid.predict(none, ["doc_id"], model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, ["doc_id"], model).collect()} == {langid.UNKNOWN}


def plain_kept(text):
    """The base rule and the six production rules, one after another."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, lines = len(words), text.split("\n")
    full = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    again = {p + d for p in range(n - 2) if grams[tuple(words[p:p + 3])] > 1 for d in range(3)}
    chars = sum(map(len, words))
    bullets = sum(x.lstrip(" ")[:1] in ("-", "*", "•") and x.lstrip(" ") != "" for x in lines)
    dots = sum(x.rstrip(" ").rstrip("\r").endswith(("…", "...")) for x in lines)
    return not (n < 50 or 100 * len(again) > 50 * n or 10 * len(re.findall(r"[#*$%&|<>]", text)) > 3 * n
                or chars < 2 * n or chars > 15 * n or 10 * (len(full) - len(set(full))) > 3 * len(full)
                or 2 * sum(bool(regex.search(r"\p{L}", w)) for w in words) < n
                or 10 * bullets > 9 * len(lines) or 10 * dots > 3 * len(lines))


def test_quality_verdict_is_brute_force(spark):
    rng = random.Random(3)
    words = lambda k, f=lambda i: f"w{i}x{rng.randrange(9999)}": " ".join(f(i) for i in range(k))
    odd = [words(60), words(49), words(60) + " #" * 30, "\n".join(["a b c d e f g h"] * 3 + [words(8) for _ in range(9)]),
           words(60, lambda i: str(rng.randrange(10 ** 6))), words(60, lambda i: "x" * 20 + str(i)), words(60, lambda i: chr(97 + i % 26)),
           "\n".join("- " + words(9) for _ in range(9)), "\n".join("  • " + words(9) for _ in range(9)),
           "\n".join(words(9) + "... " for _ in range(9)), "\n".join(words(9) + "…" for _ in range(9)),
           "\n".join(["..."] * 3 + [words(9) for _ in range(9)]), words(2_000), "", None]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-k - 1, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(None))
    want = {r["doc_id"]: plain_kept(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs, ["doc_id"]).collect()}
    assert got == want and len({want[-k - 1] for k in range(len(odd))}) == 2
    few = {r["doc_id"]: r["kept"] for r in quality.judge(docs, ["doc_id"], sample_rows=5).collect()}
    assert few == want


def test_quality_cascade_counts_what_is_left():
    # rule 1 fails only rows that rule 0 fails as well; rule 2 fails others
    failed = [((True, True, False), 50), ((True, False, False), 10), ((False, False, True), 20), ((False,) * 3, 20)]
    assert quality.cascade(failed, [1.0, 1.0, 1.0]) == [0, 2, 1]
    assert quality.cascade(failed, [9.0, 1.0, 1.0]) == [1, 2, 0]
    assert quality.cascade([((False, False), 5)], [2.0, 1.0]) == [1, 0]
