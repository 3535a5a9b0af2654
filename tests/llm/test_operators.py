"""Every operator against a brute-force version, an exact round trip or
held-out accuracy, and on edge rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F

from lagjoin.llm import bpe, chat, decontaminate, jaccard, langid, quality, secrets, toxicity, warc, wavelet
from lagjoin.llm.queries import oracle_sql, queries

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGES = [None, "", " \n\t ", "a", "!!! ??", "x y\n\nx y", "same words here again " * 40, "same words here again " * 40,
         "Ünïcödé ΑΣ ΟΔΟΣ İstanbul 'S don't 123 45", "long " * 30000, "<|endoftext|> mid <|startoftext|>",
         "password: hunter2x token=token:abcdefgh AKIA" + "A1" * 10 + " " + "0123abcd" * 4]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if k == 1 else 10**6 + k // 2, t, "en" if k % 2 else None, "s", 0, "clash") for k, t in enumerate(EDGES)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("key", F.lit("clash"))
    return base.select(extra.columns).unionByName(extra).repartition(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def counted(rows):
    return Counter(map(tuple, rows))


def test_bpe_is_the_library(docs, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.tokenizer_path())
    want = Counter()
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))] += 1
    assert counted(bpe.digests(bpe.roundtrip(docs, ["doc_id"]), ["doc_id"]).collect()) == want


def shingles(text):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_jaccard_join_is_brute_force(spark, docs, monkeypatch):
    rows = docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).collect()
    base = [(r["doc_id"], r["text"]) for r in rows]
    words = next(t for _, t in base if t and len(t.split()) > 200).split()
    for k in range(400):  # a large group of near copies, and two steps away from it
        near = list(words)
        near[k % 150] = f"new{k}"
        base.append((2_000_000 + k, " ".join(near)))
    df = spark.createDataFrame(base, "doc_id long, text string")
    sets = [shingles(t) for _, t in base]
    links, parent = Counter(), {i: i for i, _ in base}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(base)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) >= .8 * max(len(x), len(y)):
                common = len(x & y)
                if common >= .8 * (len(x) + len(y) - common) - 1e-9:
                    links[base[a][0]] += 1
                    links[base[b][0]] += 1
                    p, q = find(base[a][0]), find(base[b][0])
                    parent[max(p, q)] = min(p, q)
    groups = lambda key, ids: {frozenset(g) for g in by_key(key, ids).values()}
    for large, block in ((256, 2048), (20, 150), (10**6, 150)):  # a home; homes of blocks; buckets of blocks
        monkeypatch.setattr(jaccard, "LARGE", large)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {r["doc_id"]: r for r in jaccard.join(df).collect()}
        assert len(got) == len(base)
        assert {i: got[i]["n_links"] for i in got} == {i: links[i] for i, _ in base}
        assert groups(find, got) == groups(
            lambda i: got[i]["group_key"] if got[i]["group_key"] is not None else ("own", i), got)


def by_key(key, ids):
    out = {}
    for i in ids:
        out.setdefault(key(i), set()).add(i)
    return out


def test_jaccard_stage_keeps_one_of_each_group(spark, docs):
    out = jaccard.stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    kept = [r["text"] for r in out.collect()]
    sets = [shingles(t) for t in kept]
    assert all(not x or not y or len(x & y) < .8 * len(x | y) for i, x in enumerate(sets) for y in sets[:i])
    assert sum(not shingles(t) for t in kept) == sum(not shingles(r["text"]) for r in docs.collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (7, 7)] + [(500, k) for k in range(300, 400)]
    got = dict(jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[k] for k in range(1, 61)} == {1} and got[200] == got[150] == 100 and got[500] == got[399] == 300
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc_round_trip(spark):
    page = "<p>é\0" + "x" * 200
    rows = [(3, "http://a/%41?q=ü\r\nX: y", page), (1, None, page), (1, "u", page), (None, "v", page), (5, "w", None),
            (6, "", ""), (7, "z", "short"), (8, "z", "short")]
    df = spark.createDataFrame(rows, "id long, url string, body string").repartition(2)
    index = warc.write_archives(warc.with_revisits(df, "id", "url", "body"), file_bytes=300)
    got = warc.read_records(index, read_bytes=400, gap_bytes=10).collect()
    assert len(got) == len(rows) and index.select("file").distinct().count() > 2
    want = Counter((i, u, len((b or "").encode()), sha(b or ""), 1 if b == page and i != 1 else None) for i, u, b in rows)
    assert Counter((r["id"], r["url"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got) == want
    assert all(bytes(r["payload"]) == (b"" if r["refers_to"] else bytes(r["payload"])) for r in got)
    some = warc.read_records(index.where("id = 7"), payloads=True).collect()
    assert [bytes(r["payload"]) for r in some] == [b"short"]


def test_sql_oracles(spark):
    from oracle import compare, duck
    for name, sql in oracle_sql().items():
        res = compare(queries()[name](spark, SF_CHECK), duck(SF_CHECK), sql)
        assert res["match"], (name, res)


def test_decontamination_is_brute_force_both_ways(spark, docs, texts):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").unionByName(spark.createDataFrame(
        [(None, "same words here again"), (900, "x y"), (901, None), (902, "?"), (903, "X, y!")], "item_id long, text string"))
    wanted = [(r["item_id"], tuple(WORD.findall(lower(r["text"])))) for r in items.collect()]
    windows = {}
    for item, w in wanted:
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(w[i:i + 13], set()).add(item)
    want = Counter()
    for i, text in texts:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[p:p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= x - {None}
        names = sorted(map(str, found))
        want[i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    assert sum(k[5] * v for k, v in want.items()) > 2
    assert counted(decontaminate.contamination(docs, items, ["doc_id"]).collect()) == want
    assert counted(decontaminate.contamination(docs, items, ["doc_id"], max_rows=0).collect()) == want


def test_quality_counts(docs, texts):
    want = Counter()
    for i, text in texts:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(zip(w, w[1:], w[2:]))
        rep = {p + d for p in range(len(w) - 2) if grams[tuple(w[p:p + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep),
             len(w) < 50 or 100 * len(rep) > 50 * len(w)] += 1
    got = quality.judge(docs, ["doc_id"]).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r["base_failed"] and r["kept"] for r in got)
    assert sum(r["kept"] for r in got) > len(got) / 3


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = queries()["op6_language_id"](spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] > 0.97


def test_language_edges(spark, docs):
    out = langid.predict(docs, ["doc_id", "text"], langid.train(docs.where(~langid.held_out())))
    for r in out.collect():
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")), r["text"]
    empty = langid.predict(docs, ["doc_id"], langid.train(docs.where("false"))).collect()
    assert {r["lang_pred"] for r in empty} == {"und"}


def test_mixture_proportions():
    a, b = "the cat and the dog were there with them " * 5, "le chat et les chiens étaient avec eux dans la rue " * 5
    count = np.full((langid.BUCKETS, 2), 0.1)
    for k, t in enumerate((a, b)):
        np.add.at(count[:, k], langid.trigrams([t])[0], 1)
    pi = langid.mixtures([a, b, a + b, ""], np.log(count / count.sum(0)))
    assert pi[0].tolist() == [1, 0] and pi[1].tolist() == [0, 1] and abs(pi[2][0] - .45) < .15 and pi[3].sum() == 0


def every_size(text, log_p):
    """The language set by trying every k."""
    n_lang = log_p.shape[1]
    bucket, n = np.unique(langid.trigrams([text])[0], return_counts=True)
    p, n, one = np.exp(log_p[bucket]), n.astype(float), np.zeros(len(bucket), int)
    fit = lambda mask: langid._fit(p, n, np.zeros(1, int), one, mask[None].astype(float))
    alone = (log_p[bucket] * n[:, None]).sum(0)
    first = alone.argmax()
    strength = fit(np.ones(n_lang))[0][0]
    strength[first] += 1
    rank = np.argsort(np.argsort(-strength, kind="stable"))
    found = [(alone[first], np.eye(n_lang)[first])]
    for k in range(2, n_lang + 1):
        pi, value = fit(rank < k)
        found.append((value[0] - langid.PENALTY * (k - 1) * np.log(n.sum() + 1), pi[0]))
    return max(found, key=lambda f: f[0])[1]


def test_language_set_depends_on_the_document_alone():
    left, right = "abcdefghijklmnopqrstuvwxyzabdhcegfj", "zyxwvutsrqponmlkjihgfedcbazxtwvsuqp"
    log_p = np.full((langid.BUCKETS, 3), -20.0)
    log_p[:, 0] = -8
    for k, t in ((1, left), (2, right)):
        log_p[langid.trigrams([t])[0], k] = -8 + np.log(3)
    both = left + " " + right  # {0, 1} does not beat {0}, {0, 1, 2} does
    single = langid.mixtures([both], log_p)[0]
    assert (single[1:] > 0.3).all()
    neighbour = langid.mixtures([both, left * 20, ""], log_p)
    assert np.allclose(neighbour[0], single, atol=1e-9)
    for t in ("a", "ab cd", both):  # the place in the chunk does not matter either
        (alone, _), (both_of, row) = langid.trigrams([t]), langid.trigrams([t, t])
        assert len(alone) and all(both_of[row == k].tolist() == alone.tolist() for k in (0, 1))

    rng = np.random.default_rng(3)
    log_p = np.log(rng.dirichlet(np.full(langid.BUCKETS, 0.3), 6).T + 1e-9)
    words = np.array(["".join(rng.choice(list("abcdefghijklmnop"), 4)) for _ in range(60)])
    for k, w in enumerate(words):
        log_p[langid.trigrams([w])[0], k % 6] += rng.uniform(0, 3)
    texts = [" ".join(rng.choice(words[rng.integers(0, 6)::rng.integers(1, 7)], rng.integers(1, 80))) for _ in range(150)]
    got = langid.mixtures(texts, log_p)
    want = np.array([every_size(t, log_p) for t in texts])
    assert np.allclose(got, want, atol=1e-6)
    assert len({int(k) for k in (got > 0.01).sum(1)}) > 2


def test_language_stage_judges_by_fit(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    by_lang = {k: " ".join(r["text"] for r in docs.where(F.col("lang") == k).orderBy("doc_id").limit(9).collect())
               for k in ("en", "de", "fr")}
    three = " ".join(by_lang[k][:n] for k, n in (("en", 800), ("de", 700), ("fr", 500)))
    other = "Съешь же ещё этих мягких французских булок да выпей чаю, потом приходи снова " * 3
    added = spark.createDataFrame([(-1, three, None), (-2, other, None), (-3, "123 !", None)], docs.schema)
    every = docs.unionByName(added)
    kept = {r["doc_id"] for r in langid.stage(spark, every, SF_CHECK).collect()}
    assert -1 in kept and not {-2, -3} & kept
    assert len(kept) > 0.95 * docs.count()
    shares = langid.predict(added, ["doc_id"], langid.train(docs)).where("doc_id = -1").first()
    assert shares["score"] < 0.5 and sum(x > 0.2 for x in shares["proportions"]) == 3


def test_wavelet_round_trip(docs, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.tokenizer_path("byte_bpe_50k.json"))
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, at = Counter(), 0
    for i, text in order:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want[i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    shards = wavelet.write_shards(docs, "doc_id", "text", shard_tokens=20_000)
    assert shards.count() > 3
    assert counted(wavelet.read_shards(shards).collect()) == want


def test_wavelet_deals_one_id_over_tasks(spark):
    rows = [(None if k % 2 else 7, f"{k * 7919 % 400:03d} some words of the text") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = wavelet.write_shards(df, "doc_id", "text", shard_tokens=10**6).groupBy("part").agg(F.sum("docs").alias("n"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts.count() > 2 and parts.agg(F.max("n")).first()[0] < 200
    got = wavelet.read_shards(wavelet.write_shards(df, "doc_id", "text")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 200 + [7] * 200


def test_wavelet_support():
    rng = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 1), (513, 2), (3000, 700)):
        x = rng.integers(0, top, n).astype(np.uint32)
        _, _, wm = wavelet.open_shard(wavelet.shard_bytes([1], np.array([n]), x))
        assert wm.values().tolist() == x.tolist()
        assert all(wm.access(i) == x[i] for i in range(0, n, 7))
        for token in {0, 1, top - 1, top + 9, 1 << 20}:
            at = np.flatnonzero(x == token)
            assert wm.count(token) == len(at) and wm.count(token, n // 3, n // 2) == (x[n // 3:n // 2] == token).sum()
            assert [wm.locate(token, k) for k in range(len(at))] == at.tolist()


def test_toxicity_held_out(spark):
    # a tenth of the labels are toxic, in four languages: this takes sf0.1
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.where("doc_id % 3 <> 0"))
    got = toxicity.predict(docs, ["doc_id"], model).join(
        labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("grade")), "doc_id").collect()
    assert len(got) > 100
    right = sum((r["severity"] > .5) == (r["grade"] == 1) for r in got)
    assert right / len(got) > 0.97


def test_ordinal_grades():
    rng = np.random.default_rng(3)
    level = rng.integers(0, 4, 600)
    sets = [np.unique(np.concatenate([rng.integers(100, 160, 5), np.arange(g)])) for g in level]
    feats = [(f, np.ones(len(f))) for f in sets]
    m = toxicity.OrdinalModel.fit(feats, [int(g) * 2 for g in level])
    assert m.grades == [0, 2, 4, 6] and (np.diff(m.thresholds) > 0).all()
    s = m.severity(np.array([m.score(f) for f in feats]))
    means = [s[level == g].mean() for g in range(4)]
    assert means == sorted(means) and means[0] < 1 and means[3] > 5
    assert toxicity.OrdinalModel.fit([], []).severity(np.zeros(2)).tolist() == [0, 0]


def base_reference(text):
    out = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, f"assign:{m.start()}:{m.end()}")] * (len(m[2]) >= 6)
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)), 1):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return ",".join(s for _, _, s in sorted(out))


def test_secret_base_and_spans(docs, texts):
    want = Counter((i, sha(base_reference(t or ""))) for i, t in texts)
    got = secrets.scan(docs, ["doc_id"]).collect()
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got) == sum(
        base_reference(t or "").count(":") // 2 for _, t in texts) > 0
    assert sum("random" in r["spans"] for r in got) < len(got) / 10


def test_randomness_battery():
    rng = np.random.default_rng(5)
    alphabet = secrets.ALPHABETS["alphanumeric"]
    keys = ["".join(alphabet[k] for k in rng.integers(0, 62, 40)) for _ in range(200)]
    assert sum(len(secrets.random_spans(f"x {k} y", [])) for k in keys) > 180
    dull = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "abababababababababababab12", "abcdefghijklmnopqrstuvwxyz0123456789"]
    assert not any(secrets.random_spans(t, []) for t in dull)


def test_secret_joined_to_the_other_encoding():
    rng = np.random.default_rng(7)
    key = lambda name, n: "".join(secrets.ALPHABETS[name][k] for k in rng.integers(0, len(secrets.ALPHABETS[name]), n))
    found = Counter()
    for _ in range(100):
        for kind, before, secret in (("url", "com/reset/", key("base64url", 20) + "-_" + key("base64url", 22)),
                                     ("plain", "live_key-", key("base64", 20) + "+/" + key("base64", 22)),
                                     ("around hex", "", key("base36", 11) + "Z" + "0123456789ab" * 2 + "Q" + key("alphanumeric", 11)),
                                     ("beside hex", "", "0123456789ab" * 2 + "Q" + key("alphanumeric", 39))):
            text = f"see {before}{secret} now"
            base = secrets.base_spans(text, True)
            spans = secrets.random_spans(text, base)
            every = sorted(base + spans)
            assert all(x[1] <= y[0] for x, y in zip(every, every[1:]))
            left = secrets.redacted_text(text, every)
            found[kind] += not any(secret[i:i + 4] in left for i in range(len(secret) - 3))
    assert min(found[k] for k in ("url", "plain", "around hex", "beside hex")) > 80, found
    dull = ["site/2024/how-to-write-a-readable-slug-in-10-steps/part_2", "commit/" + "0123456789ab" * 2]
    for text in dull:
        assert not secrets.random_spans(text, secrets.base_spans(text, True))


def test_secret_stage_redacts(spark, docs):
    out = secrets.stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert secrets.scan(out, ["doc_id"]).agg(F.sum(F.col("n_access") + F.col("n_hex"))).first()[0] == 0


def test_chat_trees_and_escapes(spark):
    probe = chat.PROBE + "\\ \\| <\\| \n"
    nodes = [(1, 1, None, "user", "hi", 1.0), (1, 2, 1, "assistant", probe, 1.0), (1, 3, 1, "assistant", "b", 5.0),
             (1, 4, 2, "us\ner", None, 9.0), (1, 5, 3, None, "x", 0.0), (None, 1, None, "assistant", "", None),
             *((2, k, k - 1 if k else None, "user", str(k), 0.5) for k in range(40))]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    every = {(r["tree"], r["leaf"]): r for r in chat.format_trees(df, None).collect()}
    assert set(every) == {(1, 4), (1, 5), (None, 1), (2, 39)}
    assert chat.parse_turns(every[1, 4]["formatted"]) == [("user", "hi"), ("assistant", probe), ("us\ner", "")]
    assert [chat.unescaped(every[1, 4]["formatted"][a:b]) for a, b in every[1, 4]["loss_spans"]] == [probe]
    assert [t for _, t in chat.parse_turns(every[2, 39]["formatted"])] == [str(k) for k in range(40)]
    best = {(r["tree"], r["leaf"]) for r in chat.format_trees(df).collect()}
    assert best == {(1, 4), (None, 1), (2, 39)}
    assert chat.format_trees(df.where("false")).count() == 0


def test_empty_documents(spark, docs):
    none = docs.where("false")
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard.join(none).count() == 0
    assert quality.judge(none, ["doc_id"]).count() == 0
    assert wavelet.read_shards(wavelet.write_shards(none, "doc_id", "text")).count() == 0
    assert decontaminate.contamination(docs, items, ["doc_id"]).where("contaminated").count() == 0
    assert secrets.scan(none, ["doc_id"]).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline
    out = docs.drop("key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        nxt = stage(spark, out, SF_SMALL)
        assert nxt.columns == out.columns, name
        out = corpus_pipeline.written(nxt, "t")
    assert corpus_pipeline.STAGES[-1][1](spark, out, SF_SMALL).count() == out.count() > 50
