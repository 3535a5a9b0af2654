"""The Merkle manifest against a plain recursive version."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lagjoin.llm import merkle
from oracle import compare, duck

H = lambda s: sha256(s.encode()).hexdigest()
CLASH = ("tree", "idx", "n", "digest", "proof", "top", "block", "tie", "place", "leaf", "root")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H("".join(map(value, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))


def tree(digests):
    """Root, and each leaf's levels of (left, right) siblings."""
    steps = [[] for _ in digests]
    below = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        up, members = [], []
        for a in range(0, len(digests), 3):
            run = digests[a:a + 3]
            for k in range(len(run)):
                for one in below[a + k]:
                    steps[one].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H("".join(run)))
            members.append(sum(below[a:a + 3], []))
        digests, below = up, members
    return digests[0], steps


def brute(rows):
    groups = {}
    for r in rows:
        text = r["text"]
        own = leaf(r, text)
        odd = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        other = leaf(r, text.replace("\n", "")) if odd and text is not None else own
        groups.setdefault((r["source"] is not None, (r["source"] or "").encode()), []).append(
            ((r["doc_id"] is not None, r["doc_id"] or 0, own), own, other, r["doc_id"]))
    made = []
    for key in sorted(groups):
        held = sorted(groups[key])
        made.append((held, *tree([h[1] for h in held])))
    root, high = tree([m[1] for m in made])
    out = Counter()
    for (held, subroot, steps), above in zip(made, high):
        for (_, own, other, doc_id), low in zip(held, steps):
            folded = other
            for left, right in low + above:
                folded = H(left + folded + right)
            out[doc_id, own, subroot, root, H("".join(a + b for a, b in low + above)), folded, folded == root] += 1
    return out


def rows_of(df):
    return Counter(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


def manifest(docs, **more):
    return merkle.manifest(docs, tampered={"text": F.translate("text", "\n", "")},
                           tampered_where=F.crc32(F.col("doc_id").cast("string")) % 2 == 0, **more)


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, "x\ny", None, None, None), (None, None, "en", None, 3), (5, None, None, "", 0), (5, "", None, "", 0),
           (7, "a\nb", "en", "once", 3), (7, "a\nb", "en", "twice", 3), (7, "a\nb", "en", "twice", 3),
           (8, "é\n" * 200_000, "fr", "Ünï", 1), (-9, "l\n", "de", "z", 2)]
    many = [(k, f"t\n{k}", "en", "hot", k) for k in range(300)]
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return base.unionByName(spark.createDataFrame(odd + many, SCHEMA)).withColumns({c: F.lit("clash") for c in CLASH}).repartition(5).cache()


@pytest.mark.parametrize("levels", [1, 5])
def test_manifest_is_brute_force(docs, levels):
    assert rows_of(manifest(docs, levels=levels)) == brute(docs.collect())


def test_query_is_sql(spark):
    res = compare(merkle.query(spark, SF_SMALL), duck(SF_SMALL), merkle.ORACLE)
    assert res["match"], res


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, "only", "en", "s", 4)], SCHEMA)
    assert rows_of(manifest(one)) == brute(one.collect())
    none = manifest(one.where("doc_id = 2"))
    assert none.collect() == [] and "proof_sha256" in none.columns


def test_proofs_of_every_tree_size():
    for n in range(1, 40):
        digests = [H(str(k)) for k in range(n)]
        root, steps = tree(digests)
        block = merkle.Block(digests, merkle.height(n))
        assert block.root == root
        proofs = block.proofs("")
        assert proofs == ["".join(f"{a},{b}/" for a, b in s) for s in steps]
        assert {merkle.fold(d, p) for d, p in zip(digests, proofs)} == {root}


def test_queue_holds_few_messages(monkeypatch):
    """The forward queue is bounded by arity * levels, not by the block."""
    most, push = 0, merkle.heapq.heappush

    def watched(queue, item):
        nonlocal most
        push(queue, item)
        most = max(most, len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", watched)
    block = merkle.Block([H(str(k)) for k in range(3 ** 7)], 7)
    block.proofs("")
    assert most <= 3 * 7
