"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf.  The leaves of a group (here: of a source) in order form
a tree of the given arity; the group roots in order form one more tree, whose
root names the whole dataset.  A row's proof is the digests of its siblings on
the way up, and folding it must give the root again.

*Time-forward processing.*  Nodes are labelled in the order in which they can
be computed: by the last leaf below them, then by height.  A forward sweep
visits them by label; each node sends its digest to its parent through a
priority queue ordered by label, so when a node is due all its children's
messages are at the head of the queue.  A reversed sweep visits the labels
from the last to the first, and each node sends its children the rest of
their proof: their siblings, then its own.

The queue is external: a tree is swept in blocks of ``arity ** levels``
consecutive nodes, a task's queue holds at most ``arity * levels`` messages,
and messages between blocks (block roots upwards, proof suffixes downwards)
travel as rows that a shuffle deals to the block they are for and sorts by
label.  Each round of blocks shrinks a tree by ``arity ** levels``, so a few
rounds of narrow rows do for any corpus, and a source that holds a third of
all rows is many blocks.  Positions come from a range sort on (group, order,
digest) and running sums over one row per task and group.

Defined results: null and empty values are told apart in a leaf ('-' against
'0:'); a null group is a group, the first; rows of one id are ordered by leaf,
identical ones in any way (their digests agree); a text of any length is one
leaf; a table without rows has no manifest.  Extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagjoin.llm.shared import ship, table, written

ARITY = 3
#: Levels of a block: 3 ** 5 = 243 nodes are swept together.
LEVELS = 5
#: Columns that make a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values, each '-' if null, else its length
    in UTF-8 bytes, a colon and itself."""
    one = [F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.sha2(F.concat(*one), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) and each row's place ``idx`` in its
    tree by ``order``, nulls first, and the tree's size ``n``; written."""
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "tie"]
    ordered = written(spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                      .withColumn("place", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("place", 33).alias("task")
    per_task = ordered.groupBy("tree", task).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    bases = per_task.select("tree", "task", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("base"),
                            F.sum("rows").over(whole).alias("n"))
    return written(ordered.withColumn("task", F.shiftright("place", 33)).join(bases, ["tree", "task"])
                   .withColumn("idx", F.col("base") + F.col("place")).drop("task", "base", "place"), "numbered")


def height(n: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


class Block:
    """``levels`` levels of a tree above consecutive nodes."""

    def __init__(self, digests: list[str], levels: int, arity: int = ARITY):
        self.n, self.levels, self.arity = len(digests), levels, arity
        self.nodes: list[tuple[int, int, int, list[str]]] = []  # label, height, place, children
        self.root = digests[0] if levels == 0 else ""
        self._forward(digests)

    def _label(self, height: int, place: int) -> int:
        last = min((place + 1) * self.arity ** height, self.n) - 1
        return last * (self.levels + 1) + height

    def _forward(self, digests: list[str]) -> None:
        queue: list[tuple[int, int, str]] = []  # label of the receiver, place of the sender, its digest
        arity, levels = self.arity, self.levels
        if levels == 0:
            return
        for leaf, digest in enumerate(digests):
            heapq.heappush(queue, (self._label(1, leaf // arity), leaf, digest))
            due = leaf * (levels + 1) + levels
            while queue and queue[0][0] <= due:
                label = queue[0][0]
                height, children = label % (levels + 1), []
                while queue and queue[0][0] == label:
                    _, sender, child = heapq.heappop(queue)
                    children.append(child)
                place = sender // arity
                self.nodes.append((label, height, place, children))
                own = _digest("".join(children))
                if height == levels:
                    self.root = own
                else:
                    heapq.heappush(queue, (self._label(height + 1, place // arity), place, own))

    def proofs(self, suffix: str) -> list[str]:
        """The proof of every leaf, its levels from the leaf on as
        'left,right' digests, each ended by '/'; ``suffix``: the root's."""
        out = [suffix] * self.n
        if self.levels == 0:
            return out
        arity, levels = self.arity, self.levels
        queue = [(-self.nodes[-1][0], 0, suffix)]  # minus the receiver's label, its place, the rest of its proof
        for label, height, place, children in reversed(self.nodes):
            while -queue[0][0] != label:  # leaves due before the next inner node
                _, leaf, proof = heapq.heappop(queue)
                out[leaf] = proof
            proof = heapq.heappop(queue)[2]
            for k in range(len(children)):
                child = place * arity + k
                own = f"{''.join(children[:k])},{''.join(children[k + 1:])}/{proof}"
                heapq.heappush(queue, (-self._label(height - 1, child), child, own))
        for _, leaf, proof in queue:
            out[leaf] = proof
        return out


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof give."""
    for level in proof.split("/")[:-1]:
        left, right = level.split(",")
        leaf = _digest(left + leaf + right)
    return leaf


def _blocks(batches, columns: int) -> Iterator[tuple[str, int, list[list]]]:
    """Rows (tree, block, ...) sorted by tree and block, as (tree, block,
    columns of its rows)."""
    key, held = None, [[] for _ in range(columns)]
    for batch in batches:
        data = [c.to_pylist() for c in batch.columns]
        at, n = 0, batch.num_rows
        while at < n:
            own = (data[0][at], data[1][at])
            if own != key:
                if key is not None:
                    yield *key, held
                key, held = own, [[] for _ in range(columns)]
            end = at + 1
            while end < n and data[1][end] == own[1] and data[0][end] == own[0]:
                end += 1
            for column, values in zip(held, data[2:]):
                column += values[at:end]
            at = end
    if key is not None:
        yield *key, held


def _dealt(nodes: DataFrame) -> DataFrame:
    """Rows dealt to the block that their label belongs to, sorted by label."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _block_of(size: int) -> Column:
    return F.floor(F.col("idx") / size).cast("long").alias("block")


def roots(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Forward sweep over ``nodes`` (tree, idx, n, digest): the inputs of its
    rounds, and the written roots (tree, digest)."""
    ship(nodes.sparkSession)
    size = arity ** levels

    def sweep(batches):
        for tree, block, (ns, digests) in _blocks(batches, 2):
            n = ns[0]
            root = Block(digests, min(levels, height(n, arity)), arity).root
            yield pa.RecordBatch.from_pydict({"tree": [tree], "idx": pa.array([block], pa.int64()),
                                              "n": pa.array([-(-n // size)], pa.int64()), "digest": [root]})

    def together(batches):  # few large batches instead of one per block
        held = []
        for row in sweep(batches):
            held.append(row)
            if len(held) == 1000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    largest = nodes.agg(F.max("n")).first()[0] or 0
    rounds, done = [], None
    while True:
        rounds.append(nodes)
        dealt = _dealt(nodes.select("tree", _block_of(size), "idx", "n", "digest"))
        nodes = written(dealt.select("tree", "block", "n", "digest").mapInArrow(
            together, "tree string, idx long, n long, digest string"), "nodes")
        ended = nodes.where("n = 1").select("tree", "digest")
        done = ended if done is None else done.unionByName(ended)
        largest = -(-largest // size)
        if largest <= 1:
            return rounds, done
        nodes = nodes.where("n > 1")


_SUFFIX = "tree string, block long, proof string, top string"


def _with_suffixes(nodes: DataFrame, suffixes: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """A round's nodes and the suffix of each of their blocks, which comes
    first in its block."""
    nulls = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in keep]
    rows = nodes.select("tree", _block_of(size), "idx", "n", "digest", F.lit(None).cast("string").alias("proof"),
                        F.lit(None).cast("string").alias("top"), *keep)
    heads = suffixes.select("tree", "block", F.lit(-1).cast("long").alias("idx"), F.lit(0).cast("long").alias("n"),
                            F.lit(None).cast("string").alias("digest"), "proof", "top", *nulls)
    return _dealt(rows.unionByName(heads)).drop("idx")


def deliver(rounds: list[DataFrame], tops: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Reversed sweep down to the last round: ``tops`` (tree, proof, top) are
    the trees' own suffixes; the result has the suffix (and top) of every
    block of the first round.  A tree enters at the round in which it ends."""
    size = arity ** levels

    def sweep(batches):
        for tree, block, (ns, digests, proofs, heads) in _blocks(batches, 4):
            made = Block(digests[1:], min(levels, height(ns[1], arity)), arity).proofs(proofs[0])
            m = len(made)
            yield pa.RecordBatch.from_pydict(
                {"tree": [tree] * m, "block": pa.array(range(block * size, block * size + m), pa.int64()),
                 "proof": made, "top": [heads[0]] * m})

    suffixes = None
    for nodes in reversed(rounds):
        ends_here = nodes.where(f"idx = 0 and n <= {size}").select("tree").join(tops, "tree").select(
            "tree", F.lit(0).cast("long").alias("block"), "proof", "top")
        suffixes = ends_here if suffixes is None else suffixes.unionByName(ends_here)
        if nodes is rounds[0]:
            return suffixes
        below = _with_suffixes(nodes, suffixes, size, [])
        suffixes = written(below.mapInArrow(sweep, _SUFFIX), "suffixes")
    return suffixes


def manifest(docs: DataFrame, columns: Sequence[str] = LEAF_COLUMNS, group_col: str = "source",
             id_col: str = "doc_id", tampered: dict[str, Column] | None = None,
             tampered_where: Column | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof ('left,right/' by level),
    proof_sha256, folded_root and verified of every row.

    ``tampered``: expressions that stand for some columns when the leaf is
    recomputed, in rows where ``tampered_where`` holds; all others fold the
    leaf itself."""
    spark = docs.sparkSession
    ship(spark)
    size = arity ** levels
    leaf = leaf_digest([F.col(c) for c in columns])
    changed = F.lit(None).cast("string")
    if tampered:
        changed = F.when(tampered_where, leaf_digest([tampered.get(c, F.col(c)) for c in columns]))
    # '0' for no group sorts before '1' and the group's own bytes
    tree = F.when(F.col(group_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string")))
    text_ids = docs.schema[id_col].dataType.simpleString() == "string"
    id_type, arrow_type = ("string", pa.string()) if text_ids else ("long", pa.int64())
    leaves = written(docs.select(tree.alias("tree"), F.col(id_col).cast(id_type).alias("doc_id"), leaf.alias("digest"),
                                 changed.alias("changed")), "leaves")
    low_rounds, subroots = roots(numbered(leaves, ["doc_id", "digest"]), arity, levels)
    groups = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    high_rounds, top = roots(groups, arity, levels)
    root = next((r["digest"] for r in top.collect()), "")  # one row

    from_root = spark.createDataFrame([("", "", root)], "tree string, proof string, top string")
    to_groups = _with_suffixes(high_rounds[0], deliver(high_rounds, from_root, arity, levels), size, ["name"])

    def sweep_groups(batches):
        for _, _, (ns, digests, proofs, _, names) in _blocks(batches, 5):
            made = Block(digests[1:], min(levels, height(ns[1], arity)), arity).proofs(proofs[0])
            yield pa.RecordBatch.from_pydict({"tree": names[1:], "proof": made, "top": digests[1:]})

    tops = written(to_groups.mapInArrow(sweep_groups, "tree string, proof string, top string"), "suffixes")
    to_leaves = _with_suffixes(low_rounds[0], deliver(low_rounds, tops, arity, levels), size, ["doc_id", "changed"])

    def sweep_leaves(batches):
        for _, _, (ns, digests, proofs, heads, ids, other) in _blocks(batches, 6):
            made = Block(digests[1:], min(levels, height(ns[1], arity)), arity).proofs(proofs[0])
            folded = [fold(c or d, p) for d, c, p in zip(digests[1:], other[1:], made)]
            m = len(made)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids[1:], arrow_type), "leaf": digests[1:], "subroot": [heads[0]] * m, "root": [root] * m,
                 "proof": made, "proof_sha256": [_digest(p.replace("/", "").replace(",", "")) for p in made],
                 "folded_root": folded, "verified": [f == root for f in folded]})

    return to_leaves.mapInArrow(sweep_leaves, f"doc_id {id_type}, leaf string, subroot string, root string, "
                                "proof string, proof_sha256 string, folded_root string, verified boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the manifest of ``documents``; where 2 divides the checksum of an
    id, the text that is verified has lost its line feeds."""
    docs = table(spark, sf_dir, "documents")
    out = manifest(docs, tampered={"text": F.translate("text", "\n", "")},
                   tampered_where=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return out.drop("proof")


def _sql_leaf(text: str) -> str:
    one = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
           for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(one)})"


#: CRC-32, bit by bit, of an id's decimal digits: every digit's code, then
#: eight shifts (marked -1).
_SQL_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
            "lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
            "lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)")

ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_sql_leaf('text')} AS leaf,
         CASE WHEN {_SQL_CRC} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
up AS (
  SELECT source, 0 AS lev, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT source, lev + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY source, lev, idx // 3, n),
groups AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM up WHERE n = 1),
high AS (
  SELECT 0 AS lev, idx, subroot AS h, n FROM groups
  UNION ALL
  SELECT lev + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM high WHERE n > 1 GROUP BY lev, idx // 3, n),
low_steps AS (
  SELECT p.rid, u.lev, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < u.idx), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > u.idx), '') AS r
  FROM placed p
  JOIN up u ON u.source IS NOT DISTINCT FROM p.source AND u.idx = p.idx // CAST(pow(3, u.lev) AS BIGINT) AND u.n > 1
  JOIN up s ON s.source IS NOT DISTINCT FROM u.source AND s.lev = u.lev AND s.idx // 3 = u.idx // 3
  GROUP BY p.rid, u.lev),
high_steps AS (
  SELECT g.source, u.lev, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < u.idx), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > u.idx), '') AS r
  FROM groups g
  JOIN high u ON u.idx = g.idx // CAST(pow(3, u.lev) AS BIGINT) AND u.n > 1
  JOIN high s ON s.lev = u.lev AND s.idx // 3 = u.idx // 3
  GROUP BY g.source, u.lev),
low_proofs AS (SELECT rid, list(l || ',' || r ORDER BY lev) AS steps FROM low_steps GROUP BY rid),
high_proofs AS (SELECT source, list(l || ',' || r ORDER BY lev) AS steps FROM high_steps GROUP BY source),
proofs AS (
  SELECT p.doc_id, p.leaf, g.subroot, (SELECT h FROM high WHERE n = 1) AS root,
         list_concat(coalesce(lp.steps, []::VARCHAR[]), coalesce(hp.steps, []::VARCHAR[])) AS steps,
         coalesce(p.changed, p.leaf) AS start
  FROM placed p JOIN groups g ON g.source IS NOT DISTINCT FROM p.source
  LEFT JOIN low_proofs lp USING (rid)
  LEFT JOIN high_proofs hp ON hp.source IS NOT DISTINCT FROM p.source),
folded AS (
  SELECT *, list_reduce(list_concat([start], steps),
            lambda acc, e: sha256(split_part(e, ',', 1) || acc || split_part(e, ',', 2))) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), ',', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
