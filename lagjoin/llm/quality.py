"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition under which a text fails.  On about ``SAMPLE_ROWS``
rows, drawn evenly from the whole table, the cascade measures every rule's
cost (the best of ``TIMINGS`` runs) and which rows it fails.  The next rule is
always the one that rejects most per cost among the rows that the rules before
it leave; a CASE chain in that order stops at a row's first failing rule.  The
verdict does not depend on the order.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged each; an empty table gives no rows and keeps the
rules as written; a text of any length is measured whole.  A line counts as
repeated when it holds a word and equals an earlier line.  Columns other than
``keep`` and the text are not read, whatever their names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.llm.shared import table, written

#: Fixed values of the word rule: runs of anything but blanks.
BLANKS = r"[\x20\x09-\x0D]+"
SAMPLE_ROWS = 1000
TIMINGS = 3


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the columns of :func:`measured`."""
    name: str
    fails: str


#: Production rules besides the base rule.
RULES = (
    Rule("symbol_share", "10 * n_symbols > 3 * n_words"),
    Rule("mean_word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("lettered_words", "2 * size(regexp_extract_all(text, r'\\S*\\p{L}\\S*', 0)) < n_words"),
    Rule("bullet_lines", "10 * size(filter(split(text, '\\n'), x -> ltrim(x) rlike '^[-*•]')) > 9 * n_lines"),
    Rule("ellipsis_lines", "10 * size(filter(split(text, '\\n'), x -> rtrim(x) rlike '(…|[.][.][.])$')) > 3 * n_lines"),
)
BASE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def measured(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, text and the counts that contract and rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(*keep, text.alias("text"))
    # one separator per gap, none at the ends: the words are what split gives
    rows = rows.withColumn("__f", F.trim(F.regexp_replace("text", BLANKS, " ")))
    rows = rows.withColumn("__w", F.when(F.col("__f") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("__f", " ")))
    rows = rows.withColumn("n_words", F.size("__w").cast("long"))
    rows = rows.withColumn("__h", F.expr("transform(__w, w -> xxhash64(w))"))
    rows = rows.withColumn("__s", F.expr(
        "case when n_words >= 3 then sort_array(transform(sequence(0, cast(n_words as int) - 3), "
        "i -> struct(xxhash64(__h[i], __h[i + 1], __h[i + 2]) as h, i as p))) "
        "else cast(array() as array<struct<h: bigint, p: int>>) end"))
    # positions of windows that have an equal neighbour in hash order
    rows = rows.withColumn("__p", F.expr(
        "array_sort(transform(filter(__s, (x, i) -> x.h = get(__s, i - 1).h or x.h = get(__s, i + 1).h), x -> x.p))"))
    # each window covers up to three words; less what the one before covered
    rows = rows.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(__p, (p, i) -> case when i = 0 then 3 else least(3, p - __p[i - 1]) end), 0L, (a, x) -> a + x)"))
    rows = rows.withColumn("__l", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return rows.select(
        *keep, "text", "n_words",
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").cast("long").alias("n_lines"), "n_repeat_words")


def cascade(failed: list[tuple[tuple[bool, ...], int]], costs: list[float]) -> list[int]:
    """The order of the rules, given how many rows fail which of them: each
    time the one of most rejections per cost among the rows still left, then
    the cheapest."""
    order, left = [], list(range(len(costs)))
    while left:
        rejected = {k: sum(n for flags, n in failed if flags[k]) for k in left}
        best = min(left, key=lambda k: (-rejected[k] / costs[k], costs[k], k))
        order.append(best)
        left.remove(best)
        failed = [(flags, n) for flags, n in failed if not flags[best]]
    return order


def ordered(sample: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejection per cost on ``sample`` (rows of :func:`measured`
    that pass the base rule)."""
    flags = [F.coalesce(F.expr(rule.fails), F.lit(False)).alias(f"r{k}") for k, rule in enumerate(rules)]
    # at most as many groups as the sample has rows
    failed = [(tuple(r)[:-1], r["n"]) for r in sample.groupBy(*flags).agg(F.count("*").alias("n")).collect()]
    if not failed:
        return list(rules)

    def timed(condition: Column) -> float:
        best = float("inf")
        for _ in range(TIMINGS):
            began = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()
            best = min(best, time.perf_counter() - began)
        return best

    idle = timed(F.lit(False))
    costs = [max(timed(F.expr(rule.fails)) - idle, 1e-3) for rule in rules]
    return [rules[k] for k in cascade(failed, costs)]


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first rule that a row fails, null if none; later rules
    of the chain are not evaluated."""
    chain = None
    for rule in rules:
        chain = (F if chain is None else chain).when(F.expr(rule.fails), rule.name)
    return F.lit(None).cast("string") if chain is None else chain


def judge(df: DataFrame, keep: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``keep``, the counts, base_failed and kept of every row."""
    rows = df.select(*keep, text_col)
    drawn = rows.sample(fraction=min(1.0, sample_rows / max(df.count(), 1)), seed=1)
    # filtered as reread: the condition would be pushed below the counts and repeat them
    sample = written(measured(drawn, keep, text_col), "quality-sample").where(f"not ({BASE})")
    verdict = first_failure([Rule("base", BASE), *ordered(sample, rules)])
    return (measured(df, keep, text_col).withColumn("failed_rule", verdict)
            .select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    F.coalesce(F.col("failed_rule") == "base", F.lit(False)).alias("base_failed"),
                    F.col("failed_rule").isNull().alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: counts and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"), ["doc_id"])
