"""Labelled, balanced, reproducibly split datasets.

Reproducibility comes from hashing a row key with md5: a row's bucket does
not depend on partitioning, cluster size or run, unlike ``sample`` /
``randomSplit``.

Exact balancing ("keep exactly n on-time rows") selects the n rows with the
smallest digest.  The pass that counts the classes also makes a mergeable
quantile sketch of the on-time digests, which brackets the cut between two of
its quantiles.  A second pass writes labels, hashes and parts, laid out by
class, part and zone (below or inside the bracket; what lies above is out).
The cut is found inside the bracket, about one row in a hundred, by histograms
of digest prefixes, and the parts are read from the written table.  Rows are
read three times in all, and no unbounded set passes through one task or the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagjoin.functions import scalar as S
from lagjoin.session import scratch_path, written

# Dataset kinds, label column and split defaults.
DS_TYPES = ("DS1", "DS2", "DS3", "DS4")
LABEL_COL = "FT_OnTime"
DELAY_COLUMNS = ("FT_ARR_DELAY_NEW", "FT_WEATHER_DELAY", "FT_NAS_DELAY")
DELAYED_LABEL, ON_TIME_LABEL = 0, 1
TRAIN_PCT = 75
HIST_DIGITS = 4            # hex digits refined per histogram round (65,536 bins)


def delayed_condition(ds_type: str, threshold: float, arr: str = "FT_ARR_DELAY_NEW",
                      weather: str = "FT_WEATHER_DELAY", nas: str = "FT_NAS_DELAY") -> Column:
    """a = arrival delay, w = weather delay, n = NAS delay, T =
    threshold.  DS1: a >= T and a = w + n; DS2: a >= T and (w > 0 or n >= T);
    DS3: a >= T and w + n > 0; DS4: a >= T."""
    a, w, n = F.col(arr), F.col(weather), F.col(nas)
    base = a >= F.lit(threshold)
    if ds_type == "DS1":
        return base & (a == w + n)
    if ds_type == "DS2":
        return base & ((w > 0) | (n >= F.lit(threshold)))
    if ds_type == "DS3":
        return base & ((w + n) > 0)
    if ds_type == "DS4":
        return base
    raise ValueError(f"dataset type {ds_type!r} not allowed ({', '.join(DS_TYPES)})")


def on_time_condition(threshold: float, arr: str = "FT_ARR_DELAY_NEW") -> Column:
    """A <= on-time threshold."""
    return F.col(arr) <= F.lit(threshold)


def row_hash(df: DataFrame, key_cols: Sequence[str] | None) -> Column:
    """Sort key for deterministic selection: md5 of the key columns (all
    columns when no key is given); with a key, md5 of the full row is appended
    to order rows that share a key or its text."""
    full = S.md5_row(*df.columns)
    return F.concat(S.md5_hex(*key_cols), full) if key_cols else full


#: Quantiles of a sketch, and its accuracy (rank error at most 1 in this many).
QUANTILES, ACCURACY = 256, 10_000
_HEX, _SPAN = 13, 1 << 52  # leading digits: numbers that a sketch, which works on doubles, keeps exactly


def _leading(digest: Column) -> Column:
    """The first 52 bits of a digest: in the order of the digest itself."""
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("long")


def _sketch(number: Column) -> Column:
    grid = F.array(*[F.lit(k / QUANTILES) for k in range(QUANTILES + 1)])
    return F.percentile_approx(number, grid, ACCURACY)


def _bracket(n: int, total: int, quantiles: Sequence[int]) -> tuple[int, int]:
    """Numbers between which the n-th of ``total`` lies: a quantile's rank is
    off by less than a step of the grid, so one step either way is enough."""
    at = n * QUANTILES // total
    return quantiles[at - 1] if at >= 1 else -1, quantiles[min(at + 2, QUANTILES)]


def _cut(rows: DataFrame, number: Column, digest: Column, n: int, total: int,
         quantiles: Sequence[int] | None = None) -> tuple[str, int]:
    """Where the ``n`` smallest digests end, 0 < n < total: (digest, copies).
    All rows up to ``digest`` are among them (copies 0), or all rows below it
    and ``copies`` of the rows that have exactly it."""
    lo, hi = _bracket(n, total, quantiles) if quantiles else (-1, _SPAN)
    inside = number >= F.lit(lo)
    near = written(rows.where(number <= F.lit(hi)).groupBy(F.when(inside, digest).alias("s"))
                   .agg(F.count(F.lit(1)).alias("c")), "bracket")
    sums = near.agg(F.sum(F.when(F.col("s").isNull(), F.col("c"))).alias("below"), F.sum("c").alias("upto")).first()
    below, upto = sums["below"] or 0, sums["upto"] or 0
    if not below < n <= upto:
        raise RuntimeError(f"the bracket holds ranks {below + 1} to {upto}, not {n}")
    near = near.where("s is not null")
    prefix, remaining = "", n - below
    while True:
        depth = len(prefix)
        cand = near.where(F.substring("s", 1, depth) == F.lit(prefix)) if depth else near
        hist = sorted((r["b"], r["c"], r["lo"], r["hi"]) for r in
                      cand.groupBy(F.substring("s", depth + 1, HIST_DIGITS).alias("b"))
                          .agg(F.sum("c").alias("c"), F.min("s").alias("lo"), F.max("s").alias("hi")).collect())
        for b, count, least, most in hist:
            if count >= remaining:
                break
            remaining -= count
        if count == remaining:  # the cut lies between two digests
            return most, 0
        if least == most:
            return most, remaining
        prefix += b


def _upto(number: Column, digest: Column, cut: str, inclusive: bool = True) -> Column:
    """Rows whose digest does not lie beyond a cut; digests are compared only
    where the leading bits agree."""
    lead = F.lit(int(cut[:_HEX], 16))
    tail = digest <= F.lit(cut) if inclusive else digest < F.lit(cut)
    return (number < lead) | ((number == lead) & tail)


def smallest_by_hash(df: DataFrame, n: int, key_cols: Sequence[str] | None = None) -> DataFrame:
    """D7 exact: the ``n`` rows with the smallest row hash (ties by identical
    rows are interchangeable).  Equivalent to ``orderBy(hash).limit(n)``
    without funnelling n rows through a single task."""
    if n <= 0:
        return df.limit(0)
    digest = row_hash(df, key_cols)
    number = _leading(digest)
    known = df.agg(F.count(F.lit(1)).alias("n"), _sketch(number).alias("q")).first()
    if known["n"] <= n:
        return df
    cut, copies = _cut(df, number, digest, n, known["n"], known["q"])
    return _below(df, number, digest, cut, copies)


def _below(df: DataFrame, number: Column, digest: Column, cut: str, copies: int) -> DataFrame:
    if not copies:
        return df.where(_upto(number, digest, cut))
    # the cut lies among identical rows: read one and make its copies in
    # parallel from a range -- typed literals, no join
    rep = df.where((number == F.lit(int(cut[:_HEX], 16))) & (digest == F.lit(cut))).first()
    same = df.sparkSession.range(copies).select(
        *[F.lit(rep[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.where(_upto(number, digest, cut, inclusive=False)).unionByName(same)


def hash_fraction(df: DataFrame, n: int, total: int, key_cols: Sequence[str] | None = None) -> DataFrame:
    """D7 approximate: keep a row when its 32-bit hash prefix is below
    n/total of the range -- one pass, about n rows."""
    if total <= 0 or n >= total:
        return df
    bound = int((n / total) * (1 << 32))
    return df.where(F.conv(F.substring(row_hash(df, key_cols), 1, 8), 16, 10).cast("long")
                    < F.lit(bound))


def train_test_split(df: DataFrame, key_cols: Sequence[str] | None = None,
                     train_pct: int = TRAIN_PCT, count: int | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """Split by md5 bucket (first 8 hex digits of md5(key) mod 100 <
    train_pct); with at most one row everything goes to train."""
    if count is not None and count <= 1:
        return df, df.limit(0)
    b = (F.conv(F.substring(row_hash(df, key_cols), 1, 8), 16, 10).cast("long") % 100)
    return df.where(b < train_pct), df.where(b >= train_pct)


def labelled_datasets(df: DataFrame, ds_type: str, delayed_threshold: float,
                      on_time_threshold: float = 0.0, *, key_cols: Sequence[str] | None = None,
                      balance: str = "exact", train_pct: int = TRAIN_PCT,
                      label_col: str = LABEL_COL, arr: str = "FT_ARR_DELAY_NEW",
                      weather: str = "FT_WEATHER_DELAY", nas: str = "FT_NAS_DELAY"
                      ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(delayed_train, delayed_test, on_time_train, on_time_test).

    Delayed rows are chosen by ``ds_type``, on-time rows by the on-time
    threshold; labels 0 (delayed) / 1 (on time).  When there are more
    on-time than delayed rows the on-time side is cut to the delayed count
    (``balance``: 'exact' smallest-hash selection, 'approx' hash fraction,
    'none').  Both sides are split train/test by hash bucket.

    Raises ValueError when the delayed threshold is below the on-time
    threshold or when either class is empty; an empty input returns four
    empty frames."""
    if delayed_threshold < on_time_threshold:
        raise ValueError(f"threshold {delayed_threshold} must be >= on-time threshold "
                         f"{on_time_threshold}")
    if balance not in ("exact", "approx", "none"):
        raise ValueError(f"unknown balance mode {balance!r}")
    dcond = delayed_condition(ds_type, delayed_threshold, arr, weather, nas)
    ocond = on_time_condition(on_time_threshold, arr)
    labels = F.filter(F.array(F.when(dcond, F.lit(DELAYED_LABEL)), F.when(ocond, F.lit(ON_TIME_LABEL))),
                      lambda x: x.isNotNull())
    digest = row_hash(df, key_cols)
    number = _leading(digest)
    known = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(dcond).alias("d"), F.count_if(ocond).alias("o"),
                   _sketch(F.when(ocond, number)).alias("q")).first()
    n_del, n_on = known["d"], known["o"]
    if known["n"] and not n_del:
        raise ValueError("no delayed rows found")
    if known["n"] and not n_on:
        raise ValueError("no on-time rows found")
    cut = balance == "exact" and n_on > n_del
    lo, hi = _bracket(n_del, n_on, known["q"]) if cut else (-1, _SPAN)
    zone = F.when((F.col(label_col) == DELAYED_LABEL) | (F.col("__n") < lo), 0).when(F.col("__n") <= hi, 1)
    path = scratch_path(df.sparkSession, "labelled")
    schema = T.StructType([*df.schema.fields, T.StructField(label_col, T.IntegerType()), T.StructField("__n", T.LongType()),
                           T.StructField("__label", T.IntegerType()), T.StructField("__test", T.IntegerType()),
                           T.StructField("__zone", T.IntegerType())])
    (df.select("*", F.explode(labels).alias(label_col), number.alias("__n"),
               (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 >= train_pct).cast("int").alias("__test"))
     .withColumn("__label", F.col(label_col)).withColumn("__zone", zone).where(F.col("__zone").isNotNull())
     .write.partitionBy("__label", "__test", "__zone").parquet(path))
    rows = df.sparkSession.read.schema(schema).parquet(path)
    columns = [*(S.qcol(c) for c in df.columns), F.col(label_col)]
    delayed, on_time = rows.where(F.col("__label") == DELAYED_LABEL), rows.where(F.col("__label") == ON_TIME_LABEL)
    if cut:
        inside = on_time.where("__zone = 1")
        n = {r["__zone"]: r["n"] for r in on_time.groupBy("__zone").agg(F.count(F.lit(1)).alias("n")).collect()}
        where, copies = _cut(inside, F.col("__n"), digest, n_del - n.get(0, 0), n[1])
        on_time, n_on = _below(on_time, F.col("__n"), digest, where, copies), n_del
    elif n_on > n_del and balance == "approx":
        bound = int((n_del / n_on) * (1 << 32)) << 20  # of 52 bits: the same rows as 32 bits below the bound
        on_time = on_time.where(F.col("__n") < F.lit(bound))

    def parts(side: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        train, test = (side if n <= 1 else side.where("__test = 0")), (side.limit(0) if n <= 1 else side.where("__test = 1"))
        return train.select(*columns), test.select(*columns)

    return *parts(delayed, n_del), *parts(on_time, n_on)


def grouped_datasets(df: DataFrame, ds_type: str, delayed_threshold: float, on_time_threshold: float = 0.0, *,
                     group_cols: Sequence[str], balance: bool = True, train_pct: int = TRAIN_PCT,
                     label_col: str = LABEL_COL, part_col: str = "part", arr: str = "FT_ARR_DELAY_NEW",
                     weather: str = "FT_WEATHER_DELAY", nas: str = "FT_NAS_DELAY") -> DataFrame:
    """D1 - D9 on a joined table, where a fact has a row per lag: labelled
    rows with ``part_col`` 'train' or 'test'.  Whole groups are kept or left
    and lie in one part; classes are balanced to the same number of groups
    (of the smallest digests), and exactly ``train_pct`` percent of each
    class's groups, rounded down but one at least, are for training.

    The labelled rows and their digests are written once; cuts are found on
    the much smaller table of groups and applied as literals, without a join.
    A group with rows of both classes is an error, as are thresholds that
    overlap and an empty class."""
    if delayed_threshold < on_time_threshold:
        raise ValueError(f"threshold {delayed_threshold} must be >= on-time threshold {on_time_threshold}")
    dcond = delayed_condition(ds_type, delayed_threshold, arr, weather, nas)
    ocond = on_time_condition(on_time_threshold, arr)
    label = F.when(dcond, F.lit(DELAYED_LABEL)).when(ocond, F.lit(ON_TIME_LABEL))
    rows = written(df.withColumn(label_col, label).where(F.col(label_col).isNotNull())
                   .withColumn("__g", S.md5_hex(*group_cols)), "labelled")
    groups = written(rows.groupBy(F.col(label_col).alias("label"), "__g").agg(F.count(F.lit(1)).alias("rows")), "groups")
    if not groups.groupBy("__g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("a group has rows of both classes")
    sizes = {r["label"]: r["n"] for r in groups.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    for value, name in ((DELAYED_LABEL, "delayed"), (ON_TIME_LABEL, "on-time")):
        if not sizes.get(value):
            raise ValueError(f"no {name} rows found")
    kept, part = F.lit(True), F.lit(None)
    # the two halves of a digest are independent: one balances, one splits
    split = F.concat(F.substring("__g", 17, 16), F.substring("__g", 1, 16))
    for value, n in sorted(sizes.items()):
        own = groups.where(F.col("label") == value)
        of_class = F.col(label_col) == value
        least = min(sizes.values())
        if balance and n > least:
            cut = _nth(own, F.col("__g"), least, n)
            own, n = own.where(_upto(_leading(F.col("__g")), F.col("__g"), cut)), least
            kept = kept & (~of_class | _upto(_leading(F.col("__g")), F.col("__g"), cut))
        n_train = max(1, n * train_pct // 100)
        chosen = F.lit("train")
        if n_train < n:
            cut = _nth(own, split, n_train, n)
            chosen = F.when(_upto(_leading(split), split, cut), "train").otherwise("test")
        part = F.when(of_class, chosen).otherwise(part)
    return rows.where(kept).select(*[S.qcol(c) for c in df.columns], label_col, part.alias(part_col))


def _nth(groups: DataFrame, digest: Column, n: int, total: int) -> str:
    """The digest of the n-th of ``total`` groups, which are distinct."""
    number = _leading(digest)
    return _cut(groups, number, digest, n, total, groups.agg(_sketch(number).alias("q")).first()["q"])[0]
