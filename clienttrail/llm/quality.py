"""Quality rules: base rules, then robust multivariate outliers per language and source.

Everything is DataFrame expressions. Word statistics are array functions within the row, so texts are
never shuffled. Minimum-covariance-determinant estimates are found with concentration steps: distances
under the current estimate are binned, counts and moments are summed for each pool and bin (combined
before they shuffle), and the bins with the nearest three quarters of a pool give the next estimate.
Statistics are whole 1024ths, so that their sums are exact and the result does not depend on the order
in which tasks finish.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Rows an estimate of its own takes; smaller sources share one in their language, or where they have fewer
#: rows together, are judged by that of all its rows. Languages with fewer rows are judged by that of all rows.
POOL_ROWS = 100
#: Share of a pool that estimates rest on, and concentration steps from each of the two starts.
CORE, STEPS = 0.75, 5
UNIT = 1024
#: Least standard deviation of each statistic (in its own unit): variances are raised by its square, so
#: that a statistic that hardly varies in a pool does not condemn small differences. In a pool without any,
#: symbols beyond 7 % of the characters, or duplicate lines or repeated words beyond 12 % of the words, are
#: rejected: floors times the root of CUTOFF stay well within each statistic's range.
FLOORS = {"length": 0.1, "symbols": 0.4, "lines": 0.5, "repeats": 0.5, "size": 0.8}
#: Squared distance beyond which a text is rejected: the chi-square quantile of five degrees of freedom
#: at one in ten thousand.
CUTOFF = 25.74
#: Median of the chi-square distribution with five degrees of freedom.
MEDIAN = 4.351
BINS_PER_UNIT = 256

_NAMES = list(FLOORS)
_SIZE = len(_NAMES)


def text_statistics(documents: DataFrame, *extra: str) -> DataFrame:
    """doc_id, the extra columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Words are runs of other than the six ASCII white-space characters; a null text has none. Word windows
    are found by hash and place packed in one long, and those found twice are compared by their words.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    columns = ["doc_id", *extra]
    cut = documents.select(
        *columns,
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    columns += ["words", "n_symbols"]
    cut = cut.select(
        *columns,
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").alias("n"),
        F.length(F.bin(F.size("words").cast("long"))).cast("int").alias("bits"),
    )
    columns += ["n_dup_lines", "n", "bits"]
    # Hash and place of each window of three words, by hash.
    packed = cut.select(
        *columns,
        F.expr(
            "sort_array(if(n < 3, cast(array() as array<bigint>), transform(sequence(0, n - 3), i -> "
            "shiftleft(xxhash64(words[i], words[i + 1], words[i + 2]), bits) | cast(i as bigint))))"
        ).alias("packed"),
    )
    twice = packed.select(
        *columns,
        F.expr(
            "transform(filter(packed, (x, i) -> shiftright(x, bits) = shiftright(get(packed, i + 1), bits)"
            " or shiftright(x, bits) = shiftright(get(packed, i - 1), bits)),"
            " x -> cast(x & (shiftleft(1L, bits) - 1) as int))"
        ).alias("places"),
    )
    # Words hold no space, so joined windows are equal only if their words are.
    windows = twice.select(
        *columns,
        F.expr(
            "sort_array(transform(places, p -> struct("
            "concat(words[p], ' ', words[p + 1], ' ', words[p + 2]) as window, p as place)))"
        ).alias("windows"),
    )
    repeated = windows.select(
        *columns,
        F.expr(
            "sort_array(transform(filter(windows, (x, i) -> x.window = get(windows, i + 1).window"
            " or x.window = get(windows, i - 1).window), x -> x.place))"
        ).alias("starts"),
    )
    return repeated.select(
        "doc_id",
        *extra,
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.expr(
            "aggregate(transform(starts, (p, i) -> least(3, coalesce(get(starts, i + 1) - p, 3))),"
            " 0L, (total, covered) -> total + covered)"
        ).alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    """Transformed statistics in whole units, for rows with words."""
    words = F.col("n_words")
    share = {
        "length": F.log(F.col("word_chars") / words),
        "symbols": F.log1p(F.lit(100) * F.col("n_symbols") / F.col("word_chars")),
        "lines": F.log1p(F.lit(100) * F.col("n_dup_lines") / words),
        "repeats": F.log1p(F.lit(100) * F.col("n_repeat_words") / words),
        "size": F.log(words),
    }
    return [F.round(share[n] * UNIT).cast("long").alias(n) for n in _NAMES]


def _pooled(rows: DataFrame) -> DataFrame:
    """Add pool, whole and all_pool.

    pool: language and source, or the language's small sources, or if those are too few the whole language,
    or if that is too small as well, all rows. whole: the pool of the whole language where some rows need it.
    all_pool: the pool of all rows if a language needs it, else null.
    """
    lang = F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("none"))
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("none"))
    own = F.to_json(F.array(lang, source))
    keyed = rows.withColumn("own", own).withColumn("rest", F.to_json(F.array(lang)))
    judged = keyed.where("not base_failed")
    counts = stored(judged.groupBy("own", "rest").agg(F.count("*").alias("n")), "pool-sizes")
    lacking = counts.groupBy("rest").agg(F.sum("n").alias("n")).where(F.col("n") < POOL_ROWS)
    everything = F.lit(None if lacking.isEmpty() else "everything").cast("string")
    small = counts.withColumn("pool", F.when(F.col("n") >= POOL_ROWS, F.col("own")))
    rest_rows = F.sum(F.when(F.col("pool").isNull(), F.col("n"))).over(Window.partitionBy("rest"))
    all_rows = F.sum("n").over(Window.partitionBy("rest"))
    needed = (F.col("rest_rows") < POOL_ROWS) & (F.col("all_rows") >= POOL_ROWS)
    whole = F.when(needed, F.concat(F.lit("whole"), F.col("rest")))
    pools = small.withColumns({"rest_rows": rest_rows, "all_rows": all_rows}).select(
        F.col("own").alias("of"),
        F.coalesce("pool", F.when(F.col("rest_rows") >= POOL_ROWS, F.col("rest")), whole, everything).alias("pool"),
        whole.alias("whole"),
    )
    joined = keyed.join(pools, F.col("own") == F.col("of"), "left")
    return joined.select(*rows.columns, "pool", "whole", everything.alias("all_pool"))


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(_SIZE) for j in range(i + 1)]


def _moments(weighted: bool) -> list[Column]:
    """Sums of counts, statistics and products: of rows, or of such sums."""
    if weighted:
        names = ["n", *_NAMES, *[f"p{i}{j}" for i, j in _pairs()]]
        return [F.sum(n).alias(n) for n in names]
    products = [
        F.sum(F.col(_NAMES[i]) * F.col(_NAMES[j])).alias(f"p{i}{j}") for i, j in _pairs()
    ]
    return [F.count("*").alias("n"), *[F.sum(n).alias(n) for n in _NAMES], *products]


def _estimate(moments: DataFrame, *keys: str) -> DataFrame:
    """Means m_i and the Cholesky factor l_ij of the raised covariance, from exact sums."""
    out = moments.select(
        *keys,
        *[(F.col(n) / F.col("n")).alias(f"m{i}") for i, n in enumerate(_NAMES)],
        *[(F.col(f"p{i}{j}") / F.col("n")).alias(f"e{i}{j}") for i, j in _pairs()],
    )
    covariance = {}
    for i, j in _pairs():
        value = F.col(f"e{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")
        covariance[i, j] = value + F.lit((UNIT * FLOORS[_NAMES[i]]) ** 2) if i == j else value
    out = out.withColumns({f"c{i}{j}": covariance[i, j] for i, j in _pairs()})
    return _factor(out, *keys)


def _factor(covariances: DataFrame, *keys: str) -> DataFrame:
    out = covariances
    for j in range(_SIZE):
        done = [F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        pivot = reduce(lambda a, b: a - b, done, F.col(f"c{j}{j}"))
        # Rounding can take no more than a little from a variance that was raised.
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(pivot, F.lit(1.0))))
        below = {}
        for i in range(j + 1, _SIZE):
            done = [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)]
            below[f"l{i}{j}"] = reduce(lambda a, b: a - b, done, F.col(f"c{i}{j}")) / F.col(f"l{j}{j}")
        if below:
            out = out.withColumns(below)
    volume = reduce(add, [F.log(f"l{i}{i}") for i in range(_SIZE)])
    kept = [f"m{i}" for i in range(_SIZE)] + [f"l{i}{j}" for i, j in _pairs()]
    return out.select(*keys, *kept, volume.alias("volume"))


def _with_distance(rows: DataFrame) -> DataFrame:
    """Add the squared Mahalanobis distance of rows joined with their estimate."""
    out = rows
    for i in range(_SIZE):
        moved = [F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)]
        left = reduce(lambda a, b: a - b, moved, F.col(_NAMES[i]) - F.col(f"m{i}"))
        out = out.withColumn(f"z{i}", left / F.col(f"l{i}{i}"))
    return out.withColumn("distance", reduce(add, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(_SIZE)]))


def _binned(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Moments of each pool's rows by start and distance bin, stored."""
    bin_ = F.floor(F.log1p("distance") * BINS_PER_UNIT).cast("int").alias("bin")
    rows = _with_distance(vectors.join(estimates, "pool"))
    keyed = rows.select("pool", "start", bin_, *_NAMES)
    return stored(keyed.groupBy("pool", "start", "bin").agg(*_moments(False)), "bins")


def _nearest(bins: DataFrame, share: float) -> DataFrame:
    """The nearest bins that hold at least the share of each pool's rows."""
    pool = Window.partitionBy("pool", "start")
    before = F.sum("n").over(
        pool.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = bins.withColumn("before", F.coalesce(before, F.lit(0))).withColumn(
        "rows", F.sum("n").over(pool)
    )
    return marked.where(F.col("before") < F.col("rows") * share)


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """Per pool: the estimate of least determinant from two starts, and scale.

    Starts: medians with median absolute deviations, and the moments of all rows. scale is the median
    squared distance over the chi-square median, at least 1.
    """
    middle = stored(
        vectors.groupBy("pool").agg(*[F.percentile(n, 0.5).alias(f"m{i}") for i, n in enumerate(_NAMES)]),
        "medians",
    )
    spread = vectors.join(middle, "pool").groupBy("pool").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(_SIZE)],
        *[
            F.percentile(F.abs(F.col(n) - F.col(f"m{i}")), 0.5).alias(f"d{i}")
            for i, n in enumerate(_NAMES)
        ],
    )
    diagonal = {
        f"c{i}{j}": F.pow(F.col(f"d{i}") * 1.4826, 2) + F.lit((UNIT * FLOORS[_NAMES[i]]) ** 2)
        if i == j
        else F.lit(0.0)
        for i, j in _pairs()
    }
    by_median = _factor(spread.withColumns(diagonal).withColumn("start", F.lit(0)), "pool", "start")
    moments = vectors.groupBy("pool").agg(*_moments(False)).withColumn("start", F.lit(1))
    by_moments = _estimate(moments, "pool", "start")
    estimates = stored(by_median.unionByName(by_moments), "estimates")
    for _ in range(STEPS):
        core = _nearest(_binned(vectors, estimates), CORE)
        sums = core.groupBy("pool", "start").agg(*_moments(True))
        estimates = stored(_estimate(sums, "pool", "start"), "estimates")
    bins = _binned(vectors, estimates)
    middle_bin = _nearest(bins, 0.5).groupBy("pool", "start").agg(F.max("bin").alias("bin"))
    scale = F.greatest(F.lit(1.0), F.expr(f"expm1((bin + 1) / {BINS_PER_UNIT}D) / {MEDIAN}"))
    scaled = estimates.join(middle_bin.select("pool", "start", scale.alias("scale")), ["pool", "start"])
    first = F.row_number().over(Window.partitionBy("pool").orderBy("volume", "start"))
    best = scaled.withColumn("place", first).where("place = 1")
    return stored(best.drop("place", "start", "volume"), "best-estimates")


def judge_quality(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, the five statistics, base_failed, kept, distance.

    base_failed: fewer than 50 words, or over half the words in repeated windows. Others are rejected if
    their squared distance under the estimate of their pool (language and source, or more of the language, or
    all rows), over its scale, exceeds CUTOFF. Null languages and sources are values of their own. distance is
    null for failed rows alone: null and empty texts are among them. Texts are read whole, of any length; rows
    that are repeated or have equal statistics are each judged, alike; an empty table gives no rows.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )
    rows = stored(
        text_statistics(documents, "lang", "source").withColumn("base_failed", failed), "statistics"
    )
    pooled = stored(
        _pooled(rows).select("*", *[F.when(~F.col("base_failed"), v).alias(n) for v, n in zip(_vector(), _NAMES)]),
        "pooled",
    )
    # Rows of large sources count in the whole language too where others need its estimate, and so on.
    pools = F.explode(F.array_distinct(F.array_compact(F.array("pool", "whole", "all_pool"))))
    vectors = pooled.where("not base_failed").select(pools.alias("pool"), *_NAMES)
    best = robust_estimates(vectors)
    judged = _with_distance(pooled.join(best.withColumnRenamed("pool", "of"), F.col("pool") == F.col("of"), "left"))
    distance = F.when(~F.col("base_failed"), F.col("distance") / F.col("scale"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= CUTOFF)).alias("kept"),
        distance.alias("distance"),
    )


def op1_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read_table(spark, sf_dir, "documents")).drop("distance")
