"""Quality rules and robust multivariate outliers (native).

Base statistics come from the whole text; rows that fail a base rule are rejected. All others are given as vectors of
transformed statistics, and for each language and source the minimum covariance determinant is estimated: from several fixed starts,
concentration steps keep the ``share`` of rows with the smallest distances and take mean and covariance of those. Each cell and
start goes on while its determinant falls, keeps the state of the smallest one and then drops out; each cell keeps the start that
ends with the smallest. Determinants have a least value, so every cell comes to rest, and none ever rises. Reweighting once by the
97.5 % quantile gives the final estimates; a row is rejected if its Mahalanobis distance exceeds the ``cutoff`` quantile.

A concentration step is one aggregation: rows are summed up by cell and distance bin (map-side, so a hot cell is no larger
than its bins), bins are accumulated up to the share, and mean and covariance follow from those sums. Bins are whole, so
rows of equal distance are never parted. Variances have a least value per statistic, which keeps a statistic that is
constant in most rows (no symbols at all, say) from making every other value an outlier; larger ones stay as they are.

Cells with fewer than ``least`` rows borrow the estimates of their language, small languages those of all rows.

Defined results: null text counts as empty and fails the base rules; a null language or source is a value of its own;
repeated rows are judged alike; no row that passes the base rules means no estimates and no rows rejected by distance; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import SPACES, fresh, named, staged

SYMBOLS = "#*$%&|<>"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Least spread of a transformed statistic: one unit is a factor of e. The first two are hardly ever constant.
LEAST_SPREADS = (0.1, 0.05, 0.5, 0.7, 0.7)
#: One sound row in a thousand lies beyond this quantile.
USUAL_CUTOFF = 0.999
#: Starts besides medians and all rows: rows whose hash ends in the start's number.
HASH_STARTS, HASH_PARTS = 2, 8
#: A step counts as one downwards if the logarithm of the determinant falls by more.
SETTLED = 1e-6
P = len(LEAST_SPREADS)
BINS_PER_E = 16
BINS_PER_UNIT = 64
SLICE_ROWS = 100_000
LEAST_DISTANCE = 1e-6
X = [f"x{i}" for i in range(P)]
LOWER_CELLS = [(i, j) for i in range(P) for j in range(i + 1)]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated 3-word windows: each window is a long whose low bits hold its place and whose high bits hold its hash. Sorted,
    equal windows are neighbours; neighbours with equal hash bits are then compared word by word.
    """
    blank = F.lit(SPACES)
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"), named(lang_col).cast("string").alias("lang"),
        named(source_col).cast("string").alias("source"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("body"),
    )
    split = rows.select(
        "doc_id", "lang", "source", F.filter(F.split(F.btrim("body", blank), SPACE_RUN), lambda w: w != "").alias("words"),
        F.length(F.regexp_replace("body", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("body", "\n"), lambda line: F.btrim(line, blank) != "").alias("lines"),
    )
    counted = split.select(
        "doc_id", "lang", "source", "words", F.size("words").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    ).withColumn("hash_bits", F.call_function("shiftleft", F.lit(-1).cast("long"), F.length(F.bin(F.col("n_words").cast("long")))))
    words = F.col("words")
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    keyed = counted.withColumn("windows", F.sort_array(F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - 3), lambda i: window(i).bitwiseAND(F.col("hash_bits")).bitwiseOR(i.cast("long")),
    )).otherwise(F.array().cast("array<bigint>"))))

    def same(x: Column, y: Column) -> Column:
        i, j = (v.bitwiseAND(F.bitwise_not("hash_bits")).cast("int") for v in (x, y))
        alike = x.bitwiseXOR(y).bitwiseAND(F.col("hash_bits")) == 0
        for k in range(3):
            alike = alike & (F.get(words, i + k) == F.get(words, j + k))
        return alike

    again = F.filter("windows", lambda x, i: same(x, F.get("windows", i - 1)) | same(x, F.get("windows", i + 1)))
    starts = F.transform(again, lambda x: x.bitwiseAND(F.bitwise_not("hash_bits")))
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda at: F.array(at, at + 1, at + 2)))))
    return keyed.select(
        "doc_id", "lang", "source", F.col("n_words").cast("long"), "word_chars", "n_symbols", "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics: length, word length, symbols, repeated lines, repeated words."""
    return [
        F.log(F.col("n_words")), F.log(F.col("word_chars") / F.col("n_words")),
        F.log1p(1000 * F.col("n_symbols") / F.col("word_chars")),
        F.log1p(1000 * F.col("n_dup_lines") / F.col("n_words")),
        F.log1p(100 * F.col("n_repeat_words") / F.col("n_words")),
    ]


def chi_square_cdf(x: float, df: int) -> float:
    a, half = df / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi_square_quantile(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, df) < p else (low, middle)
    return high


def _consistency(share: float) -> float:
    """What the covariance of the innermost share of normal rows must be multiplied with."""
    return share / chi_square_cdf(chi_square_quantile(share, P), P + 2)


def _cells(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``cell``: language and source, or language, or all, whichever has ``least`` rows first."""
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    keys = rows.withColumn("of_lang", tag("lang")).withColumn("of_source", F.concat("of_lang", F.lit(" "), tag("source")))
    counts = keys.groupBy("of_lang", "of_source").agg(F.count(F.lit(1)).alias("n"))
    langs = counts.groupBy("of_lang").agg(F.sum("n").alias("n_lang"))
    cells = counts.join(langs, "of_lang").select(
        "of_lang", "of_source",
        F.when(F.col("n") >= least, F.col("of_source")).when(F.col("n_lang") >= least, F.col("of_lang")).otherwise("").alias("cell"),
    )
    return keys.join(staged(cells, "rule-cells"), ["of_lang", "of_source"]).drop("of_lang", "of_source")


def _levels(rows: DataFrame, slice_rows: int) -> DataFrame:
    """Each row once for every cell it helps to estimate: its source, its language, all rows.

    A cell is dealt out in slices of about ``slice_rows`` rows, so a join with its estimates never gathers a large cell.
    """
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    cells = F.array(F.concat(tag("lang"), F.lit(" "), tag("source")), tag("lang"), F.lit(""))
    levels = rows.select(F.explode(cells).alias("cell"), *X)
    slices = levels.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    return levels.join(slices, "cell").withColumn("slice", F.pmod(F.xxhash64(*X), F.col("slices")).cast("int"))


def _histogram(values: DataFrame) -> DataFrame:
    """cell, dim, v, n: counts of values, each value moved to the middle of its bin."""
    bins = values.groupBy("cell", "dim", F.floor(F.col("v") * BINS_PER_UNIT).alias("bin")).agg(F.sum("n").alias("n"))
    return bins.select("cell", "dim", ((F.col("bin") + 0.5) / BINS_PER_UNIT).alias("v"), "n")


def _binned_median(histogram: DataFrame) -> DataFrame:
    """cell, dim, m: the value of the bin that holds the middle row."""
    upto = Window.partitionBy("cell", "dim").orderBy("v")
    run = histogram.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("cell", "dim")))
    middle = run.where((2 * F.col("upto") >= F.col("all")) & (2 * (F.col("upto") - F.col("n")) < F.col("all")))
    return middle.select("cell", "dim", F.col("v").alias("m"))


def _floored(variance: Column, i: int) -> Column:
    return F.greatest(variance, F.lit(LEAST_SPREADS[i] ** 2))


def _start(levels: DataFrame) -> DataFrame:
    """cell, m0.., w00..: medians and inverse median deviations, without correlations. Rows are read once, into bins."""
    bins = staged(_histogram(levels.select("cell", F.posexplode(F.array(*X)).alias("dim", "v"), F.lit(1).cast("long").alias("n"))), "mcd-bins")
    medians = _binned_median(bins)
    spreads = _binned_median(_histogram(
        bins.join(medians, ["cell", "dim"]).select("cell", "dim", F.abs(F.col("v") - F.col("m")).alias("v"), "n")))
    both = medians.join(spreads.withColumnRenamed("m", "s"), ["cell", "dim"])
    pick = lambda c, d: F.max(F.when(F.col("dim") == d, F.col(c)))
    wide = both.groupBy("cell").agg(*[pick("m", d).alias(f"m{d}") for d in range(P)], *[pick("s", d).alias(f"s{d}") for d in range(P)])
    inverse = [
        (1 / F.sqrt(_floored(F.pow(1.4826 * F.col(f"s{i}"), 2), i)) if i == j else F.lit(0.0)).alias(f"w{i}{j}")
        for i, j in LOWER_CELLS
    ]
    return wide.select("cell", *[f"m{i}" for i in range(P)], *inverse)


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with their squared Mahalanobis distance ``d2`` under their cell's estimates."""
    centred = [F.col(X[j]) - F.col(f"m{j}") for j in range(P)]
    y = [sum((F.col(f"w{i}{j}") * centred[j] for j in range(i + 1)), F.lit(0.0)) for i in range(P)]
    joined = rows.join(estimates, [c for c in ("cell", "slice") if c in estimates.columns])
    return joined.select(*rows.columns, *[c for c in ("start",) if c in estimates.columns], sum((c * c for c in y), F.lit(0.0)).alias("d2"))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in LOWER_CELLS]]


def _estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Mean, inverse Cholesky factor and log determinant of factor x covariance with its floors, from sums, column by column."""
    keys = [c for c in ("cell", "start") if c in sums.columns]
    mean = sums.select(*keys, *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)],
                       *[(F.col(f"q{i}{j}") / F.col("n")).alias(f"q{i}{j}") for i, j in LOWER_CELLS])
    spread = lambda i, j: F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")
    out = mean.withColumns({
        f"a{i}{j}": _floored(factor * F.greatest(spread(i, j), F.lit(0.0)), i) if i == j else factor * spread(i, j) for i, j in LOWER_CELLS
    })
    for j in range(P):
        rest = lambda i: F.col(f"a{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))  # noqa: B023, E731
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest(j), F.lit(1e-9))))
        out = out.withColumns({f"l{i}{j}": rest(i) / F.col(f"l{j}{j}") for i in range(j + 1, P)}) if j + 1 < P else out
    for i in range(P):
        out = out.withColumns({
            f"w{i}{j}": (1 / F.col(f"l{i}{i}") if i == j else
                         -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}"))
            for j in range(i + 1)
        })
    log_det = sum((2 * F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)).alias("log_det")
    return out.select(*keys, *[f"m{i}" for i in range(P)], *[f"w{i}{j}" for i, j in LOWER_CELLS], log_det)


def _concentrate(levels: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One concentration step: estimates from the bins of smallest distance that hold ``share`` of a cell's rows."""
    far = _distance(levels, estimates).withColumn("bin", F.floor(BINS_PER_E * F.log(F.greatest("d2", F.lit(LEAST_DISTANCE)))))
    keys = [c for c in ("cell", "start") if c in far.columns]
    bins = far.groupBy(*keys, "bin").agg(*_sums())
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ["n", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in LOWER_CELLS]]
    run = bins.select(*keys, F.col("n").alias("own"), F.sum("n").over(Window.partitionBy(*keys)).alias("all"),
                      *[F.sum(c).over(upto).alias(c) for c in totals])
    last = run.where((F.col("n") >= share * F.col("all")) & (F.col("n") - F.col("own") < share * F.col("all")))
    return _estimates(last, _consistency(share))


def _starts(levels: DataFrame) -> DataFrame:
    """Estimates of every cell and start: medians (0), all rows (1), rows of some hashes (2 and on; cells without any lack it)."""
    part = F.pmod(F.xxhash64(F.lit("start"), *X), F.lit(HASH_PARTS))
    taken = F.array(F.lit(1), F.when(part < HASH_STARTS, (part + 2).cast("int")))
    sums = levels.select("cell", F.explode(F.filter(taken, lambda s: s.isNotNull())).alias("start"), *X).groupBy("cell", "start").agg(*_sums())
    others = _estimates(sums, 1.0).drop("log_det")
    return _start(levels).withColumn("start", F.lit(0)).unionByName(others)


def _settled(levels: DataFrame, slices: DataFrame, share: float) -> DataFrame:
    """Concentrated estimates: each cell and start while its determinant falls, then of each cell those of the smallest."""
    live = staged(_concentrate(levels, staged(_starts(levels), "mcd-start").join(slices, "cell"), share), "mcd-step")
    columns = [c for c in live.columns if c not in ("cell", "start")]
    rested = []
    while not live.isEmpty():
        now = live.select("cell", "start", F.struct(*columns).alias("now"))
        after = _concentrate(levels, live.drop("log_det").join(slices, "cell"), share).select("cell", "start", F.struct(*columns).alias("after"))
        both = staged(now.join(after, ["cell", "start"], "left").withColumn(
            "falls", F.coalesce(F.col("after.log_det") < F.col("now.log_det") - SETTLED, F.lit(False))), "mcd-step")
        rested.append(both.where("not falls").select("cell", "start", "now.*"))
        live = both.where("falls").select("cell", "start", "after.*")
    if not rested:
        return live.drop("start")
    every = reduce(DataFrame.unionAll, rested)
    best = every.groupBy("cell").agg(F.min_by(F.struct(*columns), F.struct(F.round("log_det", 6), "start")).alias("best"))
    return staged(best.select("cell", "best.*"), "mcd-best")


def robust_estimates(vectors: DataFrame, share: float, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """cell, mean and inverse factor, for every language and source, every language, and all rows."""
    levels = staged(_levels(vectors, slice_rows), "mcd-levels")
    slices = staged(levels.select("cell", "slice").distinct(), "mcd-slices")
    estimates = _settled(levels, slices, share)
    inner = _distance(levels, estimates.join(slices, "cell")).where(F.col("d2") <= chi_square_quantile(0.975, P))
    return staged(_estimates(inner.groupBy("cell").agg(*_sums()), _consistency(0.975)), "mcd-final")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             share: float = 0.75, cutoff: float = USUAL_CUTOFF, least: int = 100) -> DataFrame:
    """One row per input row: doc_id, the base statistics, base_failed, kept and the squared distance (null if base_failed)."""
    rows = staged(
        statistics(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", base_failed()), "rule-statistics")
    sound = rows.where(~F.col("base_failed")).withColumns(dict(zip(X, vector())))
    estimates = robust_estimates(sound.select("lang", "source", *X), share)
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _distance(_cells(sound, least).select(*out, "cell", *X), estimates)
    judged = judged.select(*out, (F.col("d2") <= chi_square_quantile(cutoff, P)).alias("kept"), F.col("d2").alias("distance"))
    failed = rows.where("base_failed").select(*out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.unionByName(failed)


def sound_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are kept; a row without an id can't be named by a verdict and goes."""
    key = fresh(docs, "sound_id")
    kept = verdicts(docs, id_col, **options).where("kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(kept, named(id_col).cast("long") == F.col(key), "left_semi")
