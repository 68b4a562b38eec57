"""Quality rules: base rules and robust multivariate outliers per language and source.

A text's statistics become a vector (``VECTOR``). For every (language, source)
the minimum covariance determinant estimate of centre and scatter is sought from
several deterministic starts, all around the medians: quartile ranges alone, and
with the correlations of hyperbolic tangents and of spatial signs. From each,
concentration steps keep the ``SHARE`` of the documents with the least
Mahalanobis distance and take their mean and covariance, until its determinant
falls no more; the start with the least determinant gives the estimate. A
document whose distance to its group's estimate exceeds the chi-square
``QUANTILE`` is rejected. Groups under ``MIN_ROWS`` documents use the language's
estimate, then that of all documents.

Only built-in functions are used. All documents that pass the base rules enter
the estimates; what is shuffled are counts and sums per group, so a hot source
costs no more than others, and the estimates hold one row per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import let, materialize, read_table, spaced_words

WINDOW = 5
#: Share of a group that a concentration step keeps, the most such steps, and the least fall of the determinant's
#: logarithm for which there is another one.
SHARE, STEPS, FALL = 0.75, 10, 1e-6
STARTS = 3
MIN_ROWS = 100
QUANTILE = 0.9999
#: Components: name, and the least standard deviation that is taken for it (statistics that are zero in most texts
#: have no spread of their own); small enough that every component can be beyond the limit by itself.
VECTOR = (("ln_words", 0.25), ("ln_word_length", 0.08), ("symbols", 0.5), ("repeated", 0.59), ("dup_lines", 0.75))
D = len(VECTOR)
#: Parts into which the rows of a group are dealt where they meet its estimate.
SALTS = 32
#: Width of a bin of a component, and bins per unit of the logarithm of a distance.
STEP, BINS = 0.01, 50


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


#: Makes the covariance of the kept share consistent for normal data.
CONSISTENCY = SHARE / chi2_cdf(chi2_quantile(SHARE, D), D + 2)
LIMIT = chi2_quantile(QUANTILE, D)


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside a window of ``WINDOW`` words that occurs twice or more in the text."""
    at = F.sequence(F.lit(1), n - (WINDOW - 1))

    def covered(grams):  # sorted (gram, position): equal neighbours are repeats
        size = F.size(grams)
        hits = F.filter(F.transform(grams, lambda g, i: F.when(
            ((i > 0) & (F.get(grams, i - 1)["g"] == g["g"]))
            | ((i + 1 < size) & (F.get(grams, i + 1)["g"] == g["g"])), g["p"])), lambda p: p.isNotNull())
        zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        return F.aggregate(F.array_sort(hits), zero, lambda s, p: F.struct(
            (s["total"] + p + WINDOW - F.greatest(p, s["end"])).alias("total"), (p + WINDOW).alias("end")),
            lambda s: s["total"])

    def from_words(w):
        def exact():
            grams = F.transform(at, lambda p: F.struct(F.concat_ws(" ", F.slice(w, p, WINDOW)).alias("g"),
                                                       p.alias("p")))
            return let(F.array_sort(grams), covered)

        def from_hashes(h):  # as many hashes as windows: no window is repeated
            keys = F.transform(at, lambda p: F.xxhash64(*[F.get(h, p + (k - 1)) for k in range(WINDOW)]))
            return F.size(F.array_distinct(keys)) == n - (WINDOW - 1)

        plain = let(F.transform(w, lambda x: F.xxhash64(x)), from_hashes)
        return F.when(n < WINDOW, 0).when(plain, 0).otherwise(exact())

    return let(words, from_words)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``q`` (struct): the counts of every whole text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs), and
    n_lines, the lines with a word. Null and empty texts have zeros.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    out = docs.withColumn("q_words", spaced_words(F.col(text_col))).withColumn("q_lines", lines)
    words, n = F.col("q_words"), F.size("q_words")
    q = F.struct(
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(words, n).cast("bigint").alias("n_repeat_words"),
        F.size("q_lines").cast("bigint").alias("n_lines"))
    return out.withColumn("q", q).drop("q_words", "q_lines")


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def vector(q: Column) -> list[Column]:
    """The transformed statistics, in the order of ``VECTOR``; defined for texts with a word."""
    words, chars = q["n_words"].cast("double"), q["word_chars"].cast("double")
    return [F.ln(1 + words), F.ln(chars / words), F.ln(1 + 100 * q["n_symbols"] / chars),
            F.ln(1 + 100 * q["n_repeat_words"] / words), F.ln(1 + 100 * q["n_dup_lines"] / q["n_lines"])]


def _key(level: int, lang: Column, source: Column) -> Column:
    """The group's name at a level (0: language and source, 1: language, 2: all); null is a value."""
    name = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in (lang, source)[: 2 - level]]
    return F.concat_ws("\x1f", F.lit(str(level)), *name)


def _decomposed(est: DataFrame) -> DataFrame:
    """From covariances ``c_ij`` the factors of L D L': ``l_ij``, and ``d_i``, at least the least spread; ``ld``: ln of the determinant."""
    for i in range(D):
        for j in range(i):
            rest = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") * F.col(f"d_{k}") for k in range(j)), F.lit(0.0))
            est = est.withColumn(f"l_{i}_{j}", (F.col(f"c_{i}_{j}") - rest) / F.col(f"d_{j}"))
        rest = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{i}_{k}") * F.col(f"d_{k}") for k in range(i)), F.lit(0.0))
        est = est.withColumn(f"d_{i}", F.greatest(F.col(f"c_{i}_{i}") - rest, F.lit(VECTOR[i][1] ** 2)))
    ld = sum((F.ln(F.col(f"d_{i}")) for i in range(D)), F.lit(0.0))
    return est.withColumn("ld", ld).select("key", "start", *FITTED)


#: Columns of an estimate: rows of the group, ln of the determinant, centre and factors.
FITTED = ["n", "ld", *[f"m_{i}" for i in range(D)], *[f"d_{i}" for i in range(D)],
          *[f"l_{i}_{j}" for i in range(D) for j in range(i)]]


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance of ``x`` to the estimate in the row's columns."""
    solved: list[Column] = []
    for i in range(D):
        y = x[i] - F.col(f"m_{i}")
        for k in range(i):
            y = y - F.col(f"l_{i}_{k}") * solved[k]
        solved.append(y)
    return sum((y * y / F.col(f"d_{i}") for i, y in enumerate(solved)), F.lit(0.0))


def _quantile_bins(counts: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """From (by, b, n): the least bin at which the running count reaches each share of the group."""
    run = counts.withColumn("run", F.sum("n").over(Window.partitionBy(*by).orderBy("b"))).withColumn(
        "all", F.sum("n").over(Window.partitionBy(*by)))
    return run.groupBy(*by).agg(F.max("all").alias("n"), *[
        F.min(F.when(F.col("run") >= share * F.col("all"), F.col("b"))).alias(name) for name, share in shares.items()])


def estimates(vectors: DataFrame) -> DataFrame:
    """MCD estimates of ``vectors(lang, source, x_0 ...)``, a row (key, n, ...) per group and level."""
    x = [F.col(f"x_{i}") for i in range(D)]
    keys = F.explode(F.array(*[_key(level, F.col("lang"), F.col("source")) for level in range(3)]))
    rows = vectors.select(keys.alias("key"), F.pmod(F.xxhash64(*x), F.lit(SALTS)).cast("int").alias("salt"), *x)
    rows = materialize(rows, "quality-vectors")

    def dealt(groups):  # a hot source's rows meet their estimate in SALTS tasks if the estimates are not broadcast
        return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    # medians and quartile ranges of each component, from exact counts per bin
    bins = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(c / STEP).alias("b")) for i, c in enumerate(x)]))
    counts = rows.select("key", bins.alias("v")).groupBy("key", "v.i", "v.b").agg(F.count(F.lit(1)).alias("n"))
    quart = _quantile_bins(counts, ["key", "i"], {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    mid, spread = STEP * (F.col("q2") + 0.5), STEP * (F.col("q3") - F.col("q1")) / 1.349
    least = F.element_at(F.array(*[F.lit(s) for _, s in VECTOR]), F.col("i") + 1)
    middle = materialize(quart.groupBy("key").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("i") == i, mid)).alias(f"m_{i}") for i in range(D)],
        *[F.max(F.when(F.col("i") == i, F.greatest(spread, least))).alias(f"s_{i}") for i in range(D)]), "quality-medians")

    # correlations of the starts: of tangents about their mean, of spatial signs about the median
    z = [(F.col(f"x_{i}") - F.col(f"m_{i}")) / F.col(f"s_{i}") for i in range(D)]
    size = F.greatest(F.sqrt(sum((c * c for c in z), F.lit(0.0))), F.lit(1e-12))
    near = rows.join(dealt(middle), ["key", "salt"]).select(
        "key", *[F.tanh(c).alias(f"t_{i}") for i, c in enumerate(z)], *[(c / size).alias(f"u_{i}") for i, c in enumerate(z)])
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    sums = near.groupBy("key").agg(*[F.avg(f"t_{i}").alias(f"a_{i}") for i in range(D)], *[
        F.avg(F.col(f"{v}_{i}") * F.col(f"{v}_{j}")).alias(f"{v}_{i}_{j}") for v in "tu" for i, j in pairs])
    for i, j in pairs:
        sums = sums.withColumn(f"t_{i}_{j}", F.col(f"t_{i}_{j}") - F.col(f"a_{i}") * F.col(f"a_{j}"))

    def scatter(start, i, j):  # with the quartile ranges as spreads
        scale = F.col(f"s_{i}") * F.col(f"s_{j}")
        if i == j or not start:
            return scale * float(i == j)
        v = "tu"[start - 1]
        norm = F.col(f"{v}_{i}_{i}") * F.col(f"{v}_{j}_{j}")
        return F.when(norm > 1e-12, scale * F.col(f"{v}_{i}_{j}") / F.sqrt(norm)).otherwise(0.0)

    starts = F.explode(F.array(*[F.struct(F.lit(s).alias("start"), *[
        scatter(s, i, j).alias(f"c_{i}_{j}") for i, j in pairs]) for s in range(STARTS)]))
    est = middle.join(sums, "key").select("key", "n", *[f"m_{i}" for i in range(D)], starts.alias("v")).select(
        "key", "n", *[f"m_{i}" for i in range(D)], "v.*")
    est = materialize(_decomposed(est).withColumn("ld", F.lit(1e300)), "quality-estimates")  # not of any share of the rows
    for _ in range(STEPS):
        near = rows.join(dealt(est), ["key", "salt"]).select("key", "start", "salt", "n", *x, F.floor(
            BINS * F.ln(F.greatest(F.lit(1e-6), F.least(F.lit(1e6), _distance(x))))).alias("b"))
        cut = _quantile_bins(near.groupBy("key", "start", "b").agg(F.count(F.lit(1)).alias("n")), ["key", "start"], {"cut": SHARE})
        cut = materialize(cut, "quality-cuts")  # of known size: a small one is broadcast, no group meets in one task
        kept = near.drop("n").join(dealt(cut), ["key", "start", "salt"]).filter(F.col("b") <= F.col("cut"))
        sums = kept.groupBy("key", "start").agg(
            F.max("n").alias("n"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(x)],
            *[F.avg(x[i] * x[j]).alias(f"c_{i}_{j}") for i, j in pairs])
        for i, j in pairs:
            sums = sums.withColumn(f"c_{i}_{j}", CONSISTENCY * (F.col(f"c_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")))
        new = _decomposed(sums).select("key", "start", F.struct(*FITTED).alias("new"))
        both = est.select("key", "start", F.struct(*FITTED).alias("old")).join(new, ["key", "start"])
        falls = F.col("new.ld") < F.col("old.ld") - FALL
        both = materialize(both.select("key", "start", F.when(falls, F.col("new")).otherwise(F.col("old")).alias("fit"),
                                       falls.alias("falls")), "quality-estimates")
        est = both.select("key", "start", "fit.*")
        if both.filter("falls").isEmpty():
            break
    best = est.groupBy("key").agg(F.min(F.struct("ld", "start", F.struct(*FITTED).alias("fit"))).alias("best"))
    return materialize(best.select("key", "best.fit.*"), "quality-estimates")


def judge(rows: DataFrame, est: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` (with ``q``) plus base_failed, distance (null if base_failed or no estimate) and kept."""
    x = vector(F.col("q"))
    fits = est.filter((F.col("n") >= MIN_ROWS) | F.col("key").startswith("2"))
    out = rows.withColumn("base_failed", base_failed(F.col("q")))
    for level in range(3):
        named = fits.filter(F.col("key").startswith(str(level))).withColumnRenamed("key", "mcd_key")
        held = F.struct(*[c for c in named.columns if c != "mcd_key"])
        out = out.join(named.select("mcd_key", held.alias(f"mcd_{level}")),
                       _key(level, F.col(lang), F.col(source)) == F.col("mcd_key"), "left").drop("mcd_key")
    out = out.withColumn("mcd", F.coalesce("mcd_0", "mcd_1", "mcd_2")).drop("mcd_0", "mcd_1", "mcd_2")
    cols = rows.columns
    out = out.select(*cols, "base_failed", "mcd.*")
    distance = F.when(~F.col("base_failed"), _distance(x))
    return out.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= LIMIT)).select(
        *cols, "base_failed", "distance", "kept")


def _vectors(stats: DataFrame, lang: str, source: str) -> DataFrame:
    x = vector(F.col("q"))
    return stats.filter(~base_failed(F.col("q"))).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), *[c.alias(f"x_{i}") for i, c in enumerate(x)])


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """(id, q, base_failed, distance, kept): one row per row of ``docs``.

    Null language and null source are groups of their own; a text of fewer than
    10 words fails the base rules; repeated rows and null ids are kept; other
    columns are not read; an empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                       F.col(text_col).alias("text"))
    stats = materialize(with_statistics(slim).drop("text"), "quality-stats")
    return judge(stats, estimates(_vectors(stats, "lang", "source"))).select(
        "id", "q", "base_failed", "distance", "kept")


def quality_filter(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged (names with ``q``, ``kept`` and so on may clash).

    The rows are stored with their statistics, which takes less than counting twice.
    """
    names = docs.columns
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"),
                        *[docs[f"`{c}`"].alias(n) for c, n in ((text_col, "text"), (lang, "lang"), (source, "source"))])
    stats = materialize(with_statistics(whole).drop("text"), "quality-rows")
    return judge(stats, estimates(_vectors(stats, "lang", "source"))).filter("kept").select("row.*")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    out = quality_report(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), *[f"q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")
