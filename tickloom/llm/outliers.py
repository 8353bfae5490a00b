"""Quality rules with robust multivariate outliers.

Word and line statistics of whole texts feed two base rules and, transformed to comparable scales, a vector. For
every (language, source) the minimum covariance determinant estimate is found over all of its rows: from medians and
absolute deviations, concentration steps keep the (n + d + 1) / 2 rows with the smallest Mahalanobis distance and take their
mean and covariance, until the determinant stops falling; the best of three starts stays. A document far outside is rejected. All steps are Spark
aggregations over a narrow table, so a group of any size is never gathered; only the matrix of each group is
inverted, one row a group. Groups with few rows use the estimate of their language, small languages that of all rows.
"""
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, read, stage

SPACE = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper"]
#: The vector and, per part, the smallest deviation it is measured with: it keeps constant parts from making
#: every small difference an outlier.
VECTOR = {"x_words": 0.6, "x_length": 0.08, "x_symbols": 0.06, "x_lines": 0.12, "x_repeats": 0.15, "x_variety": 0.05, "x_upper": 0.06}
#: Median and 0.99999 quantile of the chi-square distribution with one degree per part of the vector.
CHI_MEDIAN, CHI_CUT = 6.346, 35.0
#: Concentration steps end when no logarithm of a determinant falls by more than this, or after so many.
FALL, STEPS = 1e-3, 30
#: Rows a group needs for an estimate of its own.
MIN_ROWS = 60
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ANY = "\u0001"


def text_stats(raw):
    """The numbers of ``STATS`` for the UTF-8 bytes of a text."""
    words = raw.split()
    n = len(words)
    chars = len(raw.translate(None, SPACE + CONTINUATION))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        runs = list(zip(words, words[1:], words[2:]))
        if len(set(runs)) < len(runs):
            seen = Counter(runs)
            hit = np.fromiter((seen[r] > 1 for r in runs), bool, len(runs))
            inside = np.zeros(n, bool)
            for k in range(3):
                inside[k:n - 2 + k] |= hit
            repeated = int(inside.sum())
    upper = sum(w.isupper() for w in words)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(set(words)), upper


def with_stats(docs, text="text", keep=None):
    """``docs[keep]`` with the columns of ``STATS``; a null text counts as empty."""
    def run(batch):
        rows = [text_stats(x or b"") for x in batch.column(text).cast(pa.binary()).to_pylist()]
        return [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(STATS))]

    return append(docs, run, [T.StructField(c, T.LongType()) for c in STATS], keep)


def _vector():
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of: F.sqrt(F.col(c) / F.greatest(of, F.lit(1)))
    return {"x_words": F.log1p("n_words"), "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            "x_symbols": share("n_symbols", F.col("word_chars")), "x_lines": F.sqrt(F.least(F.col("n_dup_lines") * 10 / n, F.lit(1.0))),
            "x_repeats": share("n_repeat_words", n), "x_variety": F.log1p("n_distinct") / F.log1p(n), "x_upper": share("n_upper", n)}


def _invert(moments):
    """Per group and start from sums to the centre, the inverse of the covariance with the smallest deviations added and
    the logarithm of its determinant."""
    d, floors = len(VECTOR), np.array(list(VECTOR.values()))

    def run(frames):
        for f in frames:
            out = []
            for n, s, ss in zip(f["n"], f["s"], f["ss"]):
                mean = np.asarray(s) / n
                cov = np.zeros((d, d))
                cov[np.triu_indices(d)] = np.asarray(ss) / n
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean) + np.diag(floors ** 2)
                out.append((mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame({"g": f["g"], "start": f["start"], "centre": [m for m, _, _ in out], "inverse": [i for _, i, _ in out], "det": [x for _, _, x in out]})

    return moments.mapInPandas(run, "g string, start int, centre array<double>, inverse array<double>, det double")


def _sums(rows, names):
    """Counts, sums and sums of products of the columns ``names`` per group and start."""
    d = len(names)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("g", "start").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"a{i}") for i, x in enumerate(names)],
                                          *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"b{k}") for k, (i, j) in enumerate(pairs)])
    return sums.select("g", "start", "n", F.array(*[f"a{i}" for i in range(d)]).alias("s"), F.array(*[f"b{k}" for k in range(len(pairs))]).alias("ss"))


def _starts(rows, middle, spread):
    """First centres and scatters: the medians with the squared deviations, with the products of the parts' tanh, and
    with those of the directions."""
    names, d = list(VECTOR), len(VECTOR)
    wide = {f"w{i}": F.sqrt(F.pow(1.4826 * F.col(f"s{i}"), 2) + VECTOR[x] ** 2) for i, x in enumerate(names)}
    known = stage(middle.join(spread, "g").withColumns(wide), "starts")
    diagonal = known.select("g", F.lit(0).alias("start"), F.array(*[f"m{i}" for i in range(d)]).alias("centre"), F.array(*[
        F.pow(f"w{i}", F.lit(-2.0)) if i == j else F.lit(0.0) for i in range(d) for j in range(d)]).alias("inverse"), F.lit(float("inf")).alias("det"))
    z = {f"z{i}": (F.col(x) - F.col(f"m{i}")) / F.col(f"w{i}") for i, x in enumerate(names)}
    far = F.sqrt(sum((F.col(c) * F.col(c) for c in z), F.lit(1e-12)))
    rows = rows.join(known, "g").withColumns(z).withColumn("far", far).select("g", F.explode(F.array(
        *[F.struct(F.lit(k).alias("start"), *[part(f"z{i}").alias(f"y{i}") for i in range(d)]) for k, part in ((1, F.tanh), (2, lambda c: F.col(c) / F.col("far") * d ** 0.5))])).alias("y")).select("g", "y.*")
    sums = _sums(rows, [f"y{i}" for i in range(d)]).join(known, "g")
    # scatter of the centred, scaled parts about zero, brought back to the parts' own scale by the deviations
    at = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(d) for j in range(i, d))}
    back = sums.select("g", "start", F.array(*[f"m{i}" for i in range(d)]).alias("m"), F.lit(1.0).alias("n"), F.array(*[F.lit(0.0)] * d).alias("s"), F.array(*[
        F.get("ss", F.lit(k)) / F.col("n") * F.col(f"w{i}") * F.col(f"w{j}") for (i, j), k in at.items()]).alias("ss"))
    back = stage(back, "scatters")
    made = _invert(back.drop("m")).drop("centre", "det").join(back.select("g", "start", F.col("m").alias("centre")), ["g", "start"])
    return diagonal.unionByName(made.withColumn("det", F.lit(float("inf"))))


def _distance():
    d = len(VECTOR)
    off = [F.col(x) - F.get("centre", F.lit(i)) for i, x in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i in range(d):
        row = F.lit(0.0)
        for j in range(d):
            row = row + F.get("inverse", F.lit(i * d + j)) * F.col(f"o{j}")
        total = total + F.col(f"o{i}") * row
    return {f"o{i}": x for i, x in enumerate(off)}, total


def _measured(rows, estimate):
    off, total = _distance()
    return rows.join(estimate, "g").withColumns(off).withColumn("d2", total).drop(*off, "centre", "inverse", "det")


def estimates(rows):
    """(g, centre, inverse, scale) of every group g of ``rows`` (g and the vector): the MCD estimate.

    scale brings the median of the squared distances to that of the chi-square distribution.
    """
    names = list(VECTOR)
    middle = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(names)])
    middle = stage(middle, "medians")
    spread = rows.join(middle, "g").groupBy("g").agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"s{i}") for i, x in enumerate(names)])
    d = len(names)
    estimate = stage(_starts(rows, middle, spread), "estimate")
    shares = [0.5 + k / 100 for k in range(51)]
    for _ in range(STEPS):
        measured = _measured(rows, estimate)
        limits = measured.groupBy("g", "start").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("d2", shares, 1000).alias("at"))
        # the share of (n + d + 1) / 2 rows
        place = F.least(F.lit(50), F.ceil(50 * (d + 1) / F.col("n")).cast("int"))
        limits = stage(limits.select("g", "start", F.get("at", place).alias("limit")), "limits")
        inner = measured.join(limits, ["g", "start"]).where("d2 <= limit")
        new = _invert(_sums(inner, names)).withColumnRenamed("det", "new")
        both = estimate.select("g", "start", "centre", "inverse", "det").alias("o").join(new.alias("n"), ["g", "start"])
        falls = F.col("new") < F.col("det") - FALL
        both = both.select("g", "start", *[F.when(falls, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ("centre", "inverse")],
                           F.when(falls, F.col("new")).otherwise(F.col("det")).alias("det"), falls.alias("moved"))
        both = stage(both, "estimate")
        estimate = both.drop("moved")
        if both.where("moved").isEmpty():
            break
    best = estimate.groupBy("g").agg(F.min(F.struct("det", "start")).alias("b")).select("g", "b.start")
    estimate = stage(estimate.join(best, ["g", "start"]).drop("start", "det"), "estimate")
    scale = _measured(rows, estimate).groupBy("g").agg((F.percentile_approx("d2", 0.5, 1000) / CHI_MEDIAN).alias("scale"))
    return stage(estimate.join(scale.withColumn("scale", F.greatest("scale", F.lit(1.0))), "g"), "estimates")


def judge(docs, text="text", lang="lang", source="source", keep=("doc_id",)):
    """``docs[keep]`` with ``STATS``, base_failed, distance (squared, scaled) and kept.

    base_failed: under 50 words, or over half of the words in repeated three-word runs. kept is false if
    base_failed or if the distance is beyond the cut. Null languages and sources are groups of their own; equal texts of
    one group get equal results; extra columns are not looked at.
    """
    columns = [F.col(c) for c in keep]
    rows = docs.select(*columns, F.col(text).alias("__text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("__lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__source"))
    rows = with_stats(rows, "__text", [*keep, "__lang", "__source"]).withColumns(_vector())
    rows = stage(rows, "stats")
    key = lambda *parts: F.concat_ws(ANY, *parts)
    own, of_lang, of_all = key(F.lit("3"), "__lang", "__source"), key(F.lit("2"), "__lang"), F.lit("1")
    size = rows.groupBy("__lang", "__source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = rows.groupBy("__lang").agg(F.count(F.lit(1)).alias("m"))
    size = size.join(by_lang, "__lang").select("__lang", "__source", F.when(F.col("n") >= MIN_ROWS, own).when(
        F.col("m") >= MIN_ROWS, of_lang).otherwise(of_all).alias("__g"))
    size = stage(size, "groups")
    many = rows.select(F.explode(F.array(own, of_lang, of_all)).alias("g"), *VECTOR)
    many = many.join(size.select(F.col("__g").alias("g")).distinct(), "g", "left_semi")
    found = estimates(stage(many, "members"))
    out = _measured(rows.join(size, ["__lang", "__source"]).withColumnRenamed("__g", "g"), found)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("distance", F.col("d2") / F.col("scale"))
    return out.select(*keep, *STATS, "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= CHI_CUT)).alias("kept"))


def op6_quality(spark, sf_dir):
    """Statistics and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "distance")
