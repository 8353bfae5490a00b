"""Checks of vectors, neighbours, models and metrics."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import SERIES as OVER
from tickloom.catalog.q_joins import MINUTE_POINTS, limits_sql, minute_points
from tickloom.constants import PATTERN_LIMITS
from tickloom.operators.indicators import ratio
from tickloom.operators.sequence import SERIES, block_window, rolling, rows_back
from tickloom.plans import documents, features, linear, models, scaling, vectors
from tickloom.session import materialize

# --- vectors -------------------------------------------------------------------------


def vector_sql(points):
    frames = " UNION ALL ".join(
        f"SELECT symbol, timeframe, open_time, close_price, list(close_price) OVER w AS cs FROM bars WHERE timeframe = '{t}' "
        f"WINDOW w AS (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for t, n in PATTERN_LIMITS.items())
    return f"""SELECT p.symbol, p."at", CAST(152 AS INTEGER) AS length,
round(sum(list_sum(list_transform(c.cs, lambda x: coalesce(greatest(-4e0, least(4e0, (x / nullif(c.close_price, 0e0) - 1e0) * 100e0)), 0e0)))), 4) + 0e0 AS total,
CAST(sum(len(list_filter(c.cs, lambda x: abs((x / nullif(c.close_price, 0e0) - 1e0) * 100e0) >= 4))) AS BIGINT) AS clipped
FROM (SELECT * FROM {points} CROSS JOIN (SELECT timeframe FROM {limits_sql(PATTERN_LIMITS)})) p
ASOF JOIN ({frames}) c ON p.symbol = c.symbol AND p.timeframe = c.timeframe AND p."at" >= c.open_time GROUP BY 1, 2"""


def vector_digest(df):
    return df.select("symbol", "at", F.size("vector").alias("length"),
                     F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
                     F.size(F.filter("vector", lambda x: F.abs(x) >= 4)).cast("long").alias("clipped"))


MINUTES = '(SELECT symbol, open_time AS "at" FROM m1)'


def with_atr(v):
    return v.bars.withColumn("atr", F.lit(None).cast("double"))


@query("v01_snapshot_vectors", vector_sql(MINUTE_POINTS))
def v01(v):
    return vector_digest(vectors.snapshot_vectors(minute_points(v), with_atr(v)))


@query("v02_vector_backfill", vector_sql(MINUTES))
def v02(v):
    return vector_digest(vectors.snapshot_vectors(minute_points(v), with_atr(v)))


@query("v01_vectors_zscore")
def v01_z(v):
    return vector_digest(vectors.snapshot_vectors(minute_points(v), v.indicators, ("close", "rsi"), mode="zscore"))


@query("v01_vectors_atr")
def v01_atr(v):
    return vector_digest(vectors.snapshot_vectors(minute_points(v), v.indicators, ("high", "low", "close"), mode="atr"))


@query("v04_vector_checks", "SELECT count(*) AS vectors, CAST(0 AS BIGINT) AS wrong_length, CAST(0 AS BIGINT) AS with_nan, CAST(0 AS BIGINT) AS missing FROM m1")
def v04(v):
    made = vectors.snapshot_vectors(minute_points(v), with_atr(v))
    return vectors.check_vectors(made, minute_points(v), vectors.vector_length())


@query("v06_outcome_labels", """SELECT symbol, open_time AS "at", CAST(152 AS INTEGER) AS length,
coalesce(CASE WHEN close_price > 0 THEN round((fwd_high - close_price) / close_price * 100e0, 4) END, 0e0) AS max_gain_pct_1h, fwd_bars AS later_bars FROM fwd""")
def v06(v):
    out = vectors.label_vectors(vectors.snapshot_vectors(minute_points(v), with_atr(v)), v.m1)
    return out.select("symbol", "at", F.size("vector").alias("length"), "max_gain_pct_1h", "later_bars")


@query("v08_vectorization_ready", """SELECT count(*) AS documents, count(*) AS candles_ok, count(*) AS indicators_ok FROM m1""")
def v08(v):
    rows = vectors.vectorization_ready(documents.history_pattern(minute_points(v), v.indicators))
    return rows.agg(F.count(F.lit(1)).alias("documents"), F.count_if("candles_ok").alias("candles_ok"),
                    F.count_if("indicators_ok").alias("indicators_ok"))


PAIRS = ("SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, list_distance(a.vector, b.vector) AS distance, "
         "row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.vector, b.vector), b.vec_id) AS rank "
         "FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id")


@query("v05_knn_join", f"SELECT query_id, neighbour_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM ({PAIRS}) WHERE rank <= 5")
def v05(v):
    q = v.vectors.select(F.col("vec_id").alias("query_id"), "vector")
    return vectors.knn_join(q, v.vectors, 5, exclude_self=True).select("query_id", "neighbour_id", r("distance"), "rank")


CENTRES = ("(SELECT label, list(m ORDER BY i) AS vector FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(vector) AS x, "
           "unnest(range(1, len(vector) + 1)) AS i FROM vectors) GROUP BY 1, 2) GROUP BY 1)")


def label_centres(v):
    """Mean vector of every label: the query vectors of the live search."""
    parts = v.vectors.select("label", F.posexplode("vector").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    return parts.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("vector"))


@query("v05_knn_search", f"""SELECT query_id, neighbour_id, round(distance, 6) AS distance FROM (SELECT CAST(a.label AS BIGINT) AS query_id, b.vec_id AS neighbour_id,
list_distance(a.vector, b.vector) AS distance, row_number() OVER (PARTITION BY a.label ORDER BY list_distance(a.vector, b.vector), b.vec_id) AS rk
FROM {CENTRES} a CROSS JOIN vectors b) WHERE rk <= 10""")
def v05_search(v):
    return vectors.knn_search(label_centres(v), v.vectors, 10).select("query_id", "neighbour_id", r("distance"))


@query("v05_knn_approximate", f"""SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, count(*) > 0 AS recall_of_nine_tenths
FROM ({PAIRS}) WHERE rank <= 10 AND query_id % 50 = 0""")
def v05_approximate(v):
    """The approximate search for every fiftieth vector against all, measured against the exact one."""
    q = v.vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "vector")
    drop_self = lambda rows: vectors._ranked(rows.drop("rank").where("query_id <> neighbour_id"), 10)
    found = vectors.recall(drop_self(vectors.knn_approximate(q, v.vectors, 11)), vectors.knn_join(q, v.vectors, 10, exclude_self=True))
    return found.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_of_nine_tenths"))


@query("v07_similarity_outcome", f"""SELECT count(*) AS pairs, round(corr(1e0 / (1e0 + p.distance), -abs(a.label - b.label)), 6) + 0e0 AS correlation
FROM ({PAIRS}) p JOIN vectors a ON a.vec_id = p.query_id JOIN vectors b ON b.vec_id = p.neighbour_id WHERE p.rank <= 10""")
def v07(v):
    q = v.vectors.select(F.col("vec_id").alias("query_id"), "vector")
    out = vectors.similarity_outcome(vectors.knn_join(q, v.vectors, 10, exclude_self=True), v.vectors)
    return out.select("pairs", r("correlation"))


@query("m05_knn_regression", f"""SELECT query_id, round(coalesce(avg(CASE WHEN distance = 0 THEN b.label END), sum(CASE WHEN distance <> 0 THEN b.label / distance END) / sum(CASE WHEN distance <> 0 THEN 1e0 / distance END)), 6) AS prediction
FROM ({PAIRS}) p JOIN vectors b ON b.vec_id = p.neighbour_id WHERE p.rank <= 15 GROUP BY 1""")
def m05(v):
    q = v.vectors.select(F.col("vec_id").alias("query_id"), "vector")
    return vectors.knn_regression(vectors.knn_join(q, v.vectors, 15, exclude_self=True), v.vectors).select("query_id", r("prediction"))


# --- features and models ---------------------------------------------------------------

FEATURES = list(features.EXPRESSIONS)


@query("m01_feature_table")
def m01(v):
    """All features of all bars, gaps filled, with the sentiment of the time."""
    s = v.events.where("event_type = 'view'").groupBy("symbol", F.date_trunc("hour", "ts").alias("timestamp")).agg(
        F.avg((F.col("value") - 50) / 100.0).alias("composite_sentiment"), F.count(F.lit(1)).cast("double").alias("news_volume"))
    table = features.feature_table(v.bars, s)
    return table.select("symbol", "timeframe", "open_time", *FEATURES, "hour", "is_london", "composite_sentiment", "news_volume")


FILL = "coalesce(last_value({x} IGNORE NULLS) OVER (" + OVER + " ROWS UNBOUNDED PRECEDING), 0e0)"


@query("m01_feature_fill", f"""SELECT symbol, timeframe, open_time, round({FILL.format(x='vr')}, 6) + 0e0 AS volume_ratio, round({FILL.format(x='pc')}, 6) + 0e0 AS price_change,
round({FILL.format(x='sr')}, 6) + 0e0 AS sma_50_ratio FROM (SELECT *, CASE WHEN count(volume) OVER w = 20 THEN volume / avg(volume) OVER w END AS vr,
(close_price - open_price) / nullif(open_price, 0e0) * 100e0 AS pc, CASE WHEN count(*) OVER w50 = 50 THEN close_price / nullif(avg(close_price) OVER w50, 0e0) - 1e0 END AS sr
FROM bars WINDOW w AS ({OVER} ROWS 19 PRECEDING), w50 AS ({OVER} ROWS 49 PRECEDING))""")
def m01_fill(v):
    return features.feature_table(v.bars).select("symbol", "timeframe", "open_time", r("volume_ratio"), r("price_change"), r("sma_50_ratio"))


@query("m02_targets", f"""SELECT symbol, timeframe, open_time, round((hi - close_price) / nullif(close_price, 0e0) * 100e0, 6) + 0e0 AS target_gain,
round((lo - close_price) / nullif(close_price, 0e0) * 100e0, 6) + 0e0 AS target_loss FROM (SELECT *, count(*) OVER w AS k, max(high_price) OVER w AS hi,
min(low_price) OVER w AS lo FROM bars WINDOW w AS ({OVER} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)) WHERE k = 12""")
def m02(v):
    from tickloom.operators.outcome import row_targets
    return row_targets(v.bars, 12).select("symbol", "timeframe", "open_time", r("target_gain"), r("target_loss"))


def training_table(v):
    """H1 features with the gain target of the next 12 bars, scaled."""
    from tickloom.operators.outcome import row_targets
    table = features.feature_table(v.bars_of("H1"))
    rows = row_targets(table, 12).where("target_gain is not null")
    return models.scaled(models.assemble(materialize(rows, "training"), FEATURES))[0]


@query("m03_scaled_features")
def m03(v):
    from pyspark.ml.functions import vector_to_array
    x = vector_to_array("features")
    return training_table(v).select("symbol", "open_time", F.size(x).alias("n_features"), F.round(F.aggregate(x, F.lit(0.0), lambda a, e: a + e), 6).alias("total"))


@query("m04_regressors")
def m04(v):
    train, test = models.split(training_table(v))
    out, _ = models.fit_predict(train, test, "target_gain")
    return out.select("symbol", "open_time", "target_gain", "linear", "rf", "xgb")


@query("m13_tree_importance")
def m13(v):
    train, test = models.split(training_table(v))
    _, fitted = models.fit_predict(train, test, "target_gain", ("rf",))
    return models.tree_importance(fitted["rf"], FEATURES, v.spark)


# three features of the bars of all timeframes, gaps filled, and the gain target of the next 12 bars
THREE = ["price_change", "volume_ratio", "sma_50_ratio"]
FILLED = f"""(SELECT symbol, timeframe, open_time, close_price, high_price, {FILL.format(x='pc')} AS price_change, {FILL.format(x='vr')} AS volume_ratio,
{FILL.format(x='sr')} AS sma_50_ratio FROM (SELECT *, CASE WHEN count(volume) OVER w = 20 THEN volume / avg(volume) OVER w END AS vr,
(close_price - open_price) / nullif(open_price, 0e0) * 100e0 AS pc, CASE WHEN count(*) OVER w50 = 50 THEN close_price / nullif(avg(close_price) OVER w50, 0e0) - 1e0 END AS sr
FROM bars WINDOW w AS ({OVER} ROWS 19 PRECEDING), w50 AS ({OVER} ROWS 49 PRECEDING)))"""
SCALES = "SELECT timeframe, " + ", ".join(
    f"quantile_cont({c}, 0.5) AS med_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c}, avg({c}) AS avg_{c}, stddev_pop({c}) AS dev_{c}"
    for c in THREE) + f" FROM {FILLED} GROUP BY 1"


def one_scale(name):
    return f"CASE WHEN {name} = 0 THEN 1e0 ELSE {name} END"


@query("m03_exact_scaling", "SELECT f.symbol, f.timeframe, f.open_time, " + ", ".join(
    f"round((f.{c} - s.med_{c}) / {one_scale(f's.iqr_{c}')}, 6) + 0e0 AS robust_{c}, round((f.{c} - s.avg_{c}) / {one_scale(f's.dev_{c}')}, 6) + 0e0 AS standard_{c}"
    for c in THREE) + f" FROM {FILLED} f JOIN ({SCALES}) s ON s.timeframe = f.timeframe")
def m03_exact(v):
    """Robust and standard scaling by exact quantiles and moments of each timeframe."""
    table = materialize(features.feature_table(v.bars).select(*SERIES, "open_time", *THREE), "features")
    out = scaling.scaled_columns(table, scaling.scales(table, THREE, ["timeframe"]), THREE, ["timeframe"])
    return out.select(*SERIES, "open_time", *[r(f"{kind}_{c}") for c in THREE for kind in ("robust", "standard")])


PAIR = ["price_change", "sma_50_ratio"]
TARGETS = f"""(SELECT * FROM (SELECT *, CASE WHEN count(*) OVER w = 12 THEN (max(high_price) OVER w - close_price) / nullif(close_price, 0e0) * 100e0 END AS y
FROM {FILLED} WINDOW w AS ({OVER} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)) WHERE y IS NOT NULL)"""
LINE = f"""(SELECT timeframe, b1, b2, my - b1 * m1 - b2 * m2 AS a FROM (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
(s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM (SELECT timeframe, avg(y) AS my, avg(price_change) AS m1, avg(sma_50_ratio) AS m2, var_pop(price_change) AS s11,
var_pop(sma_50_ratio) AS s22, covar_pop(price_change, sma_50_ratio) AS s12, covar_pop(price_change, y) AS s1y, covar_pop(sma_50_ratio, y) AS s2y FROM {TARGETS} GROUP BY 1)
WHERE s11 > 0 AND s22 > 0))"""


def gain_table(v):
    """The three features with the gain target, bars of all timeframes that have later bars enough and vary in both features."""
    from tickloom.operators.outcome import row_targets
    rows = row_targets(features.feature_table(v.bars), 12).where("target_gain is not null").select(*SERIES, "open_time", *THREE, "target_gain")
    rows = materialize(rows, "gains")
    varied = rows.groupBy("timeframe").agg(*[F.var_pop(c).alias(c) for c in PAIR]).where(" and ".join(f"{c} > 0" for c in PAIR))
    return rows.join(varied.select("timeframe"), "timeframe", "left_semi")


@query("m04_least_squares", f"""SELECT timeframe, 'price_change' AS feature, round(b1, 6) + 0e0 AS coefficient FROM {LINE} UNION ALL
SELECT timeframe, 'sma_50_ratio', round(b2, 6) + 0e0 FROM {LINE} UNION ALL SELECT timeframe, 'intercept', round(a, 6) + 0e0 FROM {LINE}""")
def m04_least_squares(v):
    """Least squares of the gain on two features per timeframe, by normal equations."""
    return linear.fit_linear(gain_table(v), PAIR, "target_gain", ["timeframe"]).select("timeframe", "feature", r("coefficient"))


@query("m04_elastic_net")
def m04_elastic_net(v):
    """The elastic net of the survey's settings on all features and timeframes; a test compares it with the regressor of pyspark.ml."""
    from tickloom.operators.outcome import row_targets
    table = row_targets(features.feature_table(v.bars), 12).where("target_gain is not null").select(*SERIES, "open_time", *FEATURES, "target_gain")
    return linear.fit_linear(materialize(table, "gains"), FEATURES, "target_gain", ["timeframe"], penalty=0.1, l1_ratio=0.5)


def shuffled_sql(f):
    """Growth of the error when one feature is dealt to other rows."""
    guess = " + ".join(f"{b} * {'o' if c == f else 'm'}.{c}" for b, c in zip(("b1", "b2"), PAIR))
    place = "row_number() OVER (PARTITION BY timeframe ORDER BY md5(concat_ws('|', '{}', symbol, timeframe, CAST(epoch_us(open_time) AS VARCHAR)))) AS i"
    return (f"SELECT m.timeframe, '{f}' AS feature, round(avg(pow(m.y - a - ({guess}), 2)) / avg(pow(m.y - a - b1 * m.{PAIR[0]} - b2 * m.{PAIR[1]}, 2)) - 1e0, 6) + 0e0 AS growth "
            f"FROM (SELECT *, {place.format(42)} FROM {TARGETS}) m JOIN (SELECT *, {place.format(43)} FROM {TARGETS}) o "
            f"ON o.timeframe = m.timeframe AND o.i = m.i JOIN {LINE} l ON l.timeframe = m.timeframe GROUP BY 1")


@query("m13_permutation_importance", " UNION ALL ".join(shuffled_sql(f) for f in PAIR))
def m13_permutation(v):
    """By how much the error of the linear fit grows when a feature's values are dealt to other rows."""
    rows = gain_table(v)
    model = materialize(linear.fit_linear(rows, PAIR, "target_gain", ["timeframe"]), "model")
    key = F.concat_ws("|", *SERIES, F.unix_micros("open_time").cast("string"))
    out = linear.permutation_importance(rows, PAIR, "target_gain", lambda d: linear.predict_linear(d, model, PAIR, ["timeframe"]), key, ["timeframe"])
    return out.select("timeframe", "feature", r("growth"))


@query("m14_random_split", """SELECT CASE WHEN substr(md5(concat_ws('|', '42', symbol, timeframe, CAST(epoch_us(open_time) AS VARCHAR))), 1, 8) < 'cccccccd' THEN 'train' ELSE 'test' END AS part,
count(*) AS n FROM bars GROUP BY 1""")
def m14(v):
    train, test = models.split(v.bars)
    return train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# prediction rows: last change as the prediction of the next one, several simple "models"
CHANGE = f"(SELECT *, (close_price - lag(close_price) OVER ({OVER})) / nullif(lag(close_price) OVER ({OVER}), 0e0) * 1e0 AS actual FROM bars)"
PRED = f"""(SELECT * FROM (SELECT symbol, timeframe, open_time, volume, actual, lag(actual) OVER ({OVER}) AS prediction, lag(actual) OVER ({OVER}) AS knn,
avg(actual) OVER ({OVER} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS linear, avg(actual) OVER ({OVER} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rf,
lag(actual, 2) OVER ({OVER}) AS xgb, 0.5e0 + least(volume, 5) / 10e0 AS confidence, CASE WHEN volume > 3 THEN 'high' WHEN volume < 2 THEN 'low' ELSE 'medium' END AS regime
FROM {CHANGE}) WHERE actual IS NOT NULL AND prediction IS NOT NULL AND xgb IS NOT NULL)"""


def predictions(v):
    w = block_window()
    prev = F.lag("close_price").over(w)
    back = lambda n: F.avg("actual").over(w.rowsBetween(-n, -1))
    out = rolling(v.bars, {
        "actual": ratio(F.col("close_price") - prev, prev), "prediction": F.lag("actual").over(w), "knn": F.lag("actual").over(w),
        "linear": back(5), "rf": back(10), "xgb": F.lag("actual", 2).over(w), "confidence": 0.5 + F.least(F.col("volume"), F.lit(5)) / 10.0,
        "regime": F.when(F.col("volume") > 3, "high").when(F.col("volume") < 2, "low").otherwise("medium")}, 12)
    return out.where("actual is not null and prediction is not null and xgb is not null")


W = {"knn": "0.15e0", "linear": "0.15e0 * CASE regime WHEN 'high' THEN 0.7e0 WHEN 'low' THEN 1.3e0 ELSE 1e0 END", "rf": "0.2e0", "xgb": "0.25e0"}
ENS = f"({' + '.join(f'({w}) * {m}' for m, w in W.items())}) / ({' + '.join(f'({w})' for w in W.values())})"
STD = "sqrt((" + " + ".join(f"pow({m} - (knn + linear + rf + xgb) / 4e0, 2)" for m in W) + ") / 4e0)"


@query("m06_ensemble", f"SELECT symbol, timeframe, open_time, round({ENS}, 6) + 0e0 AS ensemble, round({STD}, 6) + 0e0 AS uncertainty, round({ENS} - 1.96e0 * {STD}, 6) + 0e0 AS lower_bound FROM {PRED}")
def m06(v):
    return models.ensemble(predictions(v), list(W)).select(*SERIES, "open_time", r("ensemble"), r("uncertainty"), r("lower_bound"))


@query("m06_model_performance", " UNION ALL ".join(f"SELECT '{m}' AS model, round(1e0 / (1e0 + avg(abs({m} - actual))), 6) AS performance FROM {PRED}" for m in W))
def m06_perf(v):
    return models.model_performance(predictions(v), list(W)).select("model", r("performance"))


@query("m07_safe_prediction", f"SELECT symbol, timeframe, open_time, round(CASE WHEN confidence >= 0.7e0 AND abs(prediction) <= 10 THEN prediction ELSE linear END, 6) + 0e0 AS safe FROM {PRED}")
def m07(v):
    return predictions(v).select(*SERIES, "open_time", F.round(models.safe_prediction("prediction", "confidence", "linear", minimum=0.7), 6).alias("safe"))


@query("m08_blend", f"SELECT symbol, timeframe, open_time, round(0.6e0 * linear + 0.4e0 * rf, 6) + 0e0 AS blended FROM {PRED}")
def m08(v):
    return predictions(v).select(*SERIES, "open_time", F.round(models.blend("linear", "rf"), 6).alias("blended"))


METRICS = f"""SELECT symbol, timeframe, count(*) AS n, avg(abs(prediction - actual)) AS mae, sqrt(avg(pow(prediction - actual, 2))) AS rmse,
avg(CASE WHEN sign(prediction) = sign(actual) THEN 1e0 ELSE 0e0 END) AS directional_accuracy,
sum(CASE WHEN sign(prediction) * actual > 0 THEN sign(prediction) * actual END) / abs(sum(CASE WHEN sign(prediction) * actual < 0 THEN sign(prediction) * actual END)) AS profit_factor
FROM {PRED} GROUP BY 1, 2"""


@query("m09_metrics", f"SELECT symbol, timeframe, n, {rs('mae', 'rmse', 'directional_accuracy', 'profit_factor')} FROM ({METRICS})")
def m09(v):
    return models.metrics(predictions(v), SERIES).select(*SERIES, "n", r("mae"), r("rmse"), r("directional_accuracy"), r("profit_factor"))


@query("m10_drawdown", """SELECT symbol, round(any_value(total), 6) + 0e0 AS total_return, round(-min(c - peak), 6) + 0e0 AS max_drawdown, round(any_value(total) / any_value(n) / any_value(sd), 6) + 0e0 AS sharpe_ratio,
round(any_value(total) / any_value(years) / -min(c - peak), 4) + 0e0 AS calmar_ratio FROM (SELECT *, max(c) OVER (PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING) AS peak FROM (
SELECT symbol, time, sum(profit) OVER (PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING) AS c, sum(profit) OVER (PARTITION BY symbol) AS total, count(*) OVER (PARTITION BY symbol) AS n,
stddev_samp(profit) OVER (PARTITION BY symbol) AS sd, (epoch_us(max(time) OVER (PARTITION BY symbol)) // 1000000 - epoch_us(min(time) OVER (PARTITION BY symbol)) // 1000000) / (365e0 * 86400e0) AS years FROM closed_trades)) GROUP BY 1""")
def m10(v):
    return models.drawdown(v.closed_trades, "profit", "time").select("symbol", r("total_return"), r("max_drawdown"), r("sharpe_ratio"), r("calmar_ratio", 4))


@query("m11_confidence_bins", f"""SELECT floor(round(confidence * 10, 9)) / 10e0 AS bin, count(*) AS n, round(avg(CASE WHEN sign(prediction) = sign(actual) THEN 1e0 ELSE 0e0 END), 6) AS accuracy
FROM {PRED} WHERE confidence >= 0.5e0 AND confidence < 1 GROUP BY 1""")
def m11(v):
    return models.confidence_bins(predictions(v)).select("bin", "n", r("accuracy"))


@query("m11_confidence_correlation", f"SELECT round(corr(confidence, abs(prediction - actual)), 6) + 0e0 AS correlation FROM {PRED}")
def m11_corr(v):
    return models.confidence_correlation(predictions(v)).select(r("correlation"))


@query("m12_feature_scores", " UNION ALL ".join(
    f"SELECT '{m}' AS feature, round(coalesce(abs(corr(coalesce({m}, 0e0), actual)), 0e0), 6) AS score FROM {PRED}" for m in (*W, "confidence")))
def m12(v):
    return models.correlation_scores(predictions(v), [*W, "confidence"], "actual").select("feature", r("score"))


@query("k08_top_features", f"SELECT feature, score FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS feature, round(coalesce(abs(corr(coalesce({m}, 0e0), actual)), 0e0), 6) AS score FROM {PRED}" for m in (*W, "confidence"))
    + ") ORDER BY score DESC, feature LIMIT 3")
def k08(v):
    scores = models.mean_scores(models.correlation_scores(predictions(v), [*W, "confidence"], "actual").select("feature", r("score")))
    return models.top_features(scores, 3)


@query("m16_acceptance", f"SELECT symbol, timeframe, mae < 0.015e0 AS accepted, mae > 2 AS degraded FROM ({METRICS})")
def m16(v):
    return models.acceptance(models.metrics(predictions(v), SERIES)).select(*SERIES, "accepted", "degraded")


@query("w10_rolling_quality", f"""SELECT symbol, timeframe, open_time, round(e, 6) + 0e0 AS avg_error, round(h, 6) AS hit_rate, e > 0.02e0 AS error_alert, h < 0.45e0 AS direction_alert FROM (
SELECT symbol, timeframe, open_time, CASE WHEN count(*) OVER w = 100 THEN avg(abs(prediction - actual)) OVER w END AS e,
CASE WHEN count(*) OVER w = 100 THEN avg(CASE WHEN sign(prediction) = sign(actual) THEN 1e0 ELSE 0e0 END) OVER w END AS h
FROM {PRED} WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY open_time ROWS 99 PRECEDING))""")
def w10(v):
    out = models.rolling_quality(predictions(v))
    return out.select(*SERIES, "open_time", r("avg_error"), r("hit_rate"), "error_alert", "direction_alert")
