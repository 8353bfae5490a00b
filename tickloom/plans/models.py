"""Regressors on the feature table, ensembles and prediction metrics."""
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import pearson
from tickloom.operators.sequence import rolling, rows_back, time_block
from tickloom.plans.quality import unpivot_row

# --- fixed values -----------------------------------------------------------
BASE_WEIGHTS = {"knn": 0.15, "linear": 0.15, "rf": 0.20, "xgb": 0.25, "lstm": 0.25}
REGIME_FACTORS = {"high": {"lstm": 1.3, "linear": 0.7}, "low": {"linear": 1.3, "lstm": 0.7}}
SPLIT, SEED, TREES = (0.8, 0.2), 42, 100
ERROR_LIMIT, HIT_LIMIT, WINDOW = 0.02, 0.45, 100
ACCEPT_MAE, DEGRADED_MAE = 0.015, 2.0
# ----------------------------------------------------------------------------


# --- training ---------------------------------------------------------------------

def assemble(df, columns, out="raw"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="skip").transform(df)


def scaled(df, column="raw"):
    """Robust and standard scaling, one after the other; returns (frame, fitted scalers)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import RobustScaler, StandardScaler
    fitted = Pipeline(stages=[RobustScaler(inputCol=column, outputCol="robust", withCentering=True, relativeError=0.001),
                              StandardScaler(inputCol="robust", outputCol="features", withMean=True)]).fit(df)
    return fitted.transform(df), fitted


def split(df, keys=("symbol", "timeframe", "open_time")):
    """Training and test rows by a hash of the row's key: the same for every run, plan and engine."""
    text = F.concat_ws("|", F.lit(str(SEED)), *[
        F.unix_micros(k).cast("string") if df.schema[k].dataType.typeName() == "timestamp" else F.col(k).cast("string") for k in keys])
    bound = f"{round(SPLIT[0] * 16 ** 8):08x}"
    first = F.substring(F.md5(text), 1, 8) < bound
    return df.where(first), df.where(~first)


def regressors(label):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    return {"linear": LinearRegression(labelCol=label, predictionCol="linear", elasticNetParam=0.5, regParam=0.1),
            "rf": RandomForestRegressor(labelCol=label, predictionCol="rf", numTrees=TREES, seed=SEED),
            "xgb": GBTRegressor(labelCol=label, predictionCol="xgb", maxIter=20, seed=SEED)}


def fit_predict(train, test, label, names=("linear", "rf", "xgb")):
    """Test rows with one prediction column per model, and the fitted models."""
    models = {n: m.fit(train) for n, m in regressors(label).items() if n in names}
    return reduce(lambda df, m: m.transform(df), models.values(), test), models


def tree_importance(model, columns, spark):
    return spark.createDataFrame([(c, float(x)) for c, x in zip(columns, model.featureImportances.toArray())],
                                 "feature string, importance double")


# --- ensemble ------------------------------------------------------------------------

def ensemble(df, models, regime="regime"):
    """Weighted mean of prediction columns; weights depend on the regime and are normalised
    over the models present. Bounds are the mean -/+ 1.96 population deviations."""
    factor = lambda m: reduce(lambda acc, r: acc.when(F.col(regime) == r, REGIME_FACTORS[r].get(m, 1.0)),
                              REGIME_FACTORS, F.when(F.lit(False), 1.0)).otherwise(1.0)
    weights = {m: F.lit(BASE_WEIGHTS[m]) * factor(m) for m in models}
    total = reduce(lambda a, b: a + b, weights.values())
    mean = reduce(lambda a, b: a + b, [weights[m] * F.col(m) for m in models]) / total
    plain = reduce(lambda a, b: a + b, [F.col(m) for m in models]) / len(models)
    std = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(m) - plain, F.lit(2)) for m in models]) / len(models))
    return (df.withColumn("ensemble", mean).withColumn("uncertainty", std)
            .withColumn("lower_bound", F.col("ensemble") - 1.96 * F.col("uncertainty"))
            .withColumn("upper_bound", F.col("ensemble") + 1.96 * F.col("uncertainty")))


def model_performance(df, models, actual="actual"):
    """1 / (1 + mean absolute error) of every prediction column."""
    row = df.agg(*[(1 / (1 + F.avg(F.abs(F.col(m) - F.col(actual))))).alias(f"{m}__performance") for m in models])
    return unpivot_row(row, models, ["performance"]).withColumnRenamed("indicator", "model")


def safe_prediction(prediction, confidence, fallback, minimum=0.5, extreme=10.0):
    p, c = F.col(prediction), F.col(confidence)
    return F.when((c >= minimum) & (F.abs(p) <= extreme), p).otherwise(F.col(fallback))


def blend(traditional, model):
    return 0.6 * F.col(traditional) + 0.4 * F.col(model)


# --- metrics -----------------------------------------------------------------------------

def metrics(df, by=("symbol",), prediction="prediction", actual="actual"):
    """Errors, share of right directions and profit factor of following the sign."""
    p, a = F.col(prediction), F.col(actual)
    gained = F.signum(p) * a
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(p - a)).alias("mae"), F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"),
        F.avg((F.signum(p) == F.signum(a)).cast("double")).alias("directional_accuracy"),
        F.try_divide(F.sum(F.when(gained > 0, gained)), F.abs(F.sum(F.when(gained < 0, gained)))).alias("profit_factor"))


def drawdown(df, value, time, keys=("symbol",), seconds=86400):
    """Largest fall of the running total below its highest point so far, per key.

    Time blocks are summarised as (sum, peak, trough, inner fall); the blocks of a key are
    then combined in order, so no task needs a whole series.
    """
    keys = list(keys)
    inner = Window.partitionBy(*keys, "_b").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.select(*keys, time, F.col(value).alias("_x"), time_block(time, seconds).alias("_b"))
    rows = rows.withColumn("_c", F.sum("_x").over(inner))
    rows = rows.withColumn("_p", F.max("_c").over(inner))
    blocks = rows.groupBy(*keys, "_b").agg(
        F.sum("_x").alias("_sum"), F.max("_c").alias("_peak"), F.min("_c").alias("_low"),
        F.min(F.col("_c") - F.col("_p")).alias("_fall"), F.sum(F.col("_x") * F.col("_x")).alias("_sq"),
        F.count("_x").alias("_n"), F.min(time).alias("_t0"), F.max(time).alias("_t1"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_sum").over(before), F.lit(0.0)))
    blocks = blocks.withColumn("_top", F.max(F.col("_off") + F.col("_peak")).over(before))
    fall = F.least("_fall", F.col("_off") + F.col("_low") - F.col("_top"))
    n, s, q = F.sum("_n"), F.sum("_sum"), F.sum("_sq")
    variance = F.try_divide(q - s * s / n, n - 1)
    years = (F.unix_seconds(F.max("_t1")) - F.unix_seconds(F.min("_t0"))) / (365.0 * 86400)
    worst = F.min(fall)
    return blocks.groupBy(*keys).agg(
        s.alias("total_return"), (-worst).alias("max_drawdown"), F.try_divide(s / n, F.sqrt(variance)).alias("sharpe_ratio"),
        F.try_divide(F.try_divide(s, years), -worst).alias("calmar_ratio"))


def confidence_bins(df, prediction="prediction", actual="actual", confidence="confidence"):
    """Share of right directions per confidence bin of width 0.1 from 0.5 to 1.0 (1.0 excluded)."""
    c = F.col(confidence)
    low = F.floor(F.round(c * 10, 9)) / 10.0
    rows = df.where((c >= 0.5) & (c < 1.0))
    hit = (F.signum(prediction) == F.signum(actual)).cast("double")
    return rows.groupBy(low.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def confidence_correlation(df, prediction="prediction", actual="actual", confidence="confidence"):
    return df.agg(pearson(confidence, F.abs(F.col(prediction) - F.col(actual))).alias("correlation"))


def rolling_quality(df, n=WINDOW):
    """Mean error and share of right directions of the last ``n`` predictions per series,
    with alert flags; null until ``n`` predictions exist."""
    w = rows_back(n)
    enough = F.count(F.lit(1)).over(w) == n
    error = F.abs(F.col("prediction") - F.col("actual"))
    hit = (F.signum("prediction") == F.signum("actual")).cast("double")
    return rolling(df, {
        "avg_error": F.when(enough, F.avg(error).over(w)), "hit_rate": F.when(enough, F.avg(hit).over(w)),
        "error_alert": F.col("avg_error") > ERROR_LIMIT, "direction_alert": F.col("hit_rate") < HIT_LIMIT}, n - 1)


def correlation_scores(df, columns, target):
    """|Pearson correlation| of every feature with the target, nulls as 0; 0 where it is undefined; one pass."""
    score = lambda c: F.nanvl(pearson(F.coalesce(F.col(c), F.lit(0.0)), target), F.lit(0.0))
    row = df.agg(*[F.abs(F.coalesce(score(c), F.lit(0.0))).alias(f"{c}__score") for c in columns])
    return unpivot_row(row, columns, ["score"]).withColumnRenamed("indicator", "feature")


def mean_scores(*scores):
    """Mean of the scores a feature has."""
    return reduce(lambda a, b: a.unionByName(b), scores).groupBy("feature").agg(F.avg("score").alias("score"))


def top_features(scores, n=50):
    return scores.orderBy(F.desc("score"), "feature").limit(n)


def acceptance(metric_rows, time_window=None):
    """Acceptance of a model by its error, and the degradation flag of a recent window."""
    return metric_rows.withColumn("accepted", F.col("mae") < ACCEPT_MAE).withColumn("degraded", F.col("mae") > DEGRADED_MAE)
