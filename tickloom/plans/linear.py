"""Linear regression per group from one aggregate, and feature importance by a fixed permutation.

All that a linear fit needs of the rows are the products of its standardised columns, one row a group. Least
squares solves the normal equations; the elastic net runs coordinate descent on the same small matrix, so the rows
are read twice (means, products) whatever the penalty and however many steps it takes.
"""
import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.sequence import join_blocks, prefix_over_blocks
from tickloom.session import materialize

#: Rows of one hash bucket when rows are numbered, about.
BUCKET = 4096


def _join_groups(df, groups, by):
    if by:
        return join_blocks(df, groups, by)
    return df.join(F.broadcast(groups))  # one row


def _whole(df, columns):
    """Rows in which all columns are finite numbers."""
    test = F.lit(True)
    for c in columns:
        test = test & (F.abs(F.col(c).cast("double")) < F.lit(float("inf")))
    return df.where(test)


def solve(products, against, penalty=0.0, l1_ratio=0.0):
    """Coefficients in standardised units from mean products of the features and with the label."""
    p = len(against)
    if not penalty:
        return np.linalg.lstsq(products, against, rcond=1e-12)[0]
    l1, l2 = penalty * l1_ratio, penalty * (1 - l1_ratio)
    beta = np.zeros(p)
    for _ in range(10_000):
        before = beta.copy()
        for j in range(p):
            if products[j, j] > 0:
                rest = against[j] - products[j] @ beta + products[j, j] * beta[j]
                beta[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (products[j, j] + l2)
        if np.abs(beta - before).max() < 1e-13:
            break
    return beta


def fit_linear(df, features, label, by=(), penalty=0.0, l1_ratio=0.0):
    """(by, feature, coefficient), with the feature ``intercept``; one set per group.

    Rows with a null or non-finite feature or label are left out; a constant feature has the coefficient 0. The penalty
    applies to standardised features and label (sample deviations), divided by the label's deviation. Null group values are a group.
    """
    by = list(by)
    names = [*features, label]
    rows = _whole(df, names)
    means = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[
        x for i, c in enumerate(names) for x in (F.avg(F.col(c)).alias(f"_m{i}"), F.stddev_samp(F.col(c)).alias(f"_d{i}"))])
    means = materialize(means, "means")
    unit = [F.coalesce(F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_d{i}")), F.lit(0.0)) for i, c in enumerate(names)]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    z = _join_groups(rows.select(*by, *names), means, by).select(*by, *[u.alias(f"_z{i}") for i, u in enumerate(unit)])
    sums = z.groupBy(*by).agg(F.array(*[F.avg(F.col(f"_z{i}") * F.col(f"_z{j}")) for i, j in pairs]).alias("_s"))
    fitted = _join_groups(sums, means, by)
    schema = [f for f in df.schema.fields if f.name in by]
    out = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], "feature string, coefficient double"])
    by = [f.name for f in schema]

    def run(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                m = np.zeros((len(names), len(names)))
                for (i, j), s in zip(pairs, row["_s"]):
                    m[i, j] = m[j, i] = s
                dev = np.nan_to_num(np.array([row[f"_d{i}"] for i in range(len(names))], dtype="float64"))
                mean = np.array([row[f"_m{i}"] for i in range(len(names))])
                beta = solve(m[:-1, :-1], m[:-1, -1], penalty / dev[-1] if dev[-1] else 0.0, l1_ratio)
                beta = np.array([b * dev[-1] / d if d else 0.0 for b, d in zip(beta, dev)])
                made = pd.DataFrame({"feature": [*features, "intercept"], "coefficient": [*beta, mean[-1] - beta @ mean[:-1]]})
                for name in reversed(by):
                    made.insert(0, name, [row[name]] * len(made))
                yield made

    return fitted.select(*by, "_s", *[f"_m{i}" for i in range(len(names))], *[f"_d{i}" for i in range(len(names))]).mapInPandas(run, out)


def _wide(model, features, by):
    return model.groupBy(*by).agg(*[F.max(F.when(F.col("feature") == f, F.col("coefficient"))).alias(f"_b_{f}")
                                    for f in [*features, "intercept"]])


def predict_linear(df, model, features, by=(), name="prediction"):
    """``df`` with the prediction of its group's coefficients; rows of a group without a fit are left out."""
    by = list(by)
    total = F.col("_b_intercept")
    for f in features:
        total = total + F.col(f"_b_{f}") * F.col(f)
    out = _join_groups(df, _wide(model, features, by), by).withColumn(name, total)
    return out.drop(*[f"_b_{f}" for f in [*features, "intercept"]])


def hash_position(df, text, by, name):
    """Add the dense 0-based position of a row in its group by the md5 of ``text``: counts of hash prefixes, their running
    sums, and the order inside a prefix. ``df`` should be a stored table, as it is read twice, and ``text`` unique in a group."""
    n = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 1
    digits = 1
    while n > BUCKET * 16 ** digits:
        digits += 1
    cut = df.withColumn("_h", F.md5(text)).withColumn("_tb", F.substring("_h", 1, digits))
    counts = cut.groupBy(*by, "_tb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by, "_tb").orderBy("_h")
    numbered = cut.withColumn("_p", F.row_number().over(w))
    out = join_blocks(numbered, prefix_over_blocks(counts, by, "_tb", {"_c": "_before"}), [*by, "_tb"])
    return out.withColumn(name, F.col("_before") + F.col("_p") - 1).drop("_h", "_tb", "_p", "_before")


def permutation_importance(df, features, label, predict, key, by=(), seed=42):
    """(by, feature, importance, growth): by how much the mean squared error grows when the feature's values are dealt to other
    rows, and that as a share of the error (null without any error).

    ``predict`` takes a frame with the features (and ``by``) and adds ``prediction``. ``key`` is a text column expression,
    unique in a group; the row at position i by md5(seed|key) gets the values of the one at position i by
    md5(seed + 1|key), the same for every run and plan. Rows with a null feature or label are left out.
    """
    by = list(by)
    named = df.select(*by, *features, F.col(label).alias("_y"), key.alias("_key"))
    rows = materialize(_whole(named, [*features, "_y"]), "rows")
    mine = hash_position(rows, F.concat_ws("|", F.lit(str(seed)), "_key"), by, "_i")
    other = hash_position(rows, F.concat_ws("|", F.lit(str(seed + 1)), "_key"), by, "_i")
    other = other.select(*by, "_i", *[F.col(f).alias(f"_o_{f}") for f in features])
    dealt = materialize(join_blocks(mine, other, [*by, "_i"]).drop("_key"), "dealt")
    error = lambda f: F.avg((F.col("_y") - F.col("prediction")) * (F.col("_y") - F.col("prediction"))).alias(f)
    plain = predict(dealt).groupBy(*by).agg(error("_base"))
    out = None
    for f in features:
        moved = predict(dealt.withColumn(f, F.col(f"_o_{f}"))).groupBy(*by).agg(error("_moved"))
        one = _join_groups(moved, plain, by).select(*by, F.lit(f).alias("feature"), (F.col("_moved") - F.col("_base")).alias("importance"),
                                                        F.try_divide(F.col("_moved") - F.col("_base"), F.col("_base")).alias("growth"))
        out = one if out is None else out.unionByName(one)
    return out
