"""News sentiment aggregates and event impact."""
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
BASE_FACTOR = 0.8
QUOTE_FACTOR = -0.6
IMPACT_WEIGHTS = {"high": 1.0, "medium": 0.6, "low": 0.3}
# ----------------------------------------------------------------------------


def sentiment(articles, by=("currency",)):
    """Mean, population deviation, relevance-weighted mean, count and confidence."""
    s, w = F.col("score"), F.col("relevance")
    n = F.count(F.lit(1))
    return articles.groupBy(*by).agg(
        F.avg(s).alias("mean_sentiment"), F.stddev_pop(s).alias("sentiment_std"),
        F.coalesce(F.try_divide(F.sum(s * w), F.sum(w)), F.lit(0.0)).alias("weighted_sentiment"),
        n.alias("article_count"), F.least(n / 10.0, F.lit(1.0)).alias("confidence"))


def composite(by_symbol):
    """The composite of each symbol and the two values derived from it, for its base and its quote currency."""
    whole = F.col("weighted_sentiment")
    return by_symbol.withColumns({"composite_sentiment": whole, "base_currency_sentiment": whole * BASE_FACTOR,
                                  "quote_currency_sentiment": whole * QUOTE_FACTOR, "news_volume": F.col("article_count")})


def divergence(pairs, by_currency):
    """Difference between the sentiments of the two currencies of base / quote pairs."""
    side = by_currency.select(F.col("currency"), F.col("weighted_sentiment").alias("_s"))
    out = pairs.join(side.withColumnsRenamed({"currency": "base", "_s": "base_sentiment"}), "base", "left").join(
        side.withColumnsRenamed({"currency": "quote", "_s": "quote_sentiment"}), "quote", "left")
    b, q = F.coalesce("base_sentiment", F.lit(0.0)), F.coalesce("quote_sentiment", F.lit(0.0))
    return out.select("base", "quote", F.abs(b - q).alias("policy_divergence"))


def impact_score(events, by=("currency",), impact="impact", hours="hours_ahead"):
    """Sum of impact weight times the linear decay over a day, and counts by impact."""
    weight = F.lit(0.0)
    for name, value in IMPACT_WEIGHTS.items():
        weight = weight + F.when(F.col(impact) == name, value).otherwise(0.0)
    decay = F.greatest(F.lit(0.0), 1 - F.col(hours) / 24.0)
    return events.groupBy(*by).agg(F.sum(weight * decay).alias("impact_score"), F.count(F.lit(1)).alias("events"), *[
        F.count_if(F.col(impact) == n).alias(f"{n}_impact") for n in IMPACT_WEIGHTS])
