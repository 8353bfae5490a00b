"""Trusted golden values of the classifiers, casts and generators."""
import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions import classify, scalar
from tickloom.plans import documents
from tickloom.sources import archive


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def at(text):
    return F.lit(text).cast("timestamp")


def test_safe_casts(spark):
    f = one(spark, *[scalar.safe_float(F.lit(x)) for x in ("42.5", 42, None, "invalid")])
    assert list(f) == [42.5, 42.0, 0.0, 0.0]
    i = one(spark, *[scalar.safe_int(F.lit(x)) for x in ("42", 42.9, None, "invalid", "42.9")])
    assert list(i) == [42, 42, 0, 0, 0]
    assert one(spark, scalar.safe_float_nullable(F.lit("bad")))[0] is None


def test_utc_text(spark):
    assert one(spark, scalar.utc_text(at("2025-08-08 12:30:00")))[0] == "2025-08-08T12:30:00+00:00"
    assert one(spark, scalar.utc_text(F.lit(None).cast("timestamp")))[0] is None


def test_sessions(spark):
    hours = {22: "Sydney", 6: "Sydney", 7: "London", 14: "London", 15: "New York"}
    got = one(spark, *[classify.session_pattern(at(f"2025-08-08 {h:02d}:00:00")) for h in hours])
    assert list(got) == list(hours.values())
    assert one(spark, classify.session_bridge(at("2025-08-08 15:00:00")))[0] == "New_York"
    live = one(spark, *[classify.session_market_live(at(f"2025-08-08 {h:02d}:00:00")) for h in (7, 16, 17, 20, 21)])
    assert list(live) == ["London", "London", "NY", "NY", "Other"]


def test_volatility(spark):
    tiers = one(spark, *[classify.volatility_pattern({"H1": F.lit(x)}) for x in (16.0, 10.0, 4.0)])
    assert list(tiers) == ["high", "medium", "low"]
    null = F.lit(None).cast("double")
    assert one(spark, classify.volatility_pattern({"H1": null}, null, F.lit(21.0)))[0] == "high_price"
    assert one(spark, classify.volatility_pattern({"H1": null}, F.lit(0.0), F.lit(0.0)))[0] == "no_data"
    assert one(spark, classify.volatility_score(F.lit(100.0), F.lit(101.0), F.lit(99.0)))[0] == 2.0


def test_bar_enrichment(spark):
    bar = spark.createDataFrame([("EURUSD", dt.datetime(2025, 8, 8, 12), 1.1, 1.102, 1.099, 1.101, 0.0)],
                                "symbol string, open_time timestamp, open_price double, high_price double, low_price double, "
                                "close_price double, spread double")
    row = classify.enrich_bars(bar).first()
    assert row.estimated_spread == 0.00015 and row.trading_session == "London"
    assert abs(row.volatility_score - 0.2727) < 1e-9 and abs(row.price_change_pct - 0.0909) < 1e-9


def test_last_time_map(spark):
    row = spark.sql("SELECT map('M1', array(named_struct('open_time', 'a'), named_struct('open_time', 'b')), "
                    "'H1', cast(array() as array<struct<open_time: string>>)) AS context")
    assert row.select(documents.last_times()).first()[0] == {"M1": "b", "H1": None}


def test_trading_days(spark):
    days = lambda a, b: archive.trading_days(spark, a, b).count()
    assert (days("2016-01-20", "2016-01-21"), days("2016-01-02", "2016-01-02"), days("2016-01-05", "2016-01-01")) == (2, 0, 0)
    assert archive.trading_days(spark, "2016-01-20", "2016-01-21", today="2016-01-21").count() == 1


def test_dst_bounds(spark):
    days = ["2015-03-07", "2015-03-08", "2015-10-31", "2015-11-01"]
    assert list(one(spark, *[scalar.is_us_dst(F.lit(d).cast("date")) for d in days])) == [False, True, True, False]


def test_snake_case_walk(spark):
    df = spark.sql("SELECT 1 AS ok_name, named_struct('badName', 1) AS nested")
    assert scalar.non_snake_case_fields(df.schema) == ["nested.badName"]


def test_spread_defaults(spark):
    assert one(spark, classify.spread_from_range(F.lit(None).cast("double"), F.lit(1.0)))[0] == 0.40
    assert one(spark, classify.spread_from_range(F.lit(2.0), F.lit(2.0)))[0] == 0.01
