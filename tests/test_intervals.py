"""Validity joins and sweeps against all pairs."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.catalog import load
from tickloom.operators import rangejoin
from tickloom.plans import documents, trades

ZERO = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(9)
    day = 86400
    when = lambda span: ZERO + dt.timedelta(seconds=rng.choice([rng.randint(0, span), 3600 * rng.randint(0, span // 3600)]))
    points = [(i, rng.choice("AB"), when(40 * day)) for i in range(150)] + [(900, "A", None), (901, None, ZERO), (902, "A", ZERO), (903, "A", ZERO)]
    spans = []
    for i in range(120):
        start = when(40 * day) - dt.timedelta(days=rng.choice([0, 0, 300]))
        end = rng.choice([None, start, start - dt.timedelta(hours=1), start + dt.timedelta(seconds=rng.randint(1, 3 * day)), start + dt.timedelta(days=rng.randint(1, 400))])
        spans.append((i, rng.choice("ABC"), start, end, rng.randint(0, 9) * 1.5))
    spans += [(500, "A", None, None, 1.0), (501, None, ZERO, None, 1.0), (502, "A", ZERO, None, None), (503, "B", ZERO + dt.timedelta(days=4000), None, 1.0)]
    return points, spans


def frames(spark, sides):
    p = spark.createDataFrame(sides[0], "id int, symbol string, at timestamp")
    s = spark.createDataFrame(sides[1], "trade int, symbol string, start timestamp, until timestamp, price double")
    return p.repartition(3), s.repartition(3)


def by_hand(sides):
    return [(p, s) for p in sides[0] for s in sides[1] if p[1] is not None and p[1] == s[1] and p[2] and s[2] and s[2] <= p[2] and (s[3] is None or s[3] > p[2])]


@pytest.mark.parametrize("width, levels", [(4 * 3600, 11), (600, 4), (7 * 86400, 2)])
def test_pairs(spark, sides, monkeypatch, width, levels):
    monkeypatch.setattr(rangejoin, "LEVELS", levels)
    p, s = frames(spark, sides)
    got = rangejoin.interval_join(p, s, ["symbol"], "at", "start", "until", width)
    assert got.columns == ["id", "symbol", "at", "trade", "start", "until", "price"]
    assert sorted((r.id, r.trade) for r in got.collect()) == sorted((a[0], b[0]) for a, b in by_hand(sides))


def test_an_open_interval_is_stored_a_few_times(spark):
    one = spark.range(1).select(F.lit(0).cast("long").alias("first"))
    for days in (30, 300, 3000):
        last = F.lit(days * 6).cast("long")
        blocks = one.select(F.explode(rangejoin._blocks_between(F.col("first") + 1, last - 1)).alias("b")).select("b.*").collect()
        covered = sorted(x for r in blocks for x in range(r.number << r.level, (r.number + 1) << r.level))
        assert covered == list(range(1, days * 6)) and len(blocks) <= 2 * (days * 6).bit_length() + days * 6 // 1024


@pytest.mark.parametrize("width", [86400, 3000])
def test_sweep(spark, sides, width):
    p, s = frames(spark, sides)
    got = rangejoin.valid_at(p, s, ["symbol"], "at", "start", "until", ["price"], width=width).collect()
    pairs = by_hand(sides)
    want = {a[0]: [b[4] or 0.0 for x, b in pairs if x == a] for a in sides[0]}
    assert len(got) == len(sides[0])
    assert all(r.n_valid == len(want[r.id]) and abs(r.price_sum - sum(want[r.id])) < 1e-9 for r in got)


def test_without_rows(spark, sides):
    p, s = frames(spark, sides)
    assert rangejoin.interval_join(p.limit(0), s, ["symbol"], "at", "start", "until").count() == 0
    assert rangejoin.interval_join(p, s.limit(0), ["symbol"], "at", "start", "until").count() == 0
    assert rangejoin.valid_at(p, s.limit(0), ["symbol"], "at", "start", "until").agg(F.sum("n_valid")).first()[0] == 0


@pytest.mark.parametrize("width", [4 * 3600, 600])
def test_lists_of_valid_intervals(spark, sides, width):
    p, s = frames(spark, sides)
    got = rangejoin.collect_valid(p, s, ["symbol"], "at", "start", "until", F.col("trade"), ["start", "trade"], "held", width)
    assert got.columns == ["id", "symbol", "at", "held"]
    pairs = by_hand(sides)
    want = {a[0]: [b[0] for _, b in sorted(((b[2], b[0]), b) for x, b in pairs if x == a)] for a in sides[0]}
    assert {r.id: r.held for r in got.collect()} == want
    assert rangejoin.collect_valid(p, s.limit(0), ["symbol"], "at", "start", "until", F.col("trade"), ["trade"]).where("size(items) > 0").count() == 0


def test_trade_lists_are_not_grouped_from_pairs(small):
    """Lists are made once per time block; no pair of a point and a trade goes through a shuffle."""
    points = small.m1.select("symbol", F.col("open_time").alias("at"))
    for docs in (trades.open_trade_documents(points, small.open_trades), trades.closed_trade_documents(points, small.closed_trades)):
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("Aggregate")


def test_texts_of_trade_lists_are_not_joined(small):
    """A snapshot's lists become JSON after all joins, in the task that has the snapshot."""
    points = small.m1.select("symbol", F.col("open_time").alias("at"))
    rows = documents.history_snapshots(points, small.bars, small.account_state, small.open_trades, small.closed_trades,
                                       parts=["account", "open_trades", "closed_trades"])
    assert rows.columns == ["symbol", "snapshot_time", "account_state_json", "open_trades_json", "closed_trades_json"]
    plan = rows.select("open_trades_json", "closed_trades_json")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("StructsToJson") < plan.index("Join") and plan.count("StructsToJson") == 2


@pytest.mark.parametrize("width, levels", [(60, 11), (600, 4), (7 * 86400, 2)])
def test_folds_of_valid_intervals(spark, sides, monkeypatch, width, levels):
    monkeypatch.setattr(rangejoin, "LEVELS", levels)
    p, s = frames(spark, sides)
    got = rangejoin.fold_valid(p, s, ["symbol"], "at", "start", "until", {
        "n": (F.lit(1), F.sum), "total": (F.col("price"), F.sum), "last": (F.col("trade"), F.max)}, width).collect()
    held = {a[0]: [b for x, b in by_hand(sides) if x == a] for a in sides[0]}
    assert {r.id: (r.n, r.last) for r in got} == {i: (len(b), max(x[0] for x in b)) for i, b in held.items() if b}
    assert all(abs((r.total or 0) - sum(x[4] or 0 for x in held[r.id])) < 1e-9 for r in got)


def test_totals_of_trades_fold_before_points_look_them_up(small):
    for name in ("j05_backward_range", "j06_interval_join"):
        plan = load()[0][name](small.spark, small.path)._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and plan.count("Aggregate [_r_symbol") >= 1


@pytest.fixture(scope="module")
def dense():
    """Points of two days minute by minute, some twice, without a key or without a time, and intervals of minutes to months."""
    rng = random.Random(4)
    minute = lambda k: ZERO + dt.timedelta(minutes=k)
    points = [(k, rng.choice("AB"), minute(k // 2)) for k in range(900)] + [(k, "A", minute(2000 + k % 7)) for k in range(900, 930)]
    points += [(930, "A", None), (931, None, ZERO), (932, None, None), (933, "Z", ZERO)]
    spans = []
    for i in range(160):
        start = minute(rng.randint(-600, 2100)) + dt.timedelta(seconds=rng.choice([0, 0, 7]))
        end = rng.choice([None, start, start - dt.timedelta(hours=1), *[start + dt.timedelta(minutes=rng.randint(1, 1500)) for _ in range(5)], start + dt.timedelta(days=90)])
        spans.append((i, rng.choice("ABC"), start, end, rng.randint(0, 9) * 1.5))
    return points, spans + [(200, "A", None, None, 1.0), (201, None, ZERO, None, 1.0), (202, "A", ZERO, None, None), (202, "A", ZERO, None, None)]


@pytest.mark.parametrize("width", [4 * 3600, 600])
def test_two_lists_at_a_time(spark, dense, width):
    p, s = frames(spark, dense)
    day = s.withColumn("until", F.timestamp_micros(F.unix_micros("start") + 86400 * 1000000))
    lists = {"held": (s, "start", "until", F.col("trade"), ["start", "trade"]),
             "recent": (day, "start", "until", F.struct("trade", "price"), [(-F.unix_micros("start")).alias("t"), (-F.col("trade")).alias("i")])}
    spans = [(*x[:3], x[2] + dt.timedelta(days=1) if x[2] else None, x[4]) for x in dense[1]]
    want = {a[0]: ([], []) for a in dense[0]}
    for a, b in sorted(by_hand(dense), key=lambda x: (x[1][2], x[1][0])):
        want[a[0]][0].append(b[0])
    for a, b in sorted(by_hand((dense[0], spans)), key=lambda x: (x[1][2], x[1][0]), reverse=True):
        want[a[0]][1].append((b[0], b[4]))
    got = rangejoin.collect_valid_lists(p, lists, ["symbol"], "at", width)
    assert got.columns == ["id", "symbol", "at", "held", "recent"]
    assert {r.id: (r.held, [tuple(x) for x in r.recent]) for r in got.collect()} == want and got.count() == len(want)
    some = rangejoin.collect_valid_lists(p, lists, ["symbol"], "at", width, some=True)
    assert {r.id for r in some.select("id").collect()} == {i for i, (a, b) in want.items() if a or b}
    texts = rangejoin.collect_valid_lists(p, {"recent": lists["recent"]}, ["symbol"], "at", width, text=True).select("id", F.concat_ws(",", "recent").alias("t"))
    shown = lambda t, x: f'{{"trade":{t},"price":{"null" if x is None else x}}}'
    assert {r.id: r.t for r in texts.collect()} == {i: ",".join(shown(*x) for x in b) for i, (_, b) in want.items()}


def test_blocks_last_as_long_as_intervals(spark):
    """An interval is copied to about two blocks, and never to more than a 32nd of the span of the points asks for."""
    at = lambda hours: ZERO + dt.timedelta(hours=hours)
    points = spark.createDataFrame([("A", at(0)), ("A", at(3200))], "symbol string, at timestamp")
    for hours, open_ones, wide in ((1, 0, 4), (50, 0, 50), (50, 40, 100), (90000, 0, 100)):
        rows = [("A", at(k), at(k + hours)) for k in range(40)] + [("A", at(0), None)] * open_ones
        s = spark.createDataFrame(rows, "symbol string, start timestamp, until timestamp")
        limits = rangejoin._limits(points, {"x": (s, "start", "until", F.lit(1), ["start"])}, "at", 4 * 3600)
        assert spark.range(1).select(limits).first()[0].wide == wide * 3600


def test_lists_are_made_once_and_not_sorted(small):
    """The join hashes the points, no condition on a list makes it again, and items become JSON before points take them."""
    for name in ("d05_history_trade_fields", "d06_history_trade_fields", "d05_open_trades_history", "d12_history_backfill"):
        plan = load()[0][name](small.spark, small.path)._jdf.queryExecution()
        lists = 2 if name.startswith("d12") else 1
        assert plan.optimizedPlan().toString().count("flatten(filter(") == lists
        assert plan.executedPlan().toString().count("LeftOuter, BuildLeft") == lists
        if lists == 2:
            assert "StructsToJsonEvaluator(Map(ignoreNullFields -> false),ArrayType" not in plan.optimizedPlan().toString()
