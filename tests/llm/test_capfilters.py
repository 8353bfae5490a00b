"""Embedding near duplicates against all pairs, recall at the limit, odd rows."""
import math

import numpy as np
import pytest

from tickloom.llm import capfilters

SCHEMA = "vec_id long, embedding array<float>, label int, kept string, N_LINKS int"


def near(rng, v, cosine):
    z = rng.standard_normal(len(v))
    z -= z @ v * v
    return cosine * v + math.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(12)
    out, ids = [], iter(range(10 ** 6))
    for label in (0, 1, 2):
        centres = capfilters.unit(rng.standard_normal((60, 48)))
        for c in centres:
            out.append((next(ids), c, label))
            for cosine in rng.uniform(0.9, 0.999, rng.integers(0, 4)):
                out.append((next(ids), near(rng, c, cosine) * rng.uniform(0.1, 9), label))
        # one dense group, one group of copies, a chain
        out += [(next(ids), near(rng, centres[0], 0.985), label) for _ in range(40)]
        out += [(next(ids), centres[1], label) for _ in range(30)]
        link = centres[2]
        for _ in range(6):
            link = near(rng, link, 0.94)
            out.append((next(ids), link, label))
    out += [(next(ids), out[0][1], None), (next(ids), None, 0), (next(ids), [], 0), (next(ids), [0.0] * 48, 0), (next(ids), [0.0] * 48, 0)]
    out += [(next(ids), [math.nan] * 48, 0), (next(ids), [math.inf] + [1.0] * 47, 0), (next(ids), [None] + [1.0] * 47, 0), (next(ids), [None] + [1.0] * 47, 0)]
    out += [(None, out[0][1], 0), (None, rng.standard_normal(48), 0), (3, out[3][1], out[3][2]), (next(ids), [1.0, 2.0], 0), (next(ids), [2.0, 4.0], 0), (next(ids), [1.0, 2.0, 0.0], 0)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label, "x", 7) for i, v, label in out]


def by_hand(rows):
    ok = [(k, np.array(v, float) / np.linalg.norm(np.array(v, float)), label) for k, (_, v, label, *_) in enumerate(rows)
          if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ways = {k: set() for k in range(len(rows))}
    for a, (k, v, label) in enumerate(ok):
        for j, w, other in ok[a + 1:]:
            if label == other and len(v) == len(w) and v @ w >= capfilters.LIMIT:
                ways[k].add(j)
                ways[j].add(k)
    out = []
    for k, (i, *_) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in ways[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(ways[k]), low, i == low))
    return sorted(out, key=str)


def test_result_equals_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = capfilters.near_duplicates(df)
    assert got.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect()), key=str) == by_hand(rows)


def test_no_rows_and_no_vectors(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert capfilters.near_duplicates(df.limit(0)).count() == 0
    alone = capfilters.near_duplicates(df.where("label is null or embedding is null"), keep=["vec_id"]).collect()
    assert [(r.n_links, r.component_id == r.vec_id, r.kept) for r in alone] == [(0, True, True)] * 2


@pytest.mark.parametrize("dimension, count", [(16, 1 << 12), (64, 1 << 13), (64, 1 << 18), (100, 1 << 15)])
def test_recall_at_the_limit_and_few_candidates(dimension, count):
    rng = np.random.default_rng(5)
    words, threshold = capfilters.design(count, dimension)
    u = capfilters.unit(rng.standard_normal((400, dimension)))
    v = np.array([near(rng, x, capfilters.LIMIT) for x in u])
    one, two = capfilters.filters_of(u, words, threshold), capfilters.filters_of(capfilters.unit(v), words, threshold)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(one, two)]
    assert np.mean(met) >= 0.99
    assert np.mean([len(f) for f in one]) < 90


def test_filters_are_those_above_the_threshold():
    rng = np.random.default_rng(7)
    rows = capfilters.unit(rng.standard_normal((5, 32)))
    words, threshold = capfilters.design(1 << 10, 32)
    got = capfilters.filters_of(rows, words, threshold)
    for row, found in zip(rows, got):
        want = []
        for number in range(capfilters.CODES):
            signs, code = capfilters._code(32, words, number)
            left, right = capfilters._rotated(row[None], signs).reshape(2, -1)
            sums = (code[0] @ left)[:, None] + (code[1] @ right)[None]
            want += (number * words * words + np.flatnonzero(sums.ravel() >= threshold)).tolist()
        assert sorted(found.tolist()) == want
