"""Ranked search against scoring every document, with odd rows, ties and several passes."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, items, k=10):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    number, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        rows = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * number // total
            s = sum(r * math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in asked.items() if c[t])
            rows.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(r for r in rows if r[0])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "éÀ", "漢字", "Don't", "x_y"]
    odds = [1 / (k + 1) for k in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 80)))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[5][1]), (None, docs[6][1]), (2000, None), (2001, " ,; "), (2002, "w1 " * 30000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 200 if i % 5 == 0 else 30)))) for i in range(25)]
    return docs, items + [(30, docs[5][1]), (31, None), (32, "--"), (33, "unheard of"), (34, "W1 W1 w1")]


def test_search_equals_scoring_all(spark, tables):
    docs, items = tables
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumnsRenamed({"text": "body"}).selectExpr("*", "1 AS term", "'a' AS score", "2 AS n").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    got = lexical.search(d, i, text="body")
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_several_passes_and_small_blocks(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(lexical, "ITEM_CHARS", 3000)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(d, i, k=3).collect()), key=str) == by_hand(docs, items, 3)


def test_empty_tables(spark, tables):
    docs, items = tables
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("text is null"), i)):
        got = lexical.search(a, b)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_masks_group_equal_columns():
    rng = np.random.default_rng(2)
    for terms in (1, 8, 64, 65, 150):
        present = rng.random((terms, 500)) < 0.02
        group, first = lexical.masks_of(present)
        assert (present[:, first[group]] == present).all() and len(first) == len({c.tobytes() for c in np.ascontiguousarray(present.T)})


def test_blocks_evaluate_few_documents(monkeypatch):
    """Of many documents only those whose mask can still count are scored."""
    rng = np.random.default_rng(1)
    tf = (rng.random((12, 4096)) < 0.1).astype(np.int64)
    tf[:, :20] = 3
    term, doc = np.nonzero(tf)
    order = np.argsort(doc, kind="stable")
    block = lexical._Block(np.arange(4096), np.zeros(4096, bool), np.full(4096, 100), doc[order], term[order].astype(np.int32), tf[term, doc][order], 12)
    best, seen, parts = lexical._Best(10), [], lexical._parts
    monkeypatch.setattr(lexical, "_parts", lambda t, m: seen.append(np.size(m)) or parts(t, m))
    lexical._search(block, np.arange(12), np.full(12, 1000), best)
    assert best.ids.tolist() == list(range(10)) and sum(seen) < 200
