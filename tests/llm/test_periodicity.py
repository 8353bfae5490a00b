"""Periodic runs against a search of all periods, and extensions against comparing word by word."""
import hashlib
import random
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import periodicity
from tickloom.llm.recompression import Grammar


def all_runs(w):
    """Maximal stretches by trying every period at every place."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if size >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, s + size - p)) for p in range(1, q)):
                out.append((s, size, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_extensions():
    rng = random.Random(3)
    for n, letters in ((50, 1), (300, 2), (5000, 3), (5000, 2)):
        seq = [rng.randrange(letters) for _ in range(n)] + [letters]
        grammar = Grammar(seq)
        x, y = np.array([rng.sample(range(n), 2) for _ in range(300)]).T
        got = grammar.common(x, y)
        for i, j, k in zip(x, y, got):
            assert seq[i:i + k] == seq[j:j + k] and seq[i + k] != seq[j + k]


def test_runs_equal_search_of_all_periods():
    rng, texts = random.Random(4), [[], [b"a"] * 5, [b"a"] * 6, [b"a"] * 4000]
    for _ in range(300):
        letters = [b"%d" % k for k in range(rng.choice([1, 2, 3, 8, 40]))]
        w = [rng.choice(letters) for _ in range(rng.randint(0, 70))]
        at, p = rng.randrange(len(w) + 1), rng.randint(1, 7)
        texts.append(w[:at] + (w[at:at + p] * 12)[:rng.randint(0, 60)] + w[at:])
    found = periodicity.runs_of(texts)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [all_runs(t) for t in texts]


def test_texts_longer_than_one_grammar(monkeypatch):
    monkeypatch.setattr(periodicity, "TOGETHER", 40)
    monkeypatch.setattr(periodicity, "SPAN", 16)
    monkeypatch.setattr(periodicity, "QUERIES", 8)
    periodicity._first_grid.cache_clear()
    rng = random.Random(6)
    texts = [[rng.randrange(2) for _ in range(rng.randint(0, 120))] for _ in range(40)]
    found = periodicity.runs_of(texts)
    periodicity._first_grid.cache_clear()
    assert [[tuple(r) for r in f.tolist()] for f in found] == [all_runs(t) for t in texts]


def row_by_hand(doc_id, text):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", text or "") if w]
    h, n = crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g, original = h // 10, words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_on_odd_rows(spark, odd, odd_rows, none, tmp_path):
    path = str(tmp_path / "in")
    short = odd.where("coalesce(length(text), 0) < 60000")
    more = spark.createDataFrame([(k, " ".join(f"w{(k * i) % 23}" for i in range(k * 7))) for k in range(1, 60)], "doc_id long, text string")
    short.select("doc_id", "text").unionByName(more).write.parquet(f"{path}/documents.parquet")
    got = sorted(map(tuple, periodicity.op11_periodic_runs(spark, path).collect()), key=str)
    kept = [r for r in odd_rows if len(r[1] or "") < 60000] + [tuple(r) for r in more.collect()]
    assert got == sorted((row_by_hand(r[0], r[1]) for r in kept), key=str)
    whole = periodicity.detect(odd, keep=["doc_id", "score"])
    assert whole.count() == len(odd_rows) and whole.where("doc_id = 117").first().collapsed == "1"
    assert periodicity.detect(none).count() == 0
    clash = periodicity.detect(odd.withColumn("RUNS", F.lit(1)))
    assert [c.lower() for c in clash.columns].count("runs") == 1
