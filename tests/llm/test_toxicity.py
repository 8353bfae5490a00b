import random

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import toxicity

INSULTS = ["idiot", "moron", "loser", "stupid", "worthless"]


def made(rng, bad):
    stems = ["the", "and", "er", "ing", "tion", "ha", "ou", "st", "bl", "on", "en"]
    words = ["".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    if bad:
        words[rng.randrange(60)] = bad
    return " ".join(w + rng.choice(["", "", "", "."]) for w in words)


def test_kernel_counts_gapped_triples():
    letters = {c: k + 1 for k, c in enumerate("abcd")}
    alphabet = np.zeros(200, np.uint8)
    for c, k in letters.items():
        alphabet[ord(c)] = k
    owner, code, weight = toxicity.triples(["abcd", "axbc", "ab"], alphabet)
    got = sorted((o, c, round(w, 6)) for o, c, w in zip(owner.tolist(), code.tolist(), weight.tolist()))
    key = lambda s: (letters[s[0]] * 64 + letters[s[1]]) * 64 + letters[s[2]]
    d = toxicity.DECAY
    want = [(0, key("abc"), d ** 3), (0, key("bcd"), d ** 3), (0, key("abd"), d ** 4), (0, key("acd"), d ** 4), (1, key("abc"), d ** 4)]
    assert got == sorted((o, c, round(w, 6)) for o, c, w in want)


def test_folded_weights_equal_the_kernel():
    rng = random.Random(1)
    clean = [(w, 0, 50) for w in sorted(set(" ".join(made(rng, None) for _ in range(30)).replace(".", "").split())) if len(w) > 2]
    model = toxicity.train([(w, 40, 0) for w in INSULTS], clean, 400, 50 * len(clean), 500)
    values = toxicity.margins([*INSULTS, "idxiot", *[w for w, _, _ in clean[:50]]], model)
    assert values[:len(INSULTS)].min() > values[len(INSULTS) + 1:].max() and values[len(INSULTS)] > 0
    assert toxicity.train([], clean, 0, 10, 1) is None


def test_gapped_and_inserted_insults(spark):
    rng = random.Random(2)
    rows = [(i, made(rng, rng.choice(INSULTS) if i % 4 == 0 else None), int(i % 4 == 0)) for i in range(1200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    tests = [(1, made(rng, w)) for w in ("idiot", "idiiot", "idXiot", "i d i o t", "i-d-i-o-t", "1d1ot", "IDIOT!", "mor0n", "mo.ron", "worthlesss", "stu_pid")]
    tests += [(0, made(rng, None)) for _ in range(200)]
    got = toxicity.score(spark.createDataFrame(tests, "y int, text string"), model).collect()
    assert [r.text for r in got if r.y and not r.predicted] == []
    assert sum(r.predicted for r in got if not r.y) <= 4


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.op1_toxicity(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").collect()
    # the insults of this table collide with clean words of the same language; see the README for figures elsewhere
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(i % 45, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for model in (toxicity.fit(odd, labels), toxicity.fit(none, labels), toxicity.fit(odd, labels.limit(0))):
        got = toxicity.score(odd, model)
        assert got.count() == len(odd_rows)
        assert got.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.7)").count() == 0
        assert toxicity.score(none, model).count() == 0
    same = toxicity.score(odd, toxicity.fit(odd, labels)).groupBy(F.coalesce("text", F.lit(""))).agg(F.countDistinct("score").alias("n"))
    assert same.where("n > 1").count() == 0
