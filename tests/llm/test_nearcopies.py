import itertools
import random

from tickloom.llm import nearcopies, simhash


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def near_copies(rng, word, families, n):
    """(doc_id, text) of texts with copies that have one to six words changed."""
    rows = []
    for _ in range(families):
        base = [word() for _ in range(n)]
        rows.append(" ".join(base))
        for changes in (1, 2, 3, 4, 6):
            words = list(base)
            for k in rng.sample(range(n), changes):
                words[k] = word()
            rows.append(" ".join(words))
    return list(enumerate(rows))


def components(rows, linked):
    root = {i: i for i, _ in rows}
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if root[i] != root[j] and linked(a, b):
            low, high = sorted((root[i], root[j]))
            root = {k: low if r == high else r for k, r in root.items()}
    return root


def test_stage_finds_all_near_copies(spark):
    rng = random.Random(11)
    rows = near_copies(rng, lambda: f"w{rng.randrange(50_000)}", 40, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = components(rows, lambda a, b: jaccard(a, b) >= 0.8)
    assert 40 < len(set(root.values())) < len(rows)
    assert sorted(r.doc_id for r in simhash.one_per_group(df).collect()) == sorted(set(root.values()))


def test_large_family_and_common_passage(spark):
    rng = random.Random(12)
    base = [f"w{rng.randrange(50_000)}" for _ in range(120)]
    family = [" ".join(base[:k] + ["odd", str(k)] + base[k:]) for k in range(0, 120)]
    common = " ".join(base[:60])
    others = [common + " " + " ".join(f"x{rng.randrange(50_000)}" for _ in range(60)) for _ in range(150)]
    rows = list(enumerate(family + others))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = components(rows, lambda a, b: jaccard(a, b) >= 0.8)
    assert sorted(r.doc_id for r in simhash.one_per_group(df).collect()) == sorted(set(root.values()))


def test_short_and_repeated_texts(spark):
    rows = [(1, "one two"), (2, "ONE  two"), (3, "two one"), (4, "a b c d e"), (5, "a b c d e a b c d e"), (6, "a b c d e")]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert nearcopies.clusters(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_line_in_a_third_of_the_texts(spark, monkeypatch):
    """Texts that share much but not enough are not paired out; families among them are found."""
    rng = random.Random(13)
    line = " ".join(f"l{k}" for k in range(30))
    word = lambda: f"w{rng.randrange(50_000)}"
    rows = [line + " " + " ".join(word() for _ in range(15)) for _ in range(150)]
    base = [word() for _ in range(45)]
    for _ in range(150):
        words = list(base)
        for k in rng.sample(range(45), 2):
            words[k] = word()
        rows.append(" ".join(words))
    rows += [text for _, text in near_copies(rng, word, 10, 120)]
    rows += [line + " " + text for _, text in near_copies(rng, word, 10, 200)]
    rows += [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(150)]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    seen, plain = [], nearcopies._verified
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, sets: seen.append(pairs.count()) or plain(pairs, sets))
    found = {r.node: r.root for r in nearcopies.clusters(df).collect()}
    root = components(rows, lambda a, b: jaccard(a, b) >= 0.8)
    assert sorted(r.doc_id for r in simhash.one_per_group(df).collect()) == sorted(set(root.values()))
    assert len(found) == sum(list(root.values()).count(x) > 1 for x in root.values())
    assert sum(seen) < 8 * len(rows)


def test_odd_rows(spark, odd, none):
    found = nearcopies.clusters(odd)
    assert found.columns == ["node", "check", "root"] and found.groupBy("root").count().first()["count"] == 2
    assert nearcopies.clusters(none).count() == 0


def test_mixtures_of_lines(spark):
    """Texts made of the same lines in many mixtures: every degree of likeness, hardly a rare shingle."""
    rng = random.Random(14)
    lines = [" ".join(f"m{k}_{i}" for i in range(12)) for k in range(14)]
    rows = list(enumerate("\n".join(rng.sample(lines, rng.randint(6, 13))) for _ in range(160)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = components(rows, lambda a, b: jaccard(a, b) >= 0.8)
    assert sorted(r.doc_id for r in simhash.one_per_group(df).collect()) == sorted(set(root.values()))
