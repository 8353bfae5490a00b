import re

import xxhash

from tickloom.llm import graph, simhash


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Smallest member of each value's component, over links of at most three bits."""
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in prints}


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 180)] + [(200, 200), (300, 299)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 180)) and got[300] == 299 and 200 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_distance_up_to_three_is_linked(spark):
    import random
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        prints.add(x)
        for k in (1, 2, 3, 4):
            y = x
            for b in rng.sample(range(64), k):
                y ^= 1 << b
            prints.add(y)
        low = rng.choice([0, 16, 32, 48])
        prints.add(x ^ (7 << low))  # three bits of one block
        prints.add(x ^ (3 << low) ^ (1 << (low + 40) % 64))
    signed = [(simhash._signed(p),) for p in prints]
    got = {r.fp: r.root for r in simhash.clusters(spark.createDataFrame(signed, "fp long")).collect()}
    want = grouped({s for s, in signed})
    classes = {}
    for p, root in got.items():
        classes.setdefault(root, set()).add(p)
    expected = {}
    for p, root in want.items():
        expected.setdefault(root, set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_odd_rows(odd, odd_rows, none):
    got = simhash.near_duplicates(odd, keep=["doc_id", "text"]).collect()
    assert len(got) == len(odd_rows)
    prints = {t: simhash._signed(plain(t)) for _, t, *_ in odd_rows}
    root = grouped(set(prints.values()))
    ids = {}
    for i, t, *_ in odd_rows:
        if i is not None:
            ids.setdefault(root[prints[t]], []).append(i)
    for r in got:
        assert r.fp == prints[r.text]
        assert r.component_id == min(ids.get(root[prints[r.text]], [None]))
    assert simhash.near_duplicates(none, keep=["doc_id"]).count() == 0


def test_one_of_each_group_stays(odd, odd_rows, none):
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(110) == 1 and 111 not in ids and ids.count(112) <= 1
    assert {100, 101, 102, 103} <= set(ids) and set(range(40)) <= set(ids)
    assert simhash.one_per_group(none).count() == 0
