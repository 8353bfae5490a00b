from tickloom.llm import contamination


def plain(docs, items):
    words = lambda t: (t or "").lower().split(" ")
    clean = lambda t: [w for w in words((t or "").replace("\n", " ").replace("\t", " ")) if w]
    out = []
    for i, text in docs:
        own = clean(text)
        for k, item in set(items):
            w = clean(item)
            if not w:
                continue
            n = min(5, len(w))
            want = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)}
            have = {tuple(own[j:j + n]) for j in range(len(own) - n + 1)}
            hit = len(want & have)
            if 100 * hit >= 80 * len(want):
                out.append((i, k, len(want), hit))
    return sorted(out, key=str)


def test_every_containment_is_found(spark, odd, odd_rows):
    base = next(t for i, t, *_ in odd_rows if i == 110).split()
    items = [(1, " ".join(base[20:60])), (2, " ".join(base[20:40] + ["new"] + base[41:60])), (3, "one two"), (4, None), (5, ""),
             (6, "not in any of the texts at all"), (1, " ".join(base[20:60])), (7, " ".join(base[5:10]).upper()), (8, "a b a b a b a b"),
             (9, " ".join(base[100:116] + base[0:5] + base[60:64]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.contained(odd, table).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got), key=str) == plain([(i, t) for i, t, *_ in odd_rows], items)
    clean = contamination.clean_documents(odd, table)
    hit = {r.doc_id for r in got}
    assert clean.columns == odd.columns and clean.count() == sum(i not in hit for i, *_ in odd_rows if i is not None) + 1


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert contamination.contained(odd, items).count() == 0
    assert contamination.clean_documents(odd, items).count() == odd.count()
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert contamination.contained(none, some).count() == 0
