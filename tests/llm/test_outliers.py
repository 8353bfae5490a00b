import re
from collections import Counter

import numpy as np

from tickloom.llm import outliers


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    seen, inside = Counter(runs), set()
    for k, r in enumerate(runs):
        if seen[r] > 1:
            inside |= {k, k + 1, k + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_statistics(odd, odd_rows, none):
    got = outliers.judge(odd, keep=("doc_id", "text")).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        want = plain(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept) and r.kept is not None
    assert outliers.judge(none).count() == 0


def test_estimate_resists_outliers(spark):
    rng = np.random.default_rng(3)
    d = len(outliers.VECTOR)
    mix = rng.normal(size=(d, d)) + 2 * np.eye(d)
    good = rng.normal(size=(4000, d)) @ mix.T + 5
    bad = rng.normal(size=(800, d)) * 0.1 + 60
    rows = [("g", *map(float, r)) for r in np.r_[good, bad]] + [("one", *map(float, good[0]))]
    df = spark.createDataFrame(rows, ["g", *outliers.VECTOR])
    got = {r.g: r for r in outliers.estimates(df).collect()}
    assert np.abs(np.array(got["g"].centre) - good.mean(axis=0)).max() < 0.6
    inverse = np.array(got["g"].inverse).reshape(d, d)
    far = lambda x: np.einsum("ij,jk,ik->i", x - got["g"].centre, inverse, x - got["g"].centre) / got["g"].scale
    assert (far(bad) > outliers.CHI_CUT).all() and (far(good) > outliers.CHI_CUT).mean() < 0.005
    assert "one" in got


def test_clean_texts_stay_and_junk_goes(spark):
    out = outliers.op6_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    assert sum(clean) >= 0.98 * len(clean)


def test_third_of_copies_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    clean = docs.where("lang = 'en' and quality = 1").orderBy("doc_id").limit(600).select("doc_id", "text").collect()
    junk = " ".join(f"BUY{k} $$$ ##" for k in range(40))
    rows = [(r.doc_id, r.text, "en", "s") for r in clean] + [(-k, junk, "en", "s") for k in range(1, 301)]
    got = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got if r.doc_id < 0)
    assert not any(r.kept for r in got if r.doc_id < 0)
    assert sum(r.kept for r in got if r.doc_id > 0) >= 0.97 * sum(not r.base_failed for r in got if r.doc_id > 0)
