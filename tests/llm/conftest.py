"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""
import random

import pytest


def prose(rng, n, stems=("the", "of", "and", "ther", "on", "in", "er", "ing", "th", "is", "a", "ble", "re")):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(5)
    base = prose(rng, 220)
    words = base.split()
    near = " ".join(words[:110] + ["changed"] + words[111:])
    rows = [(i, prose(rng, rng.randint(60, 200)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100, None, "en", "s0"), (101, "", "fr", None), (102, None, None, None), (103, " \n\t ", "en", "s1"), (104, "!!! 123", "en", "s1")]
    rows += [(110, base, "en", "s0"), (111, base, "en", "s0"), (112, near, "en", "s1"), (112, near, "en", "s1"), (113, "x" * 200_000, "en", "s0")]
    rows += [(None, base, "en", "s0"), (None, "ein kurzer Satz über nichts", "de", "s2"), (114, "one two", "en", "s2"), (115, "éà 漢字 🙂 don't <|endoftext|> ok", "fr", "s2")]
    rows += [(116, prose(rng, 30) + " mail bob.b@site.example.org, call +1 (514) 555-8389 or 4111 1111 1111 1111 at 10.20.30.40 " + prose(rng, 30), "en", "s2")]
    rows += [(117, "1 " * 50_000, "en", "s0"), (118, "a@" * 20_000 + "b.c", "en", "s0")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows, tmp_path_factory):
    """The odd rows as a stored table with extra columns whose names clash with results."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    df = spark.createDataFrame([r + (len(r[1] or ""), 7.5, "mine", 3) for r in odd_rows],
                               "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, fp int")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, odd):
    """The same table without rows."""
    return spark.createDataFrame([], odd.schema)
