"""Language identification by multinomial naive Bayes over hashed character n-grams.

Counts of (language, bucket) come from all labelled rows in one Spark aggregation; the matrix of log
probabilities is broadcast (its size is languages x buckets, both bounded) and texts are scored in numpy,
one Arrow batch at a time, as sparse rows of n-gram buckets.
"""
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, give_back, read, stage

BUCKETS = 1 << 15
ORDERS = (2, 3)
#: More languages than this are refused: it bounds the broadcast matrix to 64 MB.
MAX_LANGUAGES = 512
#: Code points handled at once; longer texts go through in pieces.
PIECE = 1 << 20
#: A document whose best language is less likely than this is rejected by ``accepted``.
MIN_SCORE = 0.5
UNKNOWN = "und"
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


@lru_cache(maxsize=1)
def _letters():
    """For each code point its lower-case form if it is a letter, else 0."""
    out = np.zeros(0x110000 + 1, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(texts, orders, buckets):
    """Yield (text index, bucket) arrays that together hold every n-gram of letters and gaps.

    A run of other characters counts as one gap; n-grams of gaps alone are left out.
    """
    letters, reach = _letters(), max(orders) - 1
    codes, owner, size = [], [], 0

    def flush():
        c, o = np.concatenate(codes), np.concatenate(owner)
        keep = (c > 0) | np.r_[True, (c[:-1] > 0) | (o[1:] != o[:-1])]
        c, o = c[keep], o[keep]
        for n in orders:
            m = len(c) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ c[k:k + m]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            ok = (o[:m] == o[n - 1:]) & ((c[:m] > 0) | (c[n - 1:] > 0))
            yield o[:m][ok], (h[ok] % np.uint32(buckets)).astype(np.int64)

    for i, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), PIECE):
            # the pieces of a long text overlap by one character less than the longest n-gram
            c = letters[np.frombuffer(text[max(0, at - reach):at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
            codes.append(np.r_[np.uint32(0), c, np.uint32(0)])
            owner.append(np.full(len(c) + 2, i, np.int64))
            size += len(c)
            if size >= PIECE:
                yield from flush()
                codes, owner, size = [], [], 0
    if codes:
        yield from flush()


def fit(docs, text="text", lang="lang", buckets=BUCKETS, orders=ORDERS, alpha=0.5):
    """Model from every row with a text and a language: names, log probabilities, log priors."""
    def count(batches):
        total = {}
        for b in batches:
            langs, texts = b.column(1).to_pylist(), b.column(0).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            sums = np.zeros(len(names) * buckets, np.int64)
            for owner, bucket in grams(texts, orders, buckets):
                sums += np.bincount(code[owner] * buckets + bucket, minlength=len(sums))
            rows = np.bincount(code, minlength=len(names))
            for k, name in enumerate(names):
                have = total.setdefault(name, [np.zeros(buckets, np.int64), 0])
                have[0] += sums[k * buckets:(k + 1) * buckets]
                have[1] += int(rows[k])
            if len(total) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
            del b, texts
            give_back()
        for name, (sums, rows) in total.items():
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(some) + 1)), pa.array(np.r_[some, -1]), pa.array(np.r_[sums[some], rows])],
                names=["lang", "bucket", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    table = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = stage(table, "ngrams")
    names = sorted(r[0] for r in table.where("bucket < 0").select("lang").limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts, prior = np.zeros((buckets, max(1, len(names)))), np.ones(max(1, len(names)))
    got = table.toPandas() if names else None  # at most MAX_LANGUAGES x buckets small rows
    if names:
        at = got["lang"].map({n: k for k, n in enumerate(names)}).to_numpy()
        b, n = got["bucket"].to_numpy(), got["n"].to_numpy()
        counts[b[b >= 0], at[b >= 0]] = n[b >= 0]
        prior[at[b < 0]] = n[b < 0]
    logs = np.log((counts + alpha) / (counts.sum(axis=0) + alpha * buckets)).astype(np.float32)
    return {"names": names, "logs": logs, "prior": np.log(prior / prior.sum()), "buckets": buckets, "orders": orders}


def score_texts(texts, model):
    """(language, probability) of each text; ``und`` and 0 without a letter or without a model."""
    n, names = len(texts), model["names"]
    sums, seen = np.zeros((n, model["logs"].shape[1])), np.zeros(n, bool)
    for owner, bucket in grams(texts, model["orders"], model["buckets"]):
        if not len(owner):
            continue
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sums[owner[first]] += np.add.reduceat(model["logs"][bucket], first, axis=0, dtype=np.float64)
        seen[owner[first]] = True
    sums += model["prior"]
    best = sums.argmax(axis=1)
    prob = 1 / np.exp(sums - sums[np.arange(n), best][:, None]).sum(axis=1)
    known = seen & bool(names)
    return [names[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, prob, 0.0)


def identify(docs, model, text="text", keep=None):
    """``docs`` with lang_pred and score (replacing columns of those names).

    A null or letterless text gives ``und`` with score 0; equal texts get equal results; a tie goes to the
    first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        langs, prob = score_texts(batch.column(text).to_pylist(), shared.value)
        return pa.array(langs, pa.string()), pa.array(prob, pa.float64())

    return append(docs, run, FIELDS, keep)


def held_out(rest):
    """Whether crc32 of doc_id as text leaves ``rest`` after division by 4; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == rest, F.lit(False))


def accepted(docs):
    """Pipeline stage: the documents whose language is recognised, with their own columns unchanged."""
    model = fit(docs.where(~held_out(2)))
    wide = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)], F.col("text"))
    scored = identify(wide, model, keep=[f"c{k}" for k in range(len(docs.columns))])
    return scored.where(f"lang_pred <> '{UNKNOWN}' and score >= {MIN_SCORE}").select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])


def op8_language_id(spark, sf_dir):
    """Predicted language and probability of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(2)))
    out = identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", held_out(2).alias("held_out"), "lang_pred", "score")
