"""Periodic runs of words: maximal stretches that repeat with some period at least four times.

Candidates come from a harmonic grid: a run of period q that is at least 4 q long holds three neighbouring multiples of
q from which q words on the same word stands. Each text has n / q grid places for period q, n log n in all. A candidate
is extended exactly to both sides by longest common extensions on the grammar of ``recompression``, one over the words
and one over the words backwards; many texts share a grammar, set apart by symbols that occur once. No suffix array or
other index over the corpus is needed: a text is complete in itself, so the work is one pass without a shuffle.
"""
from collections import defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, read
from tickloom.llm.recompression import Grammar

#: A run has at least TIMES periods and LEAST words.
TIMES, LEAST = 4, 6
#: Words of the texts that share one grammar; a longer text has its own.
TOGETHER = 1 << 17
#: Last words of candidates that are looked at in one step, and candidates extended in one step.
SPAN, QUERIES = 1 << 15, 1 << 19
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def grid(low, high):
    """(last, period) of all candidates whose last word is in [low, high), by last word: the period divides the place."""
    q = np.arange(1, (high - 1) // (TIMES - 1) + 1)
    first = np.maximum((TIMES - 1) * q, -(-low // q) * q)
    count = np.maximum((high - 1 - first) // q + 1, 0)
    period = np.repeat(q, count)
    nth = np.arange(len(period)) - np.repeat(np.cumsum(count) - count, count)
    last = np.repeat(first, count) + nth * period
    order = np.argsort(last, kind="stable")
    return last[order].astype(np.int32), period[order].astype(np.int32)


@lru_cache(maxsize=1)
def _first_grid():
    return grid(0, SPAN)


def candidates(numbers):
    """Pieces (place, period) of grid candidates of one text, given as word numbers."""
    for low in range(0, len(numbers), SPAN):
        last, period = _first_grid() if low == 0 else grid(low, min(low + SPAN, len(numbers)))
        if low == 0 and len(numbers) < SPAN:
            end = np.searchsorted(last, np.int32(len(numbers)))
            last, period = last[:end], period[:end]
        for k in range(TIMES - 1):
            hit = np.flatnonzero(numbers[last - k * period] == numbers[last - (k + 1) * period])
            last, period = last[hit], period[hit]
        if len(last):
            yield last.astype(np.int64) - (TIMES - 1) * period, period.astype(np.int64)


def _kept(start, length, period, owner):
    """Rows (owner, start, length, period) of long enough stretches, once each, with the smallest period."""
    long = length >= np.maximum(LEAST, TIMES * period)
    rows = np.stack((owner, start, length, period), axis=1)[long]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def _extended(texts):
    """Runs of each of ``texts``, a list of (word numbers, pieces of candidates): arrays (start, length, period)."""
    top = max(int(t.max()) for t, _ in texts) + 1
    parts, offsets, at = [], [], 0
    for k, (t, _) in enumerate(texts):
        parts += [[top + k], t]
        offsets.append(at + 1)
        at += 1 + len(t)
    seq = np.concatenate([*parts, [top + len(texts)]]).astype(np.int64)
    ahead, back, n = Grammar(seq), Grammar(seq[::-1]), len(seq)
    found = []
    for queries in _portions(texts, offsets):
        place, period, owner = (np.concatenate(x) for x in zip(*queries))
        right = ahead.common(place, place + period)
        left = back.common(n - place - period, n - place)
        base = np.array(offsets)[owner]
        found.append(_kept(place - left - base, left + right + period, period, owner))
    rows = np.concatenate(found)
    rows = _kept(rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 0])
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    edges = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[a:b, 1:] for a, b in zip(edges, edges[1:])]


def _portions(texts, offsets):
    """The candidates of all texts in lists of at most about QUERIES."""
    out, size = [], 0
    for k, ((_, pieces), base) in enumerate(zip(texts, offsets)):
        for place, period in pieces:
            out.append((place + base, period, np.full(len(place), k)))
            size += len(place)
            if size >= QUERIES:
                yield out
                out, size = [], 0
    if out:
        yield out


class _Numbers(defaultdict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def runs_of(texts):
    """Runs of each text (a list of words, equal words being equal objects in value): int arrays (start, length,
    period), by start and period."""
    out, waiting, size = [np.zeros((0, 3), np.int64)] * len(texts), [], 0

    def flush():
        for k, found in zip([k for k, _, _ in waiting], _extended([(t, c) for _, t, c in waiting])):
            out[k] = found
        waiting.clear()

    number = _Numbers()
    for k, words in enumerate(texts):
        if len(words) < LEAST:
            continue
        numbers = np.array(list(map(number.__getitem__, words)), np.int64)
        if len(words) > TOGETHER:
            if next(candidates(numbers), None) is not None:
                # pieces are made anew while they are extended: those of a long text are never held together
                out[k] = _extended([(np.unique(numbers, return_inverse=True)[1], candidates(numbers))])[0]
            continue
        pieces = list(candidates(numbers))
        if pieces:
            waiting.append((k, numbers, pieces))
            size += len(words)
            if size >= TOGETHER:
                flush()
                size = 0
        if len(number) > 4 * TOGETHER:
            if waiting:
                flush()
            size, number = 0, _Numbers()
    if waiting:
        flush()
    return out


def collapsed(words, runs):
    """``words`` without those that lie in a run behind its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def detect(docs, text="text", keep=None, prepare=None, using=()):
    """``docs[keep]`` with ``runs`` (array of start, length, period in words, by start and period), ``collapsed`` (the
    text without the repeats: kept words joined by one space) and ``n_words``.

    Words are what ASCII white space sets apart. A null or empty text has no words, no runs and an empty ``collapsed``;
    texts are never cut, repeated rows are treated one by one, and kept columns of these three names are replaced.
    ``prepare(words, *values)`` may change the words of a row first, with its values of the columns ``using``.
    """
    def run(batch):
        raw = batch.column(text).cast(pa.binary()).to_pylist()
        given = [batch.column(c).to_pylist() for c in using]
        texts = [(x or b"").split() for x in raw]
        if prepare:
            texts = [prepare(w, *v) for w, *v in zip(texts, *given)]
        found = runs_of(texts)
        lists = [[{"start": int(s), "length": int(n), "period": int(p)} for s, n, p in r] for r in found]
        rest = [b" ".join(collapsed(w, r)) for w, r in zip(texts, found)]
        return [pa.array(lists, _ARROW), pa.array(rest, pa.binary()).cast(pa.string()), pa.array([len(w) for w in texts], pa.int64())]

    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()), T.StructField("n_words", T.LongType())]
    return append(docs, run, fields, keep)


_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def planted(words, doc_id):
    """The words of the query: one text in ten repeats its tail periodically, by the checksum of its id."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    a, g = h // 10 % n, h // 10
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[:n - a]


def op11_periodic_runs(spark, sf_dir):
    """Runs of every document, with the longest one and digests of all runs and of the collapsed text.

    Documents without a run have four nulls; texts that are null or empty have the digest of the empty text.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(docs, keep=["doc_id"], prepare=planted, using=["doc_id"])
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]))
                        .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
                        .otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    found = found.withColumn("best", F.try_element_at(best, F.lit(1)))
    text = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
