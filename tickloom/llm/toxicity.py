"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

The kernel of two words counts common letter triples, also with up to two other letters in between: a triple
spanning s letters weighs DECAY ** s. Words with letters inserted or left out still share most triples.
Landmarks are words of the labelled sentences; a word's kernel values at them, whitened by the kernel of the
landmarks among themselves (Nyström), are its features. The machine is trained on words: bad ones that a
likelihood-ratio test on labelled sentences chooses once, and clean ones to which each round adds the worst; a document is judged by the margins of its three worst words, of
falling weight, and a logistic curve fitted on other documents turns that into a probability.

Because the machine is linear in the kernel values and those are linear in the word's triples, the whole model folds into
one weight per triple. Scoring a batch is a table lookup per triple of its distinct words in numpy.
"""
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, read, stage

DECAY, SPAN = 0.8, 5
STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
LETTERS = 64
#: Words measured at once.
CHUNK = 20_000
#: At most so many labelled documents of each class are learned from, longer ones than so many characters not.
MAX_DOCS, MAX_CHARS = 3000, 20_000
LANDMARKS, ROUNDS, COST = 192, 6, 10.0
#: At most so many suspected and so many clean words are learned from; a suspected one is this much more frequent.
MAX_WORDS, RATIO = 150_000, 8
#: Clean words that join the negative ones in each round.
NEGATIVES = 3000
THRESHOLD = 0.7
#: Weights of the worst, second and third worst word of a document.
WORST = (1.0, 0.5, 0.3)
# Characters that stand in for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
SPACED = re.compile(r"(?<!\S)\w(?:[ .*_-]\w){2,}(?!\S)")
MARKS = re.compile(r"[\W\d_]+")
ENDS = re.compile(r"[.!?]\s|\n")


def tokens(text):
    """Lower-cased words of a text, with single letters in a row drawn together."""
    text = text.lower().translate(STAND_INS)
    more = [re.sub(r"\W+", "", m.group()) for m in SPACED.finditer(text)]
    return text.split() + more


def unit(token):
    """The letters of a token."""
    return token if token.isalpha() else MARKS.sub("", token)


def _mass(n):
    """Kernel of a word of n letters with itself when no triple repeats."""
    n = np.asarray(n)
    return sum(np.maximum(n - a - b, 0) * DECAY ** (2 * (a + b + 1)) for a, b in STEPS)


def triples(words, alphabet):
    """(word index, triple code, weight) of all triples of letters of the alphabet in the words."""
    text = "".join(words)
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = alphabet[np.minimum(codes, len(alphabet) - 1)].astype(np.int64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lens)
    found = []
    for a, b in STEPS:
        m = len(code) - a - b
        if m <= 0:
            continue
        x, y, z = code[:m], code[a:a + m], code[a + b:]
        ok = np.flatnonzero((owner[:m] == owner[a + b:]) & (x > 0) & (y > 0) & (z > 0))
        found.append((owner[ok], (x[ok] * LETTERS + y[ok]) * LETTERS + z[ok], DECAY ** (a + b + 1)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    weight = np.concatenate([np.full(len(o), w) for o, _, w in found])
    return np.concatenate([o for o, _, _ in found]), np.concatenate([c for _, c, _ in found]), weight


def margins(words, model):
    """The machine's value of each word."""
    if len(words) > CHUNK:
        return np.concatenate([margins(words[k:k + CHUNK], model) for k in range(0, len(words), CHUNK)])
    owner, code, weight = triples(words, model["alphabet"])
    raw = np.bincount(owner, model["weights"][code] * weight, minlength=len(words))
    mass = _mass([len(w) for w in words])
    return np.where(mass > 0, raw / np.sqrt(np.maximum(mass, 1e-12)), 0.0) + model["bias"]


def _kernel(words, landmarks, alphabet):
    """Kernel values of words (rows) at landmarks (columns)."""
    lo, lc, lw = triples(landmarks, alphabet)
    known, place = np.unique(lc, return_inverse=True)
    table = np.zeros((len(known) + 1, len(landmarks)))
    np.add.at(table, (place, lo), lw)
    owner, code, weight = triples(words, alphabet)
    at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
    at = np.where(known[at] == code, at, len(known)) if len(known) else np.zeros(len(code), np.int64)
    out = np.zeros((len(words), len(landmarks)))
    order = np.argsort(owner, kind="stable")
    owner, at, weight = owner[order], at[order], weight[order]
    hit = np.flatnonzero(at < len(known))
    if len(hit):
        owner = owner[hit]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = np.add.reduceat(table[at[hit]] * weight[hit][:, None], first, axis=0)
    norm = np.sqrt(np.maximum(_mass([len(w) for w in words]), 1e-12))[:, None] * np.sqrt(np.maximum(_mass([len(w) for w in landmarks]), 1e-12))
    return out / norm


def _svm(x, y, cost):
    """Linear machine with squared hinge loss (bad examples weigh five times as much), by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y > 0, cost, cost / 5)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        active = y * (x @ w) < 1
        a, c = x[active], weight[active]
        new = np.linalg.solve(ridge + a.T @ (a * c[:, None]), a.T @ (c * y[active]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _alphabet(words):
    """Small numbers for the letters of some words; 0 for all others."""
    letters = sorted({c for u in words for c in u if ord(c) < 0x2FFF})[:LETTERS - 1]
    out = np.zeros(0x3000, np.uint8)
    for k, c in enumerate(letters):
        out[ord(c)] = k + 1
    return out


def _speaking(words, n_bad, n_good, tried):
    """Words of (word, bad, good) that occur in significantly more contexts of bad sentences, strongest first
    (likelihood ratio).

    The bar rises with the number of words tried, so that hardly any passes it by chance.
    """
    found, bar = {}, 2 * np.log(max(10, tried))
    part = lambda k, of, q: k * np.log(k / (of * q)) if k else 0.0
    for u, n, m in words:
        if n * n_good < RATIO * m * n_bad:
            continue
        p = (n + m) / (n_bad + n_good)
        g = 2 * (part(n, n_bad, p) + part(m, n_good, p) + part(n_bad - n, n_bad, 1 - p) + part(n_good - m, n_good, 1 - p))
        if g > bar:
            found[u] = g
    return sorted(found, key=lambda u: (-found[u], u))


def _disguised(word):
    """The word with a strange letter at each inner place in turn: insults are to be known with one inserted."""
    return [word[:k] + "\u0001" + word[k:] for k in range(1, len(word))][:: max(1, len(word) // 4)]


def _features(words, landmarks, alphabet, whiten):
    """Nyström features of words (without ``whiten`` their largest kernel value), some at a time."""
    parts = []
    for k in range(0, len(words), 2000):
        part = _kernel(words[k:k + 2000], landmarks, alphabet)
        parts.append((part.max(axis=1) if whiten is None else part @ whiten).astype(np.float32))
    return np.concatenate(parts)


def train(suspects, common, n_bad, n_good, tried):
    """The machine from (word, bad, good) counts of contexts; None where nothing can be learned.

    ``suspects`` are words that may speak against a text, ``common`` the most frequent clean ones.
    """
    seeds = _speaking(suspects, n_bad, n_good, tried)
    known = set(seeds)
    frequent = [u for u, _, _ in common if u not in known]
    if not seeds or not frequent:
        return None
    third = LANDMARKS // 3
    landmarks = list(dict.fromkeys(seeds[:third] + frequent[:: max(1, len(frequent) // third)][:third]))
    alphabet = _alphabet(landmarks)
    # clean words that look most like the seeds
    like = _features(frequent, seeds[:third], alphabet, None)
    landmarks = list(dict.fromkeys(landmarks + [frequent[k] for k in np.argsort(-like, kind="stable")[:third]]))
    alphabet = _alphabet(landmarks)
    among = _kernel(landmarks, landmarks, alphabet)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-4 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])

    clean = _features(frequent, landmarks, alphabet, whiten)
    bad = _features(seeds + [v for u in seeds for v in _disguised(u)], landmarks, alphabet, whiten)
    # bad sentences are represented by their seeds, clean ones by common words at first; each round adds the worst
    value, pool = -np.arange(len(frequent), dtype=float), np.zeros(len(frequent), bool)
    for _ in range(ROUNDS):
        free = np.flatnonzero(~pool)
        pool[free[np.argsort(-value[free], kind="stable")[:NEGATIVES]]] = True
        w = _svm(np.r_[bad, clean[pool]], np.r_[np.ones(len(bad)), -np.ones(int(pool.sum()))], COST)
        value = clean @ w[:-1] + w[-1]
    fold = whiten @ w[:-1] / np.sqrt(np.maximum(_mass([len(u) for u in landmarks]), 1e-12))
    lo, lc, lw = triples(landmarks, alphabet)
    weights = np.zeros(LETTERS ** 3, np.float64)
    np.add.at(weights, lc, fold[lo] * lw)
    return {"alphabet": alphabet, "weights": weights.astype(np.float32), "bias": float(w[-1]), "a": 4.0, "b": 0.0}


def _judged(values, least):
    """The value of a document from those of its distinct words; ``least`` stands for missing ones."""
    top = [max(v, least) for v in heapq.nlargest(3, values)]
    return sum(w * v for w, v in zip(WORST, top + [least] * (3 - len(top))))


def _curve(v, y):
    """Logistic curve a * v + b by Newton steps, with smoothed targets and both classes of equal weight."""
    p, n = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (p + 1) / (p + 2), 1 / (n + 2))
    c = np.where(y > 0, 0.5 / p, 0.5 / n) * len(y)
    x, w = np.c_[v, np.ones(len(v))], np.array([2.0, 0.0])
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (c * q * (1 - q))[:, None]) + 1e-3 * np.eye(2), x.T @ (c * (q - t)) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.1)), float(w[1])


def _contexts(batches):
    """(label, word before, word) of the labelled sentences."""
    for b in batches:
        seen = set()
        for y, text in zip(b.column("y").to_pylist(), b.column("t").to_pylist()):
            for sentence in ENDS.split(text):
                units = [unit(x) for x in tokens(sentence)]
                seen.update((y, before, u) for before, u in zip(["", *units], units) if len(u) > 2)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*seen), (pa.int32(), pa.string(), pa.string()))], names=["y", "before", "unit"])


def fit(docs, labels, text="text", doc_id="doc_id", label="toxic"):
    """Model from a bounded sample of the labelled rows: the first MAX_DOCS of each class by a hash of the id.

    Two thirds of the distinct texts teach the machine, the others the curve. A word counts once per word before
    it, so that copies and near copies of a text speak once.
    """
    order = F.xxhash64(F.col(doc_id).cast("string"))
    known = labels.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__y"), order.alias("__o"))
    known = known.groupBy("__id", "__o").agg(F.max("__y").alias("__y"))
    some = known.where("__y = 1").orderBy("__o", "__id").limit(MAX_DOCS).union(known.where("__y = 0").orderBy("__o", "__id").limit(MAX_DOCS))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("t")).where(F.length("t") <= MAX_CHARS).join(some, "__id")
    rows = rows.groupBy("t").agg(F.max("__y").alias("y")).withColumn("third", F.pmod(F.xxhash64("t"), F.lit(3)))
    rows = stage(rows.repartition(16, "t"), "sample")
    pairs = rows.where("third > 0").select("y", "t").mapInArrow(_contexts, "y int, before string, unit string").distinct()
    units = stage(pairs.groupBy("unit").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")), "units")
    n_bad, n_good, tried = (x or 0 for x in units.agg(F.sum("bad"), F.sum("good"), F.count_if(F.col("bad") > 0)).first())
    suspects = units.where(F.col("bad") * n_good >= F.col("good") * RATIO * n_bad).where("bad > 0").orderBy(F.desc("bad"), "unit").limit(MAX_WORDS)
    common = units.where("good > 0").orderBy(F.desc("good"), "unit").limit(MAX_WORDS)
    model = train([tuple(r) for r in suspects.collect()], [tuple(r) for r in common.collect()], n_bad, n_good, tried)
    if model is None:
        return None

    def measure(batches):
        for b in batches:
            for y, t in zip(b.column("y").to_pylist(), b.column("t").to_pylist()):
                words = sorted({u for u in map(unit, tokens(t)) if len(u) > 2})
                if words:
                    value = _judged(margins(words, model).tolist(), model["bias"] - 3)
                    yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([value])], names=["y", "v"])

    held = rows.where("third = 0").select("y", "t").mapInArrow(measure, "y int, v double").collect()  # a number per text of the sample
    if len({r["y"] for r in held}) == 2:
        held = sorted(map(tuple, held))
        model["a"], model["b"] = _curve(np.array([v for _, v in held]), np.array([y for y, _ in held]))
    return model


def score(docs, model, text="text", keep=None):
    """``docs`` with score (probability of being toxic) and predicted (1 from 0.7).

    A text without a word of three letters, a null text too, gets the lowest score there is; without a model all get 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        m = shared.value
        texts = batch.column(text).to_pylist()
        if m is None:
            prob = np.zeros(len(texts))
        else:
            docs_ = [set(tokens(t)) if t else () for t in texts]
            raw = list(set().union(*docs_)) if docs_ else []
            units = [unit(t) for t in raw]
            least = m["bias"] - 3
            value = np.where(np.fromiter(map(len, units), np.int64, len(units)) > 2, margins(units, m), least) if raw else np.zeros(0)
            get = dict(zip(units, value.tolist())).__getitem__
            named = dict(zip(raw, units))
            top = np.array([_judged(map(get, {named[t] for t in d}), least) for d in docs_], float)
            prob = 1 / (1 + np.exp(-np.clip(m["a"] * top + m["b"], -500, 500)))
        return pa.array(prob, pa.float64()), pa.array((prob >= THRESHOLD).astype(np.int32))

    return append(docs, run, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], keep)


def held_out(column="doc_id"):
    """Whether crc32 of the id as text leaves 1 after division by 3; a null id does not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def op1_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
