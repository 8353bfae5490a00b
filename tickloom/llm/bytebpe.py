"""Byte-level BPE: word splitting in Spark and the encoding of single words in tasks."""
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# Fixed pattern: how byte-level BPE splits a text into words. The frequent cases come first, which changes nothing,
# as no two of them can start with the same character; the classes name the white space beyond ASCII.
WORDS = (r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\x85\xA0\p{L}\p{N}]++"
         r"|[\s\x85\xA0]+(?![^\s\x85\xA0])|[\s\x85\xA0]+")
#: Latin text, whose character classes all engines agree on; anything else is split by the tokenizer itself. The
#: first pattern is the quick one.
BEYOND, OTHER = r"[\x{180}-\x{10FFFF}]", r"[^\x00-ſ–—‘-„•…€]"


def default_tokenizer():
    """The public byte-level vocabulary this library is checked with."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def split_columns(docs, text, specials, keep):
    """``docs[keep]`` with ``words`` (array) for Latin texts and ``odd`` (the text itself) for all others."""
    body = F.col("__body")
    odd = (F.octet_length(body) != F.length(body)) & body.rlike(BEYOND) & body.rlike(OTHER)
    for s in specials:
        odd = odd | body.contains(s)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__body"))
    rows = rows.select(*keep, "__body", F.when(~odd, F.regexp_extract_all(body, F.lit(WORDS), F.lit(0))).alias("words"))
    return rows.select(*keep, "words", F.when(F.col("words").isNull(), body).alias("odd"))


def _byte_letters():
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizer:
    """A tokenizers file with a fast path for single words; each part is loaded when it is first used."""

    def __init__(self, path):
        self.path = path

    @cached_property
    def _given(self):
        """(special tokens, bytes of every other piece with its id) of the file."""
        import json

        with open(self.path, encoding="utf-8") as f:
            given = json.load(f)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in given["added_tokens"]}
        vocab = {k: v for k, v in given["model"]["vocab"].items() if k not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in given["model"]["merges"]]
        if [vocab[a + b] for a, b in merges] != sorted(vocab[a + b] for a, b in merges):
            raise ValueError("merges are not in the order of their ids")
        return special, {bytes(letters[c] for c in k): v for k, v in vocab.items()}

    @cached_property
    def whole(self):
        """The library's own tokenizer."""
        from tokenizers import Tokenizer as Loaded

        whole = Loaded.from_file(self.path)
        whole.no_truncation()
        whole.no_padding()
        return whole

    @cached_property
    def fast(self):
        """The same merges for single words."""
        import tiktoken
        return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=self._given[1], special_tokens={})

    @cached_property
    def special(self):
        return dict(zip(special_tokens(self.path), special_ids(self.path)))

    @cached_property
    def pieces(self):
        """The bytes of every id."""
        special, ranks = self._given
        out = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for piece, i in ranks.items():
            out[i] = piece
        for piece, i in special.items():
            out[i] = piece.encode()
        return out

    def words(self, text):
        """The words and special tokens of any text, split by the tokenizer itself."""
        import re

        out, parts = [], [text]
        if self.special:
            parts = re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text)
        for part in parts:
            if part in self.special:
                out.append(part)
            elif part:
                out += [part[a:b] for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def encode_words(self, words):
        """Ids of distinct words: flat uint32 array and the number of ids of each word."""
        one, special = self.fast._core_bpe.encode_single_piece, self.special
        got = [[special[w]] if w in special else one(w.encode()) for w in words]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.uint32, int(lens.sum())), lens


@lru_cache(maxsize=2)
def load(path):
    return Tokenizer(path)


@lru_cache(maxsize=2)
def _added(path):
    import json

    with open(path, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"])


def special_tokens(path):
    return tuple(text for text, _ in _added(path))


def special_ids(path):
    return tuple(i for _, i in _added(path))


def batch_words(batch, tokenizer):
    """(order of rows, flat words, words per row) of a batch with the columns words and odd.

    Rows split in Spark come first, those left to the tokenizer after them.
    """
    words, odd = batch.column("words"), batch.column("odd")
    plain = np.flatnonzero(words.is_valid().to_numpy(zero_copy_only=False))
    rest = np.flatnonzero(odd.is_valid().to_numpy(zero_copy_only=False))
    flat = words.flatten()
    counts = words.value_lengths().to_numpy(zero_copy_only=False)[plain].astype(np.int64)
    if len(rest):
        own = [tokenizer.words(odd[int(i)].as_py()) for i in rest]
        flat = pa.concat_arrays([flat, pa.array([w for ws in own for w in ws], pa.string())])
        counts = np.r_[counts, np.fromiter(map(len, own), np.int64, len(own))]
    return np.r_[plain, rest], flat, counts


def spread(index, ids, lens):
    """Ids of a sequence of words, given as indexes of distinct words with flat ids and lengths; and ids per word."""
    starts = np.cumsum(lens) - lens
    n = lens[index]
    ends = np.cumsum(n)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - starts[index], n)
    return ids[place], n
