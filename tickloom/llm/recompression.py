"""Run-length grammar of a sequence by recompression, with longest common extensions.

Two kinds of level alternate. A block level replaces each maximal repetition a..a of one symbol by a symbol named
after (a, length); a pair level splits the alphabet in two sides and replaces each adjacent left-right pair by a symbol
named after it. Names are given by content, so equal symbols always spell equal sequences, and what two places share
is cut alike a few symbols behind its start.

An extension query therefore climbs while both places stand at borders of the next level, taking at most a few equal
symbols on each, until two symbols differ; then it goes down again into these two. All queries of a call take each
level together, as arrays.
"""
import numpy as np

#: Ways to split the alphabet that a pair level tries; the one that joins most pairs is taken.
SPLITS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _renamed(codes, fresh):
    """(one new symbol per different code, from ``fresh`` on; the next free symbol)."""
    found, names = np.unique(codes, return_inverse=True)
    return names.reshape(-1) + fresh, fresh + len(found)


def _blocks(seq, fresh):
    """(symbols, index of each one's first child, next free symbol) with every maximal repetition as one symbol."""
    first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
    size = np.diff(first, append=len(seq))
    out, many = seq[first], size > 1
    if many.any():
        out[many], fresh = _renamed(out[many] * (len(seq) + 1) + size[many], fresh)
    return out, first, fresh


def _pairs(seq, fresh, turn):
    """The same with the pairs of a left and a right symbol joined."""
    best, most = None, -1
    for split in range(SPLITS):
        mixed = (seq.astype(np.uint64) + np.uint64(turn * SPLITS + split + 1)) * _ODD
        side = (mixed ^ (mixed >> np.uint64(29))) * _ODD >> np.uint64(63)
        change = side[1:].astype(np.int8) - side[:-1].astype(np.int8)
        for way in (1, -1):
            count = np.count_nonzero(change == way)
            if count > most:
                best, most = change == way, count
    first = np.flatnonzero(np.concatenate(([True], ~best)))
    out = seq[first]
    joined = np.flatnonzero(best)
    place = np.searchsorted(first, joined)
    out[place], fresh = _renamed(seq[joined] * fresh + seq[joined + 1], fresh)
    return out, first, fresh


class Grammar:
    """Levels of a sequence of whole numbers from 0 on. Memory: some 80 bytes per element."""

    def __init__(self, seq):
        seq = np.asarray(seq, np.int64)
        fresh = int(seq.max()) + 1 if len(seq) else 0
        #: symbols of each level; (first child, parent of each child, whether a child is first, whether blocks) of each step up
        self.symbols, self.steps = [seq], []
        turn = 0
        while len(seq) > 1:
            turn += 1
            for block in (True, False):
                if len(seq) < 2:
                    break
                new, first, fresh = _blocks(seq, fresh) if block else _pairs(seq, fresh, turn)
                if len(new) == len(seq):
                    continue
                head = np.zeros(len(seq), bool)
                head[first] = True
                self.steps.append((np.append(first, len(seq)), np.cumsum(head) - 1, head, block))
                self.symbols.append(new)
                seq = new

    def _ahead(self, level, x, y):
        """How far two places with equal symbols go on: over a whole repetition if the next level has blocks."""
        if level < len(self.steps) and self.steps[level][3]:
            first, parent, _, _ = self.steps[level]
            return np.minimum(first[parent[x] + 1] - x, first[parent[y] + 1] - y)
        return 1

    def _differing(self, level, x, y, who, rising=None):
        """Move ``who`` on at ``level`` until the symbols differ; those are returned. With ``rising``, queries that
        stand at borders of the next level on both sides are put there instead."""
        symbols, out = self.symbols[level], []
        while len(who):
            a, b = x[who], y[who]
            if rising is not None:
                head = self.steps[level][2]
                up = head[a] & head[b]
                rising.append(who[up])
                who, a, b = who[~up], a[~up], b[~up]
            same = symbols[a] == symbols[b]
            out.append(who[~same])
            who, a, b = who[same], a[same], b[same]
            step = self._ahead(level, a, b)
            x[who], y[who] = a + step, b + step
        return np.concatenate(out) if out else who

    def common(self, start, other):
        """Length of the longest common extension of each pair of different places, to the right.

        The sequence must differ before its end for every pair: callers close each text with a symbol of its own.
        """
        x, y = np.array(start, np.int64), np.array(other, np.int64)
        who, stopped, top = np.arange(len(x)), [], len(self.steps)
        for level in range(top + 1):
            rising = [] if level < top else None
            stopped.append(self._differing(level, x, y, who, rising))
            if not rising:
                break
            who = np.concatenate(rising)
            if not len(who):
                break
            parent = self.steps[level][1]
            x[who], y[who] = parent[x[who]], parent[y[who]]
        who = np.zeros(0, np.int64)
        for level in range(len(stopped) - 1, 0, -1):
            who = np.concatenate((who, stopped[level]))
            first = self.steps[level - 1][0]
            x[who], y[who] = first[x[who]], first[y[who]]
            who = self._differing(level - 1, x, y, who)
        return x - np.asarray(start, np.int64)
