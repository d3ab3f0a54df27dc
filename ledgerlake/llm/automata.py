"""Weighted acyclic automata over words: count transducers of n-grams.

A ``Counts`` accepts n-grams and gives each its count.  It is deterministic
and shares prefixes: level k holds one arc for every accepted prefix of k + 1
words, sorted by (source state, word); the arc's target is the state of that
number on the next level, and all arcs without a continuation end in one
final state.  Arrays, not objects: a million arcs take some ten MB.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Level = tuple[np.ndarray, np.ndarray, np.ndarray]  # source state, word number, weight of each arc


def _narrow(x: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the values (none is negative)."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


@dataclass
class Counts:
    words: list[bytes]   # sorted, so that word numbers sort as words do
    levels: list[Level]

    @staticmethod
    def from_sorted(words: list[bytes], ids: np.ndarray, orders: int, allowed=None) -> Counts:
        """The n-grams of up to ``orders`` words of a sequence of word numbers (-1: a break) and their counts.

        Level by level: the n-grams of a level, sorted, are the arcs, and an
        arc of the next level leaves the state that its prefix led to.
        ``allowed(first, second)`` tells of which word pairs longer n-grams
        may be made; None allows all.
        """
        first = ids[ids >= 0]
        levels = [(np.zeros(len(words), np.int64), np.arange(len(words), dtype=np.int64),
                   np.bincount(first, minlength=len(words)).astype(np.int64))]
        state, v, may = ids, len(words), None
        for n in range(1, orders):
            here, nxt = state[:-1], ids[n:]
            ok = (here >= 0) & (nxt >= 0)
            if n >= 2 and may is not None:
                ok &= may[:len(ok)] & may[n - 1:n - 1 + len(ok)]
            keys, inverse, weight = np.unique(here[ok] * v + nxt[ok], return_inverse=True, return_counts=True)
            levels.append((keys // v, keys % v, weight.astype(np.int64)))
            state = np.full(len(here), -1, np.int64)
            state[ok] = inverse
            if n == 1 and allowed is not None:
                pairs = allowed(*levels[1][:2])
                may = np.zeros(len(state), bool)
                may[ok] = pairs[inverse]
        return Counts(words, levels)

    def only(self, own: list[np.ndarray]) -> Counts:
        """The automaton of the arcs that sorted numbers (one array a level) choose, and of the arcs that lead to them.

        The latter keep no weight.  Words are renumbered.  The cost follows
        the arcs chosen, not the automaton.
        """
        need = [own[-1]]
        for k in range(len(own) - 1, 0, -1):
            need.append(np.union1d(own[k - 1], self.levels[k][0][need[-1]]))
        need.reverse()
        labels = np.unique(np.concatenate([self.levels[k][1][arcs] for k, arcs in enumerate(need)]))
        levels = []
        for k, arcs in enumerate(need):
            source, word, weight = (x[arcs] for x in self.levels[k])
            if k:
                source = np.searchsorted(need[k - 1], source)
            if len(own[k]) < len(arcs):
                weight = np.where(np.isin(arcs, own[k], assume_unique=True), weight, 0)
            levels.append((source, np.searchsorted(labels, word), weight))
        return Counts([self.words[i] for i in labels], levels)

    @staticmethod
    def union(parts: list[Counts]) -> Counts:
        """Accepts what any part accepts; weights of equal n-grams are added."""
        words = sorted(set().union(*(p.words for p in parts)))
        number = {w: i for i, w in enumerate(words)}
        renamed = [np.array([number[w] for w in p.words], np.int64) for p in parts]
        states = [np.zeros(1, np.int64) for _ in parts]
        levels = []
        for k in range(max((len(p.levels) for p in parts), default=0)):
            at = [i for i, p in enumerate(parts) if k < len(p.levels)]
            keys = np.concatenate([states[i][parts[i].levels[k][0]] * len(words) + renamed[i][parts[i].levels[k][1]] for i in at])
            weights = np.concatenate([parts[i].levels[k][2] for i in at])
            found, inverse = np.unique(keys, return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, inverse, weights)
            levels.append((found // max(1, len(words)), found % max(1, len(words)), total))
            ends = np.cumsum([len(parts[i].levels[k][0]) for i in at])
            for i, x in zip(at, np.split(inverse, ends[:-1])):
                states[i] = x
        return Counts(words, levels)

    def at_least(self, least: int) -> Counts:
        """Only n-grams of that weight or more (and the arcs that lead to them, with weight 0)."""
        return self.only([np.flatnonzero(level[2] >= least) for level in self.levels])

    def compose(self, acceptor: Counts) -> list[np.ndarray]:
        """The weight here of every n-gram of ``acceptor``, level by level; 0 if it isn't accepted.

        Both automata are walked together: a pair of states that read the
        same word go on as a pair.
        """
        number = {w: i for i, w in enumerate(self.words)}
        renamed = np.array([number.get(w, -1) for w in acceptor.words], np.int64)
        state, out, v = np.zeros(1, np.int64), [], max(1, len(self.words))
        for k, (source, word, _) in enumerate(acceptor.levels):
            here, label = state[source], renamed[word]
            ok = (here >= 0) & (label >= 0) & (k < len(self.levels))
            weight, state = np.zeros(len(source), np.int64), np.full(len(source), -1, np.int64)
            if ok.any() and len(self.levels[k][0]):
                keys, wanted = self.levels[k][0] * v + self.levels[k][1], here[ok] * v + label[ok]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                weight[ok] = np.where(hit, self.levels[k][2][at], 0)
                state[ok] = np.where(hit, at, -1)
            out.append(weight)
        return out

    @staticmethod
    def of_phrases(phrases: list[list[bytes]]) -> tuple[Counts, list[tuple[int, int]]]:
        """An acceptor of phrases and, for each, the level and the arc at which it ends."""
        words = sorted({w for p in phrases for w in p})
        number = {w: i for i, w in enumerate(words)}
        coded = [[number[w] for w in p] for p in phrases]
        levels, where, states = [], [None] * len(phrases), {(): 0}
        for k in range(max((len(p) for p in phrases), default=0)):
            arcs = sorted({(states[tuple(p[:k])], p[k], tuple(p[:k + 1])) for p in coded if len(p) > k})
            states = {prefix: i for i, (_, _, prefix) in enumerate(arcs)}
            levels.append((np.array([a[0] for a in arcs], np.int64), np.array([a[1] for a in arcs], np.int64),
                           np.zeros(len(arcs), np.int64)))
            for i, p in enumerate(coded):
                if len(p) == k + 1:
                    where[i] = (k, states[tuple(p)])
        return Counts(words, levels), where

    def phrases(self, k: int) -> list[list[bytes]]:
        """The words of every n-gram of k + 1 words, in the order of the level's arcs."""
        out = [[] for _ in self.levels[k][0]]
        state = np.arange(len(out))
        columns = []
        for j in range(k, -1, -1):
            source, word, _ = self.levels[j]
            columns.append(word[state])
            state = source[state]
        for column in reversed(columns):
            for i, w in enumerate(column.tolist()):
                out[i].append(self.words[w])
        return out

    def to_bytes(self) -> bytes:
        import pickle

        import zstandard

        # Sources are sorted: their steps are small numbers.
        plain = [tuple(map(_narrow, (np.diff(s, prepend=0), w, c))) for s, w, c in self.levels]
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((b"\n".join(self.words), len(self.words), plain), 5))

    @staticmethod
    def from_bytes(data: bytes) -> Counts:
        import pickle

        import zstandard

        words, n, plain = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        levels = [(np.cumsum(s.astype(np.int64)), w.astype(np.int64), c.astype(np.int64)) for s, w, c in plain]
        return Counts(words.split(b"\n") if n else [], levels)
