"""Phrase collocation mining (operator 11) with weighted acyclic automata.

1. Every task reads texts, a shard for each lang, until it holds
   ``held_words`` words, and builds the count transducer of the largest
   shard's n-grams from their sorted list.  It is cut by prefix, the n-gram's
   first two words, into ranges of a hash.
2. The transducers of a range, one from each shard, are united with added
   weights; n-grams under the least count go.
3. Orders come in two rounds.  Words and word pairs first; a fixed-size
   filter of the frequent pairs then tells shards of which pairs longer
   n-grams can be frequent.  It may let others pass, never hold one back.
4. A candidate's parts are looked up by composition: the acceptor of all
   parts of a range with that range's count transducer.
5. Scores, the test against longer candidates and the ranks are DataFrame
   operations.

* a null text is empty; a null lang is ``other_lang``
* a very long text lies in one shard as a whole
* ties of a score go to the larger count, then to the lesser phrase (bytes)
* repeated rows count as often as they occur
* an empty table gives no rows
* only text and lang are read, so other columns can have any name
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .automata import Counts
from .common import materialize, pick

#: The characters that end a piece, and what else separates words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAKS = bytes.maketrans(PIECE_ENDS, b"." * len(PIECE_ENDS))


@dataclass(frozen=True)
class Settings:
    words: int = 4               # most words of a phrase
    least: int = 30              # least count of a candidate
    inside_percent: int = 80     # of a's count that a longer candidate needs to drop a
    top: int = 2000              # of each lang
    other_lang: str = "und"
    held_words: int = 4_000_000      # that a task holds at most (and at least one text) before its largest shard is counted
    range_bytes: int = 8_000_000     # of text for each prefix range
    filter_bits: int = 1 << 26       # of the frequent pairs' filter


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only) with b"." between pieces."""
    return (text or "").encode("utf-8", "replace").lower().translate(_BREAKS).replace(b".", b" . ").split()


def _hashes(words: list[bytes]) -> np.ndarray:
    """The hash that Spark's xxhash64 gives a string."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)).view(np.int64)


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second << np.int64(1))


def range_of(words: Column, ranges: int) -> Column:
    """The range of a phrase (an array of words): by its first word, or its first two."""
    one = F.xxhash64(words[0])
    return F.pmod(F.when(F.size(words) > 1, one.bitwiseXOR(F.shiftleft(F.xxhash64(F.get(words, 1)), 1))).otherwise(one),
                  F.lit(ranges).cast("long"))


class _Filter:
    """Frequent pairs of words as bits of a fixed-size table; a bit may be set by another pair."""

    def __init__(self, longs: dict[int, int], bits: int):
        self.bits = bits
        self.table = np.zeros(bits // 64, np.uint64)
        for slot, value in longs.items():
            self.table[slot] = value & 0xFFFFFFFFFFFFFFFF

    def has(self, bit: np.ndarray) -> np.ndarray:
        return (self.table[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) != 0


def _bits(lang: str, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    mixed = (_pair_hash(first, second) ^ _hashes([lang.encode()])[0]).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(20)).astype(np.int64) % bits


class _Shard:
    """Word numbers of one lang's texts until the shard is full."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> int:
        found = tokens(text)
        number = self.number
        ids = [number.setdefault(w, len(number)) for w in found]
        ids.append(-1)
        self.parts.append(np.array(ids, np.int32))
        self.size += len(ids)
        return len(ids)

    def counts(self, lang: str, orders: int, frequent: _Filter | None) -> tuple[Counts, int]:
        """The shard's transducer and its number of words."""
        words = sorted(self.number)
        new = np.full(len(words) + 1, -1, np.int64)  # the last one is for -1
        for at, w in enumerate(words):
            new[self.number[w]] = at
        if b"." in self.number:  # pieces end here: a break, not a word
            dot = new[self.number[b"."]]
            words.pop(dot)
            new[new == dot] = -1
            new[new > dot] -= 1
        ids = new[np.concatenate(self.parts)]
        allowed = None
        if frequent is not None:
            hashes = _hashes(words)
            allowed = lambda first, second: frequent.has(_bits(lang, hashes[first], hashes[second], frequent.bits))
        return Counts.from_sorted(words, ids, orders, allowed), int((ids >= 0).sum())


def _ranges(counts: Counts, ranges: int, least_order: int):
    """(range, transducer) of every prefix range in which the n-grams of ``least_order`` words or more lie."""
    hashes = _hashes(counts.words)
    homes = [hashes[counts.levels[0][1]] % ranges]
    if len(counts.levels) > 1:
        source, word, _ = counts.levels[1]
        homes.append(_pair_hash(hashes[counts.levels[0][1][source]], hashes[word]) % ranges)
    for source, _, _ in counts.levels[2:]:
        homes.append(homes[-1][source])
    order = [np.argsort(h, kind="stable") for h in homes]
    bounds = [np.searchsorted(h[o], np.arange(ranges + 1)) for h, o in zip(homes, order)]
    none = np.zeros(0, np.int64)
    for r in range(ranges):
        own = [o[b[r]:b[r + 1]] if k >= least_order - 1 else none for k, (o, b) in enumerate(zip(order, bounds))]
        if any(map(len, own)):
            yield r, counts.only(own)


SHARDS = "lang string, range long, words long, counts binary"


def _shard_batches(s: Settings, ranges: int, least_order: int, orders: int, frequent):
    def run(batches):
        import pyarrow as pa

        shards: dict[str, _Shard] = {}
        held = 0
        table = frequent.value if frequent is not None else None

        def flush(lang):
            counts, words = shards.pop(lang).counts(lang, orders, table)
            for r, part in _ranges(counts, ranges, least_order):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([r], pa.int64()), pa.array([words], pa.int64()),
                     pa.array([part.to_bytes()], pa.binary())], names=["lang", "range", "words", "counts"])
                words = 0  # counted once a shard

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text")
            for i, lang in enumerate(langs):
                if lang not in shards:
                    shards[lang] = _Shard()
                held += shards[lang].add(texts[i].as_py())
                if held >= s.held_words:
                    largest = max(shards, key=lambda x: shards[x].size)
                    held -= shards[largest].size
                    yield from flush(largest)
        for lang in list(shards):
            yield from flush(lang)
    return run


def _united(s: Settings):
    def run(key, rows):
        import pandas as pd

        parts = [Counts.from_bytes(x) for x in rows["counts"]]
        counts = Counts.union(parts).at_least(s.least)
        return pd.DataFrame({"lang": [key[0]], "range": [key[1]], "words": [int(rows["words"].sum())],
                             "counts": [counts.to_bytes()]})
    return run


def _frequent_pairs(s: Settings):
    """(slot, bits): the 64-bit words of the filter in which this transducer's pairs set bits."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                counts = Counts.from_bytes(data)
                if len(counts.levels) < 2:
                    continue
                source, word, weight = counts.levels[1]
                hashes = _hashes(counts.words)
                first = counts.levels[0][1][source]  # the word that led to the source state
                bit = np.unique(_bits(lang, hashes[first], hashes[word], s.filter_bits)[weight >= s.least])
                slots, start = np.unique(bit >> 6, return_index=True)
                if len(slots):
                    values = np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), start)
                    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(values.view(np.int64))], names=["slot", "bits"])
    return run


def _candidates(s: Settings):
    """(lang, words, a): the phrases of two words or more that are frequent."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                counts = Counts.from_bytes(data)
                for k in range(1, len(counts.levels)):
                    weight = counts.levels[k][2]
                    at = np.flatnonzero(weight >= s.least)
                    if len(at):
                        phrases = counts.phrases(k)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(at)), pa.array([[w.decode() for w in phrases[i]] for i in at]),
                             pa.array(weight[at])], names=["lang", "words", "a"])
    return run


def _composed(key, parts, counts):
    """The weight of every part of a range: the acceptor of the parts composed with the range's transducers."""
    import pandas as pd

    asked = [[w.encode() for w in p] for p in parts["words"]]
    acceptor, where = Counts.of_phrases(asked)
    found = [0] * len(asked)
    for data in counts["counts"]:
        weights = Counts.from_bytes(data).compose(acceptor)
        found = [f + int(weights[k][arc]) for f, (k, arc) in zip(found, where)]
    return pd.DataFrame({"lang": parts["lang"], "part": parts["part"], "f": found})


def count_phrases(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, int]:
    """The written count transducers (lang, range, words, counts) of all frequent n-grams, and the number of ranges.

    The sum of ``words`` is the number of words of the lang.  Transducers of
    one range hold different orders.
    """
    s = settings
    src = docs.select(F.coalesce("lang", F.lit(s.other_lang)).alias("lang"), "text")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // s.range_bytes))

    def counted(least_order: int, orders: int, frequent, name: str) -> DataFrame:
        shards = src.mapInArrow(_shard_batches(s, ranges, least_order, orders, frequent), SHARDS)
        return materialize(shards.groupBy("lang", "range").applyInPandas(_united(s), SHARDS), name)

    short = counted(1, min(2, s.words), None, "counts-short")
    if s.words < 3:
        return short, ranges
    bits = short.mapInArrow(_frequent_pairs(s), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    table = _Filter({r["slot"]: r["bits"] for r in bits.toLocalIterator()}, s.filter_bits)  # of a fixed size
    frequent = docs.sparkSession.sparkContext.broadcast(table)
    long = counted(3, s.words, frequent, "counts-long").withColumn("words", F.lit(0).cast("long"))
    return short.unionByName(long), ranges


def phrases(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    s = settings
    counts, ranges = count_phrases(pick(docs, text=text_col, lang=lang_col), s)
    found = materialize(counts.select("lang", "counts").mapInArrow(_candidates(s), "lang string, words array<string>, a long"),
                        "candidates").withColumn("phrase", F.array_join("words", " "))

    cuts = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        k.alias("k"), F.slice("words", F.lit(1), k).alias("first"), F.slice("words", k + 1, F.size("words")).alias("rest")))
    cuts = found.select("lang", "phrase", "a", F.inline(cuts))
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("words")).distinct()
    parts = parts.select("lang", "words", F.array_join("words", " ").alias("part"), range_of(F.col("words"), ranges).alias("range"))
    weights = materialize(parts.groupBy("lang", "range").cogroup(
        counts.select("lang", "range", "counts").groupBy("lang", "range")).applyInPandas(
            _composed, "lang string, part string, f long"), "part-weights")
    wide = lambda c: c.cast("decimal(20,0)")  # noqa: E731  products may pass 64 bits
    scored = cuts.withColumn("first", F.array_join("first", " ")).withColumn("rest", F.array_join("rest", " "))
    for side, name in (("first", "l"), ("rest", "r")):
        w = weights.select(F.col("lang").alias("_lang"), F.col("part").alias("_part"), F.col("f").alias(name))
        scored = scored.join(w, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    scored = scored.withColumn("top", wide(F.lit(2000000)) * wide(F.col("a"))).withColumn("sum", wide(F.col("l")) + wide(F.col("r")))
    scored = scored.withColumn("score", F.expr("top div sum"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")

    # A longer candidate speaks for every phrase inside it.
    spans = [(i, n) for n in range(2, s.words) for i in range(s.words - n + 1)]
    inside = F.array_compact(F.array(*[
        F.when((F.size("words") > n) & (F.size("words") >= i + n), F.array_join(F.slice("words", i + 1, n), " ")) for i, n in spans]))
    longer = found.where(F.size("words") > 2).select("lang", "a", F.explode(inside).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("longest")) if spans else found.limit(0).select("lang", "phrase", F.col("a").alias("longest"))
    left = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * wide(F.col("longest")) < s.inside_percent * wide(F.col("a"))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    n = counts.groupBy("lang").agg(F.sum("words").alias("n"))
    return left.withColumn("rank", rank).where(F.col("rank") <= s.top).join(n, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: DuckDB SQL of op11.
OP11_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed_words AS (SELECT id, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded),
runs AS (SELECT lang, word AS w1, lead(word, 1) OVER piece AS w2, lead(word, 2) OVER piece AS w3, lead(word, 3) OVER piece AS w4
  FROM placed_words WINDOW piece AS (PARTITION BY id ORDER BY i)),
f AS (SELECT lang, 1 AS m, w1 AS phrase, [w1] AS words, count(*) AS a FROM runs GROUP BY lang, w1
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, [w1, w2], count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, [w1, w2, w3], count(*) FROM runs WHERE w3 IS NOT NULL
    GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, [w1, w2, w3, w4], count(*) FROM runs WHERE w4 IS NOT NULL
    GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30),
n AS (SELECT lang, sum(a)::bigint AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m >= 2),
cuts AS (SELECT c.*, x.a AS l, y.a AS r, (2000000::hugeint * c.a) // (x.a::hugeint + y.a) AS score FROM cand c
  JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.phrase = array_to_string(c.words[:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.m = c.m - c.k AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, a, unnest(CASE m WHEN 3 THEN [words[1:2], words[2:3]]
    ELSE [words[1:2], words[2:3], words[3:4], words[1:3], words[2:4]] END) AS part FROM f WHERE m >= 3),
longest AS (SELECT lang, array_to_string(part, ' ') AS phrase, max(a) AS longest FROM inside GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN longest p USING (lang, phrase)
  WHERE p.longest IS NULL OR 100::hugeint * p.longest < 80::hugeint * b.a),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::int AS rank, phrase, a, l, r, n, score::bigint AS score FROM ranks JOIN n USING (lang) WHERE rank <= 2000
"""
