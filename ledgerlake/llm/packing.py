"""Best-fit packing by a grouping genetic algorithm on islands (operator 4).

Documents become pieces of at most ``capacity`` tokens; pieces that fill a
sequence alone need no packing.  The others are dealt evenly to islands of a
bounded size.  On an island a population of packings evolves: crossover
injects whole well-filled bins of one parent into the other, the bins that
held the same pieces are removed, and the displaced pieces are best-fitted
again.  Between epochs elites migrate in a ring: the patterns (length
multisets) of an island's best-filled bins go to the next one, which builds
them from its own pieces.

An island holds at most about ``island_pieces`` rows of a few numbers, so no
group grows with the corpus; what is lost against one packing is at most one
sequence per island.  The seeds are fixed and the pieces are a written table,
so a recomputed island gives the same packing.

A null or empty text is one piece holding the end token.  Every row is packed,
repeated rows and null ids too; very long texts are cut into pieces, none is
lost.  Ties among pieces of equal length go by their numbers.  Empty input gives
an empty result.  Only the id and the text are read, so other columns can have
any name.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pick


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    island_pieces: int = 8192
    population: int = 6
    generations: int = 16     # children per epoch
    epochs: int = 2           # with a migration before each but the first
    migrants: int = 64        # elite patterns that an island sends
    slack: int = 4            # unused tokens up to which a bin counts as well filled
    seed: int = 11


# ---- pieces -----------------------------------------------------------------

def _piece_batches(tokenizer: str, end_id: int | None, capacity: int, keep_ids: bool):
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        import pyarrow as pa

        from .ranks import encoder

        encode = encoder(tokenizer).ids
        for batch in batches:
            texts = batch.column("text")
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(batch.num_rows):
                data = encode(texts[i].as_py() or "") + end
                n = len(data) // 4
                at, k = 0, 0
                while at < n or k == 0:
                    to = at + ((n % capacity or capacity) if k == 0 and n > capacity else min(capacity, n - at))
                    part = data[4 * at:4 * to]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(part))
                    ids.append(part if keep_ids else None)
                    at, k = to, k + 1
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int | None = 0, capacity: int = 2048,
               keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and ids, little-endian uint32).

    A document of more than ``capacity`` tokens is cut so that all pieces but
    the first are full.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    schema = (f"doc_id {dict(src.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"
              + ", ids binary" * keep_ids)
    return src.mapInArrow(_piece_batches(tokenizer, end_id, capacity, keep_ids), schema)


# ---- one island -------------------------------------------------------------

class Packing:
    """Bins of item numbers with the room left in each."""

    __slots__ = ("bins", "room")

    def __init__(self, bins: list[list[int]], room: list[int]):
        self.bins, self.room = bins, room

    def rank(self) -> tuple[int, int]:
        """Fewer bins first, then the more uneven room (fuller full bins)."""
        return len(self.bins), -sum(r * r for r in self.room)


def best_fit(items, lengths, capacity: int, packing: Packing) -> Packing:
    """Puts each item, in the given order, into the open bin with the least room that holds it.

    Bins are kept by room; an integer's bits tell which rooms occur, so the
    least sufficient room is its lowest set bit from the length upwards.
    """
    bins, room = packing.bins, packing.room
    by_room: dict[int, list[int]] = defaultdict(list)
    present = 0
    for b, r in enumerate(room):
        if r:
            by_room[r].append(b)
            present |= 1 << r
    for i in items:
        n = lengths[i]
        fits = present >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            same = by_room[r]
            b = same.pop()
            if not same:
                present ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
            room.append(0)
        r -= n
        room[b] = r
        if r:
            by_room[r].append(b)
            present |= 1 << r
    return packing


def crossover(donor: list[list[int]], other: Packing, lengths, capacity: int, dissolve) -> Packing:
    """The donor's bins whole, the other's bins that share no item with them, the rest best-fitted."""
    used = bytearray(len(lengths))
    for bin_ in donor:
        for i in bin_:
            used[i] = 1
    bins, displaced = [list(b) for b in donor], []
    for k, bin_ in enumerate(other.bins):
        if k in dissolve or any([used[i] for i in bin_]):
            displaced.extend([i for i in bin_ if not used[i]])
        else:
            bins.append(list(bin_))
    room = [capacity - sum([lengths[i] for i in b]) for b in bins]
    displaced.sort(key=lambda i: (-lengths[i], i))
    return best_fit(displaced, lengths, capacity, Packing(bins, room))


def _from_patterns(patterns: list[list[int]], lengths) -> list[list[int]]:
    """Migrated patterns built from this island's items, as often as its items allow once each."""
    free: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        free[n].append(i)
    built = []
    for pattern in patterns:
        taken = []
        for n in pattern:
            if not free[n]:
                break
            taken.append(free[n].pop())
        if len(taken) == len(pattern):
            built.append(taken)
        else:
            for i in taken:
                free[lengths[i]].append(i)
    return built


def evolve(lengths: list[int], start: list[list[int]] | None, patterns: list[list[int]], s: Settings,
           seed: int) -> list[list[int]]:
    """The best packing found for one island's items, as bins of item numbers."""
    rng = np.random.default_rng([s.seed, seed])
    n, cap = len(lengths), s.capacity
    least = -(-sum(lengths) // cap)
    order = sorted(range(n), key=lambda i: (-lengths[i], i))
    people = [best_fit(order, lengths, cap, Packing([], []))]
    if start:
        people.append(Packing(start, [cap - sum([lengths[i] for i in b]) for b in start]))
    if patterns and min(len(p.bins) for p in people) > least:
        people.append(crossover(_from_patterns(patterns, lengths), people[-1], lengths, cap, frozenset()))
    while len(people) < s.population and min(len(p.bins) for p in people) > least:
        noise = rng.uniform(0.75, 1.25, n)  # other orders, still large pieces first
        people.append(best_fit(sorted(range(n), key=lambda i: -lengths[i] * noise[i]), lengths, cap, Packing([], [])))
    people.sort(key=Packing.rank)
    for _ in range(s.generations):
        if len(people[0].bins) <= least:
            break
        a, b = rng.choice(len(people), 2, replace=False) if len(people) > 1 else (0, 0)
        giver, taker = people[min(a, b)], people[max(a, b)]
        filled = sorted(range(len(giver.bins)), key=giver.room.__getitem__)
        well = [k for k in filled if giver.room[k] <= s.slack] or filled[:max(1, len(filled) // 4)]
        chosen = [giver.bins[k] for k in well if rng.random() < 0.7]
        poor = sorted(range(len(taker.bins)), key=taker.room.__getitem__)[-max(2, len(taker.bins) // 50):]
        child = crossover(chosen, taker, lengths, cap, frozenset(poor))
        if child.rank() < people[-1].rank():
            people[-1] = child
            people.sort(key=Packing.rank)
    return people[0].bins


def _island(s: Settings, epoch: int):
    def run(key, pieces, elites):
        lengths = pieces["length"].tolist()
        if not lengths:
            return pieces.assign(bin=np.zeros(0, np.int64), offset=np.zeros(0, np.int64))
        start = None
        if epoch:
            held = defaultdict(list)
            for i, b in enumerate(pieces["bin"].tolist()):
                held[b].append(i)
            start = list(held.values())
        patterns = [list(p) for p in elites["pattern"]]
        bins = evolve(lengths, start, patterns, s, int(key[0]) * 31 + epoch)
        bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b, items in enumerate(bins):
            at = 0
            for i in items:
                bin_of[i], offset[i] = b, at
                at += lengths[i]
        return pieces.assign(bin=bin_of, offset=offset)
    return run


# ---- islands on Spark -------------------------------------------------------

def _elites(packed: DataFrame, islands: int, s: Settings) -> DataFrame:
    """The patterns of each island's best-filled bins, addressed to the next island."""
    bins = packed.groupBy("island", "bin").agg(F.sort_array(F.collect_list("length"), False).alias("pattern"),
                                               F.sum("length").alias("filled"))
    best = bins.where(F.col("filled") >= s.capacity - s.slack).withColumn("at", F.row_number().over(
        Window.partitionBy("island").orderBy(F.desc("filled"), F.desc(F.size("pattern")), "bin")))
    return best.where(F.col("at") <= s.migrants).select(
        ((F.col("island") + 1) % islands).alias("island"), "pattern")


def pack_pieces(pieces: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``pieces`` (any columns, with ``length``) plus sequence_id and offset.

    ``pieces`` must be a written table (its rows are numbered while read).
    Island sequences count upwards from island * 2^32; full pieces get
    negative numbers.
    """
    s, spark = settings, pieces.sparkSession
    columns = pieces.columns
    is_full = F.col("length") >= s.capacity
    full = pieces.where(is_full).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                                        F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(~is_full)
    islands = max(1, -(-rest.count() // s.island_pieces))
    packed = rest.withColumn("island", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(islands)))
    packed = packed.withColumn("bin", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    schema = packed.schema
    elites = spark.createDataFrame([], "island long, pattern array<long>")
    for epoch in range(s.epochs):
        packed = materialize(
            packed.groupBy("island").cogroup(elites.groupBy("island")).applyInPandas(_island(s, epoch), schema),
            "islands")
        if epoch + 1 < s.epochs:
            elites = _elites(packed, islands, s)
    numbered = packed.withColumn("sequence_id", F.col("island") * F.lit(1 << 32) + F.col("bin"))
    return numbered.select(*columns, "sequence_id", "offset").unionByName(full)


def pack(docs: DataFrame, tokenizer: str, end_id: int | None = 0, settings: Settings = Settings(),
         keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_pieces(docs, tokenizer, end_id, settings.capacity, keep_ids, id_col, text_col)
    return pack_pieces(materialize(pieces, "pieces"), settings)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence from ``pack(..., keep_ids=True)``: sequence_id, length, ids (at most the capacity)."""
    parts = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
