"""MinHash near-duplicate detection with tensored banding (operator 2).

A text's set holds the 64-bit hashes of its distinct word shingles.  Two
collections of ``groups`` small hashes are computed, each hash made of
``rows`` minima.  Every pair of one hash from either collection is a table
key: groups * groups tables for the minima of 2 * groups * rows hash
functions, about the square root of what separate tables would take.  With
the defaults two sets of similarity 0.8 share a key with probability above
0.9996.

1. Equal sets are one class, named by its smallest id (a digest of the whole
   set, partial aggregation), so copies don't meet again.
2. Small hashes that only one class has can't form a shared key and are
   dropped before pairs are formed.
3. Shingles that no other of the remaining classes has can't be in an
   intersection.  Their number bounds the similarity of any pair from above,
   exactly: a class whose own shingles are too many can link with nothing
   and leaves, and other pairs are skipped by their sizes.
4. In each bucket (classes with equal key) the class with the fewest
   shingles of its own is the hub, and every member that may reach the
   similarity is verified against it on full sets.  Links become components.
   What is left goes on in the buckets of the first collection's small hashes
   alone, which hold every pair that shares a key.  Buckets with several
   components compare all members if they are small; in large ones classes
   that share a rare shingle are compared, which sharpens the bound for all
   other pairs to the shingles that many have, and hubs go on, more a round,
   until no bucket has two components that might link.  So every pair
   of different texts that shares a key is verified, ruled out by an exact
   bound, or already connected, without pairing all members of a bucket, and
   without a cap.

Null and empty texts have empty sets and are linked with nothing; very long
texts are compared whole; an empty table gives no rows.  Rows with a null id
are not compared: their component is null and they are kept.  Rows that repeat
an id are expected to repeat its text; each row gets the component of its own
text's class (``keep_one`` tells texts of one id apart).  Ties need no rule:
a class is named by its least id.  Only the id and the text are read, so other
columns can have any name but those that begin with ``_ll_``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.joins import bounded_rows, broadcast_row_limit
from .common import materialize, pick
from .graph import components


@dataclass(frozen=True)
class Settings:
    words: int = 5               # words of a shingle
    percent: int = 80            # 100 * intersection >= percent * union
    rows: int = 3                # minima in a small hash
    groups: int = 12             # small hashes in each of the two collections
    hubs: tuple = (64, 512)      # of a bucket in the rounds after the first; the last holds for all others
    rare: int = 32               # shingles of fewer open classes pair these directly, see _rare_pairs
    broadcast_pairs: int = 200_000  # most candidate pairs that are broadcast (two numbers each)
    seed: int = 5


M1, M2, K = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
S33 = np.uint64(33)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (wrapping 64-bit arithmetic)."""
    x = (x ^ (x >> S33)) * M1
    x = (x ^ (x >> S33)) * M2
    return x ^ (x >> S33)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; of the whole sequence if it is shorter.

    Words are split at ASCII white space and A-Z is lower-cased, both as
    bytes methods do it.
    """
    from xxhash import xxh3_64_intdigest

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = min(words, len(h))
    total = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        total = total * K + h[i:len(h) - n + 1 + i]
    return np.unique(_mixed(total))


class SmallHashes:
    """The two collections of a set's small hashes, 2 * groups numbers."""

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        n = 2 * s.groups * s.rows
        self.flip = rng.integers(0, 1 << 64, n, dtype=np.uint64)[:, None]
        self.odd = (rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1))[:, None]
        self.salt = _mixed(np.arange(1, 2 * s.groups + 1, dtype=np.uint64) * K)
        self.shape = (2 * s.groups, s.rows)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        least = None
        for at in range(0, len(hashes), 1024):
            part = ((hashes[None, at:at + 1024] ^ self.flip) * self.odd).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        least = least.reshape(self.shape)
        out = self.salt.copy()
        for r in range(self.shape[1]):
            out = _mixed(out * K + least[:, r])
        return out.view(np.int64)


def _signature_batches(s: Settings):
    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        small = SmallHashes(s)
        for batch in batches:
            texts = batch.column("text")
            sizes, digests, hashes = [], [], []
            for i in range(batch.num_rows):
                found = shingle_set(texts[i].as_py(), s.words)
                sizes.append(len(found))
                digests.append(xxh3_128_digest(found.tobytes()) if len(found) else None)
                hashes.append(small(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(hashes, pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "hashes"])
    return run


def _set_batches(s: Settings):
    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            nodes, digests, texts = (batch.column(c) for c in ("node", "digest", "text"))
            sets = [shingle_set(texts[i].as_py(), s.words) for i in range(batch.num_rows)]
            of = [i for i, x in enumerate(sets) if xxh3_128_digest(x.tobytes()) == digests[i].as_py()]
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(of, pa.int64())), pa.array([sets[i].view(np.int64) for i in of], pa.list_(pa.int64()))],
                names=["node", "members"])
    return run


def _classes(signatures: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: digest, node (smallest id), n, hashes."""
    return signatures.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("hashes").alias("hashes"))


def _small(ids: DataFrame) -> DataFrame:
    """A written column of numbers, broadcast if a count proves it small (a million rows at most).

    The other side, every hash or every text, is then filtered where it is
    read; beyond the bound both sides are shuffled.
    """
    return F.broadcast(ids) if bounded_rows(ids, broadcast_row_limit(ids)) else ids


def _shared(classes: DataFrame, s: Settings) -> DataFrame:
    """(node, a, b): the small hashes of either collection that some other class has too."""
    # The lowest bit of a hash tells its collection, so that rows are two numbers.
    marked = F.transform("hashes", lambda h, at: h.bitwiseAND(F.lit(-2)) + (at >= s.groups).cast("long"))
    each = classes.select("node", F.explode(marked).alias("h"))
    shared = materialize(each.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h"), "shared-hashes")
    second = F.col("h") % 2 != 0
    kept = each.join(_small(shared), "h", "left_semi").groupBy("node").agg(
        F.collect_list(F.when(~second, F.col("h"))).alias("a"), F.collect_list(F.when(second, F.col("h"))).alias("b"))
    return materialize(kept.where("size(a) > 0 and size(b) > 0"), "shared-by-class")


def _sets(docs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """(node, members): the full sets of ``nodes`` (node, digest), one row each, made from their whole texts.

    Of rows that repeat a node's id those with another set are left out, and
    of equal ones one stays: later counts are of classes, not of rows.
    """
    ids = _small(materialize(nodes.select("node", "digest"), "set-ids"))
    found = docs.join(ids, docs["doc_id"] == ids["node"]).select("node", "digest", "text")
    sets = found.mapInArrow(_set_batches(s), "node long, members array<long>")
    return materialize(sets.dropDuplicates(["node"]), "sets")


def _alive(shared: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """(node, n, t, a, b) of the classes that can link; t counts shingles that other classes have too."""
    holders = sets.select("node", F.explode("members").alias("shingle")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("k"), F.min("node").alias("node"))
    own = materialize(holders.where("k = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own")), "own-shingles")
    sized = sets.select("node", F.size("members").cast("long").alias("n")).join(own, "node", "left")
    sized = sized.withColumn("t", F.col("n") - F.coalesce(F.col("own"), F.lit(0))).drop("own")
    return materialize(shared.join(sized.where(100 * F.col("t") >= s.percent * F.col("n")), "node"), "alive")


def _table_entries(alive: DataFrame) -> DataFrame:
    """Bucket entries (key, node, n, t): a key for every pair of small hashes, one of either collection."""
    keys = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    return alive.select("node", "n", "t", F.explode(keys).alias("key"))


def _may_link(n1: Column, t1: Column, n2: Column, t2: Column, s: Settings) -> Column:
    """Whether an intersection of all shared shingles of the smaller side would reach the similarity."""
    most = F.least(t1, t2)
    return 100 * most >= s.percent * (n1 + n2 - most)


def _candidates(entries: DataFrame, hubs: DataFrame, s: Settings) -> DataFrame:
    """Distinct pairs (u, v) of a hub and a member of another component in the same bucket."""
    h = hubs.select("key", *[F.col(c).alias(f"hub_{c}") for c in ("node", "n", "t", "component")])
    met = entries.join(h, "key").where((F.col("component") != F.col("hub_component")) & _may_link(
        F.col("n"), F.col("t"), F.col("hub_n"), F.col("hub_t"), s))
    return met.select(F.least("node", "hub_node").alias("u"), F.greatest("node", "hub_node").alias("v")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets reach the similarity.

    Up to ``broadcast_pairs`` pairs (counted) are broadcast, which picks their
    sets without a shuffle; more are joined by shuffles.
    """
    if bounded_rows(pairs, s.broadcast_pairs):
        nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))
        sets = sets.join(F.broadcast(nodes.distinct()), "node", "left_semi")
        pairs = F.broadcast(pairs)
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return left.join(pairs, "u").join(right, "v").where(100 * both >= s.percent * union).select("u", "v").distinct()


def _still_open(entries: DataFrame, s: Settings) -> DataFrame:
    """Entries of buckets with several components, without members that can link with none of the bucket.

    The smallest set of the bucket gives the least union a member can have.
    """
    by_key = entries.groupBy("key").agg(F.min("n").alias("least_n"), F.min("component").alias("c0"),
                                        F.max("component").alias("c1")).where("c0 != c1").select("key", "least_n")
    least_union = F.col("n") + F.greatest(F.col("least_n"), F.col("t")) - F.col("t")
    return entries.join(materialize(by_key, "mixed-buckets"), "key").where(
        100 * F.col("t") >= s.percent * least_union).drop("least_n")


def _rare_pairs(entries: DataFrame, sets: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Pairs of the entries' classes that share a rare shingle, and (node, uncommon): how many others each has.

    A rare shingle is held by fewer than ``rare`` of these classes, so it
    makes a bounded number of pairs; of the others no more than ``rare``
    holders are looked at.  Two classes that share no rare shingle can only
    have common ones in their intersection.
    """
    nodes = entries.select("node").distinct()
    each = sets.join(nodes, "node", "left_semi").select("node", F.explode("members").alias("shingle"))
    at = F.row_number().over(Window.partitionBy("shingle").orderBy("node"))
    few = each.withColumn("at", at).where(F.col("at") <= s.rare)
    held = few.groupBy("shingle").agg(F.sort_array(F.collect_list("node")).alias("of"))
    held = materialize(held.where(F.size("of") < s.rare).select("of"), "rare-shingles")
    uncommon = held.select(F.explode("of").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("uncommon"))
    both = F.flatten(F.transform("of", lambda u, i: F.transform(
        F.slice("of", i + 2, F.lit(s.rare)), lambda v: F.struct(u.alias("u"), v.alias("v")))))
    pairs = held.where(F.size("of") > 1).select(F.explode(both).alias("p")).select("p.u", "p.v").distinct()
    return pairs, uncommon


def _refined(entries: DataFrame, sets: DataFrame, s: Settings) -> tuple[DataFrame | None, DataFrame]:
    """Pairs of large buckets that share a rare shingle, and the entries with the sharper bound there.

    None and the entries as they are if no bucket is large.
    """
    large = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(
        F.col("k") > max(s.hubs[0], s.rare)).select("key"), "large-buckets")
    if large.isEmpty():
        return None, entries
    in_large = entries.join(large, "key", "left_semi")
    pairs, uncommon = _rare_pairs(in_large, sets, s)
    facts = in_large.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "t", "component")])
    u = facts.select(*[F.col(c).alias(f"u_{c}") for c in facts.columns])
    v = facts.select(*[F.col(c).alias(f"v_{c}") for c in facts.columns])
    pairs = pairs.join(u, F.col("u") == F.col("u_node")).join(v, F.col("v") == F.col("v_node")).where(
        (F.col("u_component") != F.col("v_component")) & _may_link(
            F.col("u_n"), F.col("u_t"), F.col("v_n"), F.col("v_t"), s)).select("u", "v")
    sharper = in_large.join(uncommon, "node", "left").withColumn(
        "t", F.least("t", F.col("n") - F.coalesce("uncommon", F.lit(0))))
    small = entries.join(large, "key", "left_anti")
    return pairs, small.unionByName(sharper.select(small.columns))


def _with_components(entries: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return entries.withColumn("component", F.col("node"))
    return entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _links(alive: DataFrame, sets: DataFrame, s: Settings) -> DataFrame | None:
    """Components (node, component) of all classes that verified links connect; None without links."""
    columns = ["key", "node", "n", "t", "component"]
    links, found = None, None

    def verify(pairs: DataFrame) -> None:
        nonlocal links, found
        new = materialize(_verified(materialize(pairs, "candidates"), sets, s), "verified")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = materialize(components(links), "components")

    # First round, in the tables: the member with the fewest shingles of its own is its bucket's hub.
    entries = _table_entries(alive)
    least = F.min(F.struct((F.col("n") - F.col("t")).alias("own"), "node", "n", "t"))
    hubs = materialize(entries.groupBy("key").agg(least.alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1")
                       .select("key", "hub"), "hubs")
    met = entries.join(hubs, "key").where((F.col("node") != F.col("hub.node")) & _may_link(
        F.col("n"), F.col("t"), F.col("hub.n"), F.col("hub.t"), s))
    verify(met.select(F.least("node", "hub.node").alias("u"), F.greatest("node", "hub.node").alias("v")).distinct())

    # What is left goes on in the buckets of the first collection alone: they hold every pair that the
    # tables hold, in groups fewer entries.  Hubs that have met all members of their bucket leave it.
    entries = alive.select("node", "n", "t", F.explode("a").alias("key"))
    rest = materialize(_with_components(entries, found).select(columns), "entries")
    entries = materialize(_still_open(rest, s).select(columns), "entries")
    step = 0
    while not entries.isEmpty():
        more = None
        if step == 0:
            more, entries = _refined(entries, sets, s)
            if more is not None:
                entries = materialize(_still_open(materialize(entries, "entries"), s).select(columns), "entries")
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("n") - F.col("t"), "node"))
        hubs = entries.withColumn("rank", rank).where(F.col("rank") <= s.hubs[min(step, len(s.hubs) - 1)])
        hubs = materialize(hubs.select(columns), "hubs")
        pairs = _candidates(entries, hubs, s)
        verify(pairs if more is None else pairs.unionByName(more).distinct())
        rest = entries.join(hubs.select("key", "node"), ["key", "node"], "left_anti").drop("component")
        rest = materialize(_with_components(rest, found).select(columns), "entries")
        entries = materialize(_still_open(rest, s).select(columns), "entries")
        step += 1
    return found


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    s = settings
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    signatures = materialize(src.mapInArrow(
        _signature_batches(s), "doc_id long, n long, digest binary, hashes array<long>"), "signatures")
    classes = materialize(_classes(signatures), "classes")
    shared = _shared(classes, s)
    sets = _sets(src, classes.join(_small(shared.select("node")), "node", "left_semi"), s)
    found = _links(_alive(shared, sets, s), sets, s)
    names = classes.select("digest", "node")
    if found is None:
        names = names.withColumn("component", F.col("node"))
    else:
        names = names.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = materialize(names.select("digest", "component"), "class-components")
    out = signatures.select("doc_id", "n", "digest").join(names, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays: of each group the one with the smallest id.

    A document is an id with its text: rows that repeat both are one, rows
    that repeat the id with another text are documents of their own (of equal
    ids in a group that with the least hash of id and text stays).  Every
    group keeps one document, whatever ids its rows have.  Rows with a null id
    all stay.
    """
    key, text = F.col("_ll_key"), F.col(f"`{text_col}`")
    doc_id = F.col(f"`{id_col}`").cast("long")
    named = docs.withColumn("_ll_key", F.when(doc_id.isNotNull(), F.xxhash64(doc_id, text)))
    found = near_duplicates(named, settings, "_ll_key", text_col).where("doc_id is not null").select(
        F.col("doc_id").alias("_ll_key"), "component_id").distinct()
    ids = materialize(named.where(key.isNotNull()).groupBy("_ll_key").agg(
        F.first(doc_id).alias("id"), F.count(F.lit(1)).alias("k")), "keys")
    grouped = materialize(found.join(ids, "_ll_key"), "grouped")
    first = grouped.groupBy("component_id").agg(F.min(F.struct("id", "_ll_key"))["_ll_key"].alias("first"))
    gone = grouped.join(first, "component_id").where(key != F.col("first")).select(key.alias("_ll_gone"))
    left = named.join(_small(materialize(gone, "gone")), key == F.col("_ll_gone"), "left_anti")
    again = materialize(ids.where("k > 1").select(key.alias("_ll_again")), "repeated")
    if not again.isEmpty():  # only rows with repeats travel, one a task and key
        repeated = left.join(_small(again), key == F.col("_ll_again"), "left_semi").dropDuplicates(["_ll_key"])
        left = left.join(_small(again), key == F.col("_ll_again"), "left_anti").unionByName(repeated)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
