"""Merkle dataset manifest (operator 12): concatenated-level strings.

Every row is a leaf, the sha256 of its columns.  The leaves of a source, by
id, are cut into aligned blocks of ``fanout ** levels``.  A block keeps each
of its levels as one string of concatenated hex digests: a parent is the hash
of ``fanout`` digests' width cut from the level below, and the siblings of a
node are what stands to its left and right in its run.  The blocks' roots are
the leaves of the next round, until a source has one root; the sources' roots,
by source, form the top tree in the same way.  A row's path is its own block's
runs followed by those of the blocks above it.

* null columns hash as ``-``; a null source comes first and is a group of its
  own; null ids come first in their source
* empty and very long texts are hashed whole; texts are never shuffled, only
  ids and digests are
* rows that repeat an id are ordered by their leaf digests; equal rows are
  leaves of their own, which of two equal ones stands first can't be seen
* an empty table gives no rows (and no root)
* only the columns that are named are read, so others can have any name
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialize
from .ranking import ranked

HEX = 64  # characters of a digest


@dataclass(frozen=True)
class Settings:
    columns: tuple = ("doc_id", "source", "lang", "n_chars", "text")  # of a leaf, in this order
    id_col: str = "doc_id"
    source_col: str = "source"
    fanout: int = 16
    levels: int = 2  # of a block, which has fanout ** levels leaves


PATH = "array<struct<left:string,right:string>>"


def leaf_of(columns: Sequence[Column]) -> Column:
    """The digest of a row: each column as ``-`` if null, else its UTF-8 length, a colon and its value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts += [F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda at, run: F.sha2(F.concat(run["left"], at, run["right"]), 256))


def proof_of(path: Column) -> Column:
    """The siblings of all levels as one string."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


def _cut(level: Column, start: Column, count: Column) -> Column:
    """``count`` digests of a level from digest ``start`` on (levels as bytes, where that is no search)."""
    return F.substring(level, start * HEX + 1, count * HEX)


def _left(total: Column, nodes: int) -> Column:
    """Nodes of the whole group on the level where each holds ``nodes`` leaves."""
    return F.ceil(total / nodes)


def _parents(level: Column, fanout: int) -> Column:
    """The next level's string: a digest of each run of ``fanout`` digests."""
    def hashed(digests: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.octet_length(digests) / (HEX * fanout)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda run: F.sha2(_cut(digests, run * fanout, F.lit(fanout)), 256)), "")

    return let(level.cast("binary"), hashed)


def _blocks(nodes: DataFrame, s: Settings, name: str) -> DataFrame:
    """A written row per (grp, block): total, members by position, a string per level, root.

    ``nodes`` has grp, pos, total, digest and any carried columns.  A level
    on which the whole group has one node is the group's last.
    """
    carried = [c for c in nodes.columns if c not in ("grp", "pos", "total", "digest")]
    rows = nodes.groupBy("grp", F.floor(F.col("pos") / s.fanout ** s.levels).alias("block")).agg(
        F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("members"))
    rows = rows.withColumn("level0", F.array_join("members.digest", ""))
    for k in range(s.levels):
        more = _left(F.col("total"), s.fanout ** k) > 1
        rows = rows.withColumn(f"level{k + 1}", F.when(more, _parents(F.col(f"level{k}"), s.fanout)).otherwise(F.col(f"level{k}")))
    return materialize(rows.withColumnRenamed(f"level{s.levels}", "root"), name)


def _segments(k: int, node: Column, fanout: int) -> Column:
    """What stands left and right of a node in its run of level ``k``."""
    start = node - node % fanout
    return let(F.col(f"level{k}").cast("binary"), lambda level: F.struct(
        _cut(level, start, node - start).cast("string").alias("left"),
        _cut(level, node + 1, start + fanout - 1 - node).cast("string").alias("right")))


def _runs(at: Column, total: Column, s: Settings) -> Column:
    """The siblings of member ``at`` of a block, a pair of segments for each level that has several nodes."""
    nodes = [F.floor(at / s.fanout ** k).cast("int") for k in range(s.levels)]
    return F.array_compact(F.array(*[F.when(_left(total, s.fanout ** k) > 1, _segments(k, node, s.fanout))
                                     for k, node in enumerate(nodes)])).cast(PATH)


def _grow(nodes: DataFrame, s: Settings, name: str) -> list[DataFrame]:
    """The blocks of all rounds, from the leaves up: the roots of a group's blocks are the next round's nodes."""
    size, rounds = s.fanout ** s.levels, []
    while True:
        rounds.append(_blocks(nodes, s, f"{name}-{len(rounds)}"))
        nodes = rounds[-1].where(F.col("total") > size).select(
            "grp", F.col("block").alias("pos"), _left(F.col("total"), size).alias("total"), F.col("root").alias("digest"))
        if nodes.isEmpty():
            return rounds


def _descend(rounds: list[DataFrame], tops: DataFrame, s: Settings, name: str) -> DataFrame:
    """Every leaf (grp, pos, digest, carried) with its path to the root and the other columns of ``tops``.

    ``tops`` (grp, path, ...) says what stands above a group's last node.
    """
    given = [c for c in tops.columns if c not in ("grp", "path")]
    size, above = s.fanout ** s.levels, None
    for at in reversed(range(len(rounds))):
        blocks = rounds[at]
        up = blocks.where(F.col("total") <= size).select("grp", "block").join(tops, "grp")
        up = up if above is None else up.unionByName(above)
        up = up.withColumnRenamed("path", "above")
        own = blocks.drop("root").join(up, ["grp", "block"]).withColumn("first", F.col("block") * size)
        each = F.transform("members", lambda m: F.struct(m.alias("m"), F.concat(
            _runs(m["pos"] - F.col("first"), F.col("total"), s), F.col("above")).alias("path")))
        members = own.select("grp", F.inline(each), *given).select("grp", "m.*", "path", *given)
        if at:
            above = materialize(members.select("grp", F.col("pos").alias("block"), "path", *given), f"{name}-above-{at}")
    return members


def manifest(docs: DataFrame, settings: Settings = Settings(), **carried: Column) -> DataFrame:
    """One row per row of ``docs``: id, source, pos in its source, leaf, subroot, root, path and the carried columns.

    ``path`` lists the runs from the leaf to the root as (left, right): the
    digests before and after the node; ``fold(leaf, path)`` gives the root.
    ``carried`` are columns computed where the texts are read; they must not
    be texts themselves, as they are shuffled.
    """
    s = settings
    source = F.col(f"`{s.source_col}`").cast("string")
    # A null source sorts before all others, an empty one after it; texts sort by their UTF-8 bytes.
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("grp"), F.col(f"`{s.id_col}`").alias("id"),
        leaf_of([F.col(f"`{c}`") for c in s.columns]).alias("digest"),
        *[column.alias(f"with_{name}") for name, column in carried.items()])
    rounds = _grow(ranked(materialize(leaves, "leaves"), "grp", ["id", "digest"], "leaves-ranked"), s, "blocks")

    size = s.fanout ** s.levels
    last = [r.where(F.col("total") <= size).select("grp", F.col("root").alias("digest")) for r in rounds]
    subroots = last[0]
    for more in last[1:]:
        subroots = subroots.unionByName(more)
    subroots = materialize(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), "subroots")
    top = _grow(ranked(subroots, "grp", ["of"], "subroots-ranked"), s, "top")
    root = top[-1].where(F.col("total") <= size).select("grp", "root", F.array().cast(PATH).alias("path"))
    sources = _descend(top, root, s, "top").select(
        F.col("of").alias("grp"), "path", F.col("digest").alias("subroot"), "root")

    rows = _descend(rounds, materialize(sources, "source-paths"), s, "paths")
    return rows.select(
        F.col("id").alias(s.id_col), F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias(s.source_col), "pos",
        F.col("digest").alias("leaf"), "subroot", "root", "path", *[F.col(f"with_{c}").alias(c) for c in carried])


def op12_merkle_manifest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The manifest, its proofs, and the roots that follow after tampering.

    Where 5 divides the crc32 of the decimal id, the text's A-Z are
    lower-cased; null ids and null texts are not tampered with.  Every row's
    root is folded from its leaf (the tampered one, else its own) and its
    siblings, so ``verified`` is a proof of the untampered rows as well.
    """
    s = settings
    doc_id = F.col(f"`{s.id_col}`")
    tampered = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    altered = leaf_of([ascii_lower(F.col(f"`{c}`")) if c == "text" else F.col(f"`{c}`") for c in s.columns])
    rows = manifest(docs, s, altered=F.when(tampered, altered))
    rows = rows.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return rows.select(
        doc_id.alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof_of(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_sql(depth: int = 9) -> str:
    """DuckDB SQL of op12 for sources (and numbers of sources) of up to 16 ** depth leaves: a table per level.

    A level on which a group has one node is passed on unchanged.
    """
    part = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')".format
    columns = ("doc_id", "source", "lang", "n_chars")
    leaf = "sha256(" + " || ".join(part(c) for c in columns) + " || {})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str, start: str) -> str:
        """Nodes {name}0.. and the runs above them; the group's only node is the last table's."""
        out = [f"{name}0 AS ({start})"]
        for k in range(depth):
            out.append(f"""
{name}_runs{k} AS (SELECT grp, pos // 16 AS run, list(digest ORDER BY pos) AS nodes, any_value(total) AS total
  FROM {name}{k} GROUP BY grp, pos // 16),
{name}{k + 1} AS (SELECT grp, run AS pos, (total + 15) // 16 AS total,
  CASE WHEN total > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS digest FROM {name}_runs{k})""")
        return ",".join(out)

    def up(name: str, source: str, grp: str) -> str:
        """Adds the columns sib (siblings so far) and alt (folded so far) of each level of a tree."""
        out, before = [], source
        for k in range(depth):
            at, run = f"(b.at // {16 ** k})", f"(b.at // {16 ** (k + 1)})"
            out.append(f"""
{name}_up{k} AS (SELECT b.* EXCLUDE (sib, alt), b.sib || CASE WHEN r.total > 1
    THEN array_to_string(r.nodes[:{at} % 16], '') || array_to_string(r.nodes[{at} % 16 + 2:], '') ELSE '' END AS sib,
  CASE WHEN r.total > 1 THEN sha256(array_to_string(r.nodes[:{at} % 16], '') || b.alt ||
    array_to_string(r.nodes[{at} % 16 + 2:], '')) ELSE b.alt END AS alt
  FROM {before} b JOIN {name}_runs{k} r ON r.grp = {grp} AND r.run = {run})""")
            before = f"{name}_up{k}"
        return ",".join(out)

    # crc32, bit by bit, of the decimal id.
    bits = "flatten([[(ascii(c) >> 0) & 1, (ascii(c) >> 1) & 1, (ascii(c) >> 2) & 1, (ascii(c) >> 3) & 1, " \
           "(ascii(c) >> 4) & 1, (ascii(c) >> 5) & 1, (ascii(c) >> 6) & 1, (ascii(c) >> 7) & 1] " \
           "FOR c IN string_split(doc_id::varchar, '')])"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, [x::bigint FOR x IN {bits}]), " \
          "lambda a, b: xor(a >> 1, CASE WHEN xor(a & 1, b) = 1 THEN 3988292384::bigint ELSE 0::bigint END)), 4294967295::bigint)"
    return f"""
WITH rows_in AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp,
    {leaf.format(part('text'))} AS digest,
    CASE WHEN {crc} % 5 = 0 THEN {leaf.format(part(lower))} END AS altered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
    count(*) OVER (PARTITION BY grp) AS total FROM rows_in),
{tree('n', 'SELECT grp, pos, total, digest FROM placed')},
sources AS (SELECT grp, digest, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS total FROM n{depth}),
{tree('t', "SELECT '' AS grp, pos, total, digest FROM sources")},
start AS (SELECT p.doc_id, p.grp, p.digest AS leaf, p.altered, p.pos AS at, '' AS sib, coalesce(p.altered, p.digest) AS alt
  FROM placed p),
{up('n', 'start', 'b.grp')},
of_sources AS (SELECT u.doc_id, u.leaf, u.altered, s.digest AS subroot, s.pos AS at, u.sib, u.alt
  FROM n_up{depth - 1} u JOIN sources s ON s.grp = u.grp),
{up('t', 'of_sources', "''")},
ended AS (SELECT u.*, (SELECT any_value(digest) FROM t{depth}) AS root FROM t_up{depth - 1} u)
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256,
  CASE WHEN altered IS NOT NULL THEN alt ELSE root END AS folded_root,
  CASE WHEN altered IS NOT NULL THEN alt ELSE root END = root AS verified FROM ended"""
