"""Line dedup across documents (operator 10).

Normalised lines are exploded and hashed (128 bits), each hash's distinct
documents are counted with partial aggregation, and hashes over the
threshold form a written table.  The lines that match it become drop
positions per document, and each document is reassembled from the positions
that stay.  The hot line's join is between two plain exchanges, so AQE
splits it.

A row is a document: rows that repeat a doc_id count as documents of their
own.  Null and empty texts are one empty line; keys shorter than
``min_chars`` are never dropped.  Very long texts are split whole; an empty
table gives no rows; other columns can have any name.  Rows are identified by doc_id and a hash
of their text, so repeated ids (null ones too) keep their own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CHARS, ascii_lower, materialize


def line_keys(text: Column) -> Column:
    """The keys of all lines: ends stripped of white space, A-Z lower-cased."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(WHITE_CHARS)))


def _hashes(keys: Column, min_chars: int) -> Column:
    """A 128-bit hash per line; null for keys that are too short."""
    return F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k))))


def with_kept_lines(docs: DataFrame, out: str = "_ll_kept", min_docs: int = 10, min_chars: int = 1,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct column ``out``: text, n_lines, n_dropped after line dedup."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("_ll_id"), text.alias("_ll_text"))
    hashed = src.select("_ll_id", F.xxhash64("_ll_text").alias("_ll_th"),
                        _hashes(line_keys(F.col("_ll_text")), min_chars).alias("_ll_hs"))

    per_doc = hashed.select(F.explode(F.array_distinct("_ll_hs")).alias("_ll_h")).where("_ll_h is not null")
    frequent = materialize(per_doc.groupBy("_ll_h").agg(F.count(F.lit(1)).alias("_ll_n"))
                           .where(F.col("_ll_n") >= min_docs).select("_ll_h"), "frequent-lines")

    lines = hashed.select("_ll_id", "_ll_th", F.posexplode("_ll_hs").alias("_ll_pos", "_ll_h")).where(
        "_ll_h is not null")
    hits = lines.join(frequent, "_ll_h", "left_semi").select("_ll_id", "_ll_th", "_ll_pos")
    drops = hits.groupBy(F.col("_ll_id").alias("_ll_did"), F.col("_ll_th").alias("_ll_dth")).agg(
        F.collect_set("_ll_pos").alias("_ll_drop"))

    joined = docs.withColumn("_ll_text", text).withColumn("_ll_th", F.xxhash64("_ll_text")).join(
        drops, F.col(f"`{id_col}`").eqNullSafe(F.col("_ll_did")) & (F.col("_ll_th") == F.col("_ll_dth")), "left")
    joined = joined.withColumn("_ll_lines", F.split("_ll_text", "\n", -1))
    n_lines, n_dropped = F.size("_ll_lines"), F.coalesce(F.size("_ll_drop"), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("_ll_drop"))
    kept = F.when(F.col("_ll_drop").isNull(), F.col("_ll_text")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(F.col("_ll_lines"), p)), "\n"))
    result = F.struct(kept.alias("text"), n_lines.cast("long").alias("n_lines"),
                      F.when(F.col("_ll_drop").isNull(), F.lit(0)).otherwise(n_dropped).cast("long")
                      .alias("n_dropped"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(out))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with its common lines dropped from the text (n_chars follows if present)."""
    done = with_kept_lines(docs, "_ll_kept", min_docs, min_chars, id_col, text_col)
    changed = F.col("_ll_kept.n_dropped") > 0
    columns = []
    for c in docs.columns:
        col = F.col(f"`{c}`")
        if c == text_col:
            col = F.when(changed, F.col("_ll_kept.text")).otherwise(col)
        elif c == n_chars_col:
            col = F.when(changed, F.length("_ll_kept.text")).otherwise(col).cast(docs.schema[c].dataType)
        columns.append(col.alias(c))
    return done.select(*columns)


def op10_line_dedup(docs: DataFrame) -> DataFrame:
    """The contract's digest of ``with_kept_lines`` over whole documents."""
    done = with_kept_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", F.col("_ll_kept.n_lines").alias("n_lines"),
                       F.col("_ll_kept.n_dropped").alias("n_dropped"),
                       F.sha2("_ll_kept.text", 256).alias("kept_sha256"))


OP10_SQL = r"""
with docs as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls
              from documents),
lines as (select rid, unnest(ls) as line, unnest(range(len(ls))) as pos from docs),
keyed as (select rid, pos, line,
                 translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
frequent as (select k from keyed where length(k) >= 1 group by k having count(distinct rid) >= 10),
marked as (select rid, pos, line, f.k is not null as gone from keyed left join frequent f using (k)),
joined as (select rid, count(*) filter (where gone) as n_dropped,
                  coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as kept
           from marked group by rid)
select doc_id, len(ls)::bigint as n_lines, n_dropped::bigint as n_dropped, sha256(kept) as kept_sha256
from docs join joined using (rid)
"""
