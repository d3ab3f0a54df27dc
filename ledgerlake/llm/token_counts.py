"""Token counts with a digest cache (operator 3).

Stored counts are keyed by two digests: SHA-256 of the normalised content,
and SHA-256 of the tokenizer's file and library version.  A run joins its
documents to the cache, encodes each distinct missing content once, appends
the new counts to the cache and joins every document to its count.

Null and empty texts count 0 tokens; very long texts are counted whole.
Repeated rows and null ids keep one result row each; an empty table gives
none.  A content that the cache holds more than once, as two runs at a time may
leave it, counts once.  Only the id and the text are read, so other columns can
have any name.
Texts travel once, and only the first copy of a content within a map task is
sent (partial aggregation), so a hot content doesn't make a hot task; the
final join carries digests only and its hot keys are split by AQE.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialize, pick

CACHE_SCHEMA = "content string, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0tokenizers " + tokenizers.__version__.encode()).hexdigest()


def collapse_white(text: Column) -> Column:
    """ASCII white-space runs as one space, ends trimmed.

    Right for tokenizers that normalise ``\\s+`` to a space and drop it (word
    level); byte-level tokenizers need ``normalise=None``.
    """
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))


def _read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache's counts of one tokenizer version, one row per content.

    Two runs may have appended the same content; ``max`` makes keys unique.
    """
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
            .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))


def _encode_misses(path: str):
    def run(batches):
        import pyarrow as pa

        from .chunks import encoder

        count = encoder(path).count
        for batch in batches:
            texts = batch.column("text")
            counts = [count(texts[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())],
                                             names=["content", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048,
                 normalise=collapse_white, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a ``tokenizers`` file present on every
    executor; ``cache`` the folder of stored counts in shared storage (a new
    one if None), to which this call appends.  ``normalise`` must not change
    the count.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    cache = cache or fresh_path(spark, "token-cache")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)

    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    norm = normalise(F.col("text")) if normalise else F.col("text")
    keyed = rows.withColumn("norm", norm).withColumn("content", F.sha2("norm", 256))

    misses = (keyed.select("content", F.col("norm").alias("text"))
              .groupBy("content").agg(F.first("text").alias("text"))
              .join(_read_cache(spark, cache, version), "content", "left_anti"))
    new = misses.mapInArrow(_encode_misses(tokenizer), "content string, n_tokens long")
    new.select("content", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)

    # Written again, one row per content (two runs may have stored the same), so that the join's sides are
    # plain exchanges and its hot contents (many copies) can be split.
    counts = materialize(_read_cache(spark, cache, version), "token-counts")
    out = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content").join(
        counts, "content", "left")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
