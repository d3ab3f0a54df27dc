"""The corpus pipeline: documents through five training-data operators, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written and read again as the next stage's
docs.  All but the last return the columns of documents:

1. quality_rules   rows that the quality rules reject go
2. line_dedup      lines found in ten documents or more go from every text
3. near_dedup      one document of each group of near duplicates stays
                   (five-word shingles, similarity 0.8)
4. source_mixing   rows are repeated so that sources come nearer to equal
                   weights; none is dropped, none is used more than 1 1/4
                   times on average over its source
5. best_fit        documents are cut and packed into sequences of at most
                   2048 tokens; one row per piece with its place

Null and empty texts fail the quality rules, so later stages see none unless
line dedup empties a text; each stage takes empty tables.  Rows with a null id
are kept by near dedup.  Rows that repeat id and text are one document there,
rows that repeat an id with another text are documents of their own.  The
stages keep all columns of their input, whatever their names; ``_ll_`` and
``_mx`` begin the internal ones.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import line_dedup, mixing, near_dedup, packing, quality
from ledgerlake.llm.common import materialize, table
from ledgerlake.llm.queries import vocabulary

MIXING = mixing.Settings(entropy=0.95, repeats=1.25)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_common_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIXING)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("near_dedup", dedup_documents),
          ("source_mixing", mix_sources), ("best_fit", pack)]

#: None: SQL can't express near dedup's hashing and packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    stages = [functools.partial(stage, spark) for _, stage in STAGES]
    docs = table(spark, sf_dir, "documents")
    for (name, _), stage in zip(STAGES[:-1], stages):
        docs = materialize(stage(docs, sf_dir), f"stage-{name}")
    return stages[-1](docs, sf_dir)
