"""A corpus pipeline of five stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from greensward.plans.scratch import Scratch

#: Lines on over 5 % of a source's documents, and on 20 at least, are boilerplate.
LINE_RATIO, LINE_MIN = 0.05, 20
#: Shingle words and least similarity in percent of near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80

#: The CRF of the first stage has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; repeated rows fare alike, an empty table stays empty."""
    return quality_rules.quality_rules(docs).where("quality.kept").select(docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to a source's documents go; ``n_chars`` follows the text.

    Every row stays, even if no line does. A null source is a source of its
    own, a null text stays null, repeated ids are judged by row, and lines that
    lie exactly at the ratio stay.
    """
    clean = line_dedup.drop_site_lines(docs, "text", docs["source"], ratio=LINE_RATIO, min_pages=LINE_MIN)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows joined up by links of their texts, one stays: the smallest by doc_id, source, hash of the text and then the other columns.

    Rows are told apart by numbers of their own, so it makes no difference
    whether they share an id, a text or both, nor from which source they come;
    null ids are the largest. Texts without a word, null or not, have no links
    and stay. An empty table stays empty.
    """
    scratch = Scratch(spark, "pipeline")
    row = "_row_number"
    rows = scratch.put(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = scratch.put(ngram_join.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text"), words=SHINGLE_WORDS, percent=SIMILAR_PERCENT), "found")
    groups = scratch.put(found.where("doc_id <> component_id").select("component_id").distinct(), "groups")
    members = found.join(scratch.small(groups), "component_id", "left_semi").select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
    first = [c for c in ("doc_id", "source") if c in docs.columns]
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    order = F.struct(F.col("doc_id").isNull(), *first, F.xxhash64("text"), *rest, row)
    members = scratch.put(members.join(rows.select(row, order.alias("_order")), row), "members")
    kept = members.groupBy("_group").agg(F.min("_order")[row].alias("_kept"))
    gone = scratch.put(members.join(kept, "_group").where(F.col(row) != F.col("_kept")).select(row), "gone")
    scratch.keep(rows, gone)
    return rows.join(scratch.small(gone), row, "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as its source's part of the mix takes it, under its own id.

    Rows without a word go. An id in two sources is taken by each on its own; a
    null source is a source; an empty table stays empty.
    """
    return mixing.repeat_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens; each repeated row is packed again, a null text is an end token."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_common_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
