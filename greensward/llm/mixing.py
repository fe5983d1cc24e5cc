"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward.llm.words import WORD, n_words
from greensward.plans.scratch import Scratch

#: Bits of a document's hash, and bits that one histogram resolves.
HASH_BITS, LEVEL_BITS = 60, 12


def document_hash(doc_id: Column) -> Column:
    """The first 60 bits of md5 over the id's decimal digits; null ids hash as empty text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """``(source, source_size, target)`` with one row for each source.

    Sources in code-point order, null last, take ``weights`` in turn. The sum
    of all sizes is shared by weight; a source stops at ``max_repeats`` times
    its own size and what it leaves is shared again by weight. The fixed point
    is ``least(cap, level * weight)``: in the order of cap/weight the level is
    what remains for a source and all behind it, per unit of their weight, at
    the first source whose cap isn't below that. Only the table of sources, one
    row each, is ordered, in one task: sources are taken to be fewer than some
    millions (sites or collections, not documents).
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = lambda c: F.sum(c).over(every) - F.coalesce(F.sum(c).over(before), F.lit(0.0))
    s = s.withColumn("size_d", F.col("source_size").cast("double"))
    room = F.sum("size_d").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", room / left("weight"))
    level = F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), "level")))
    s = s.withColumn("level", level.over(every)["level"])
    target = F.round(F.least("cap", F.col("level") * F.col("weight")), 6)
    return s.select("source", "source_size", target.alias("target"))


def _thresholds(docs: DataFrame, size: Column | None, doc_id: str, source: str, weights: tuple[float, ...], max_repeats: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and hashes, and for each source how often all of it is taken and up to which hash once more."""
    size = n_words(docs["text"]) if size is None else size
    slim = scratch.put(docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"), document_hash(docs[doc_id]).alias("h")), "sizes")
    s = source_targets(slim, weights, max_repeats)
    ratio = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(ratio + 1e-12), F.lit(max_repeats))).otherwise(0)
    s = s.withColumn("whole", whole.cast("long")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    state = s.withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    for bits in range(LEVEL_BITS, HASH_BITS + 1, LEVEL_BITS):
        state = scratch.small(scratch.put(state, f"level{bits}"))
        state = _refine(slim, state, bits)
    return slim, scratch.small(scratch.put(state, "thresholds"))


def _repeats(h: Column, state: str, max_repeats: int) -> Column:
    """How often a document is taken, from its hash and the columns of its source's threshold, which start with ``state``."""
    c = lambda n: F.col(state + n)
    more = (h < c("prefix")) | ((h == c("prefix")) & c("edge"))
    return F.least(c("whole") + F.coalesce(more, F.lit(False)).cast("long"), F.lit(max_repeats))


def mix(docs: DataFrame, size: Column | None = None, *, doc_id: str = "doc_id", source: str = "source", weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """How many words of each document a weighted mix takes.

    Returns ``doc_id, size, source_size, target, taken``, one row per row of
    ``docs``. A source takes all its documents ``floor(target / source_size)``
    times and, for the rest of the target, once more those whose hash lies
    below a threshold. The threshold is found from sums of sizes by source and
    hash bucket: each level refines only the bucket in which the budget is
    crossed, until one hash value remains, which is taken if that brings the
    sum nearer to the target. Nothing is sorted but a source's 4,096 buckets;
    thresholds nest, so a smaller budget takes a subset.

    Null texts have size 0; null sources are a source of their own; documents
    of a source that share an id share a fate; empty tables give empty results.
    Columns of ``docs`` other than those named are ignored, whatever their names.
    """
    slim, state = _thresholds(docs, size, doc_id, source, weights, max_repeats, Scratch(docs.sparkSession, "mixing"))
    out = slim.alias("d").join(state.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * _repeats(F.col("h"), "s.", max_repeats)).alias("taken"))


def repeat_rows(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """Each row of ``docs`` with a word as many times as ``mix`` takes it, with all its columns.

    Rows meet the threshold of their own source, so an id that occurs in two
    sources is taken by each as that source's share asks. Rows without a word
    aren't taken. Columns of any name stay as they are.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    _, state = _thresholds(docs, n_words(docs[text]), doc_id, source, weights, max_repeats, scratch)
    state = state.select(*[F.col(c).alias(f"_mix_{c}") for c in ("source", "whole", "prefix", "edge")])
    rows = docs.join(scratch.small(scratch.put(state, "taken")), docs[source].eqNullSafe(F.col("_mix_source"))).where(docs[text].rlike(WORD))
    times = _repeats(document_hash(docs[doc_id]), "_mix_", max_repeats)
    rows = rows.withColumn("_mix_times", times.cast("int")).where("_mix_times > 0")
    return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).select(docs.columns)


def _refine(slim: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """Narrow each source's boundary from ``bits - LEVEL_BITS`` to ``bits`` leading bits."""
    d, s = slim.alias("d"), state.alias("s")
    known = F.shiftright("h", HASH_BITS - bits + LEVEL_BITS) == F.col("s.prefix")
    rows = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source")) & known).where("d.size > 0")
    keep = ["source", "source_size", "target", "whole", "budget", "below"]
    cells = rows.groupBy(*[F.col(f"s.{c}") for c in keep], F.shiftright("h", HASH_BITS - bits).alias("cell")).agg(F.sum("d.size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("cell"))
    cells = cells.withColumn("after", F.col("below") + upto)
    crossed = cells.where("after > budget").groupBy(*keep[:-1]).agg(F.min(F.struct("cell", "after", "n")).alias("c"))
    below = F.col("c.after") - F.col("c.n")
    new = crossed.select(*keep[:-1], F.col("c.cell").alias("prefix"), below.alias("below"), (below + F.col("c.after") < 2 * F.col("budget")).alias("edge"))
    # sources without words, or whose budget isn't crossed, keep a threshold that takes nothing more
    old = state.select(*keep[:-1], F.lit(-1).cast("long").alias("prefix"), "below", F.lit(False).alias("edge"))
    left = old.alias("o").join(new.select(F.col("source").alias("k")), F.col("o.source").eqNullSafe(F.col("k")), "left_anti")
    return new.unionByName(left)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _water_fill_sql() -> str:
    return """
d AS (SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
      FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
        (3 * source_size)::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER w, 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS lv
       FROM s1 WINDOW w AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT min({'r': cap / weight, 'l': lv}) FILTER (cap / weight >= lv) AS m FROM s2),
s4 AS (SELECT source, source_size, round(least(cap, m.l * weight), 6) AS target FROM s1, s3),
s AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size + 1e-12), 3) ELSE 0 END::BIGINT AS whole FROM s4),
c AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after,
        sum(size) OVER (PARTITION BY d.source, h) AS n
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)"""


TAKEN_SQL = "size * least(whole + CASE WHEN after <= budget OR (after - n <= budget AND 2 * after - n < 2 * budget) THEN 1 ELSE 0 END, 3)"
OP7_SQL = f"WITH {_water_fill_sql()} SELECT doc_id, size, source_size, target, ({TAKEN_SQL})::BIGINT AS taken FROM c"
