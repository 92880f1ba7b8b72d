"""Mixing sources to target weights, by DataFrame operations alone.

Words are counted per document, summed per source and turned into targets; a source's repetition
rate is its target over its size, and each document is emitted floor(rate) times plus one copy that
a hash of its id and the seed draws with the probability of the fraction.

A document takes the copy if its draw, a whole number below 2**40, is at most its source's bound. Were the
bound the fraction itself, a few long documents could carry a source far from its target. So the bound is
set where the words of the documents up to it come nearest to what the fraction asks for: draws are still
those of the hash, and a source misses its target by half a document (or group of equal draws) at most. It
is found ten bits at a time: words are summed by source and the draw's next bits, before the shuffle, and
only the bin in which the sum passes the mark is looked at more closely. No step holds more than 1024 rows
of a source, however large it is.

Targets share the total by weight, but a source stops at ``most`` times its size and the excess is
shared out again by weight until none is above. With a level L, a source's target is the smaller of
its cap and weight * L; L rises as sources reach their caps, at most once per source, and each step
is one aggregate over the sources that returns two numbers.

Null text has size 0, null source is a source of its own and the last. Documents of size 0 count
for nothing and stay as often as their source's rate says; a source of size 0 has target 0 and
rate 0. Repeated rows are documents of their own; they share the draw of their ``doc_id``, and rows
without an id that of their text. Empty tables give an empty result. Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, column, documents, fresh, stored

MOST = 3
DRAW_BITS, BITS_A_STEP = 40, 10


def size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """A whole number below 2**40 from the id and the seed: the same in every run and for every order of rows."""
    text = F.sha2(F.coalesce(column("text"), F.lit("")).cast("binary"), 256)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(column("doc_id").cast("string"), text))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 10), 16, 10).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0, 1, 2 ... by code point, null last.

    Ranges of sources are numbered on their own; only the number of sources in each range is summed
    across ranges. Sources are in order within a range, and ranges are in order.
    """
    null_last = [F.col("source").isNull(), F.col("source")]
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(sources.repartitionByRange(n, *null_last).withColumn("range", F.spark_partition_id()), "sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*null_last)) - 1
    return ranges.withColumn("inside", inside).join(starts, "range").withColumn("place", F.col("start") + F.col("inside")).drop("range", "inside", "start")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: weights 1, 2, 3, repeating."""
    weighted = stored(numbered(sources).withColumn("weight", F.col("place") % 3 + 1), "weights")
    cap, weight = F.col("source_size") * most, F.col("weight")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    taken, weights = 0, None
    while True:
        # A source is full once weight * (total - taken) / weights reaches its cap; compared in whole numbers.
        full = F.lit(False) if weights is None else weight * (total - taken) >= cap.cast("decimal(20,0)") * F.lit(weights).cast("decimal(18,0)")
        caps, left = weighted.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, weight))).first()
        if weights is not None and (caps or 0) == taken or not left:
            weights, taken = left, caps or 0
            break
        taken, weights = caps or 0, left
    level = F.least(cap.cast("double"), weight * F.lit(total - taken) / F.lit(weights)) if weights else cap.cast("double")
    return weighted.select("source", "source_size", level.alias("target"))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(column("doc_id").alias("doc_id"), column("source").alias("source"), size().alias("size"), draw(seed).alias("draw"))


def bounds(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target, whole, upto``: copies of all documents, and the largest draw that takes one more.

    ``rows``: ``source, size, draw``, stored.
    """
    shares = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shares = shares.withColumn("whole", F.floor(rate)).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    # ``bin``: leading bits of the draw at which the words pass ``need``; ``before``: words of smaller draws.
    long = F.lit(0).cast("long")
    marks = stored(shares.withColumns({"bin": F.when(F.col("need") > 0, long), "before": long, "words": long}), "marks")
    for shift in range(DRAW_BITS - BITS_A_STEP, -1, -BITS_A_STEP):
        mark = marks.where("bin IS NOT NULL").select(F.col("source").alias("of"), "bin", F.col("before").alias("base"), "need")
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("draw", shift + BITS_A_STEP) == F.col("bin"))
        bins = rows.join(mark, inside).groupBy("of", "base", "need", F.shiftright("draw", shift).alias("at")).agg(F.sum("size").alias("here"))
        upto = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        passed = bins.withColumn("sum", F.col("base") + F.sum("here").over(upto)).where("sum > need")
        first = passed.groupBy("of").agg(F.min(F.struct("at", (F.col("sum") - F.col("here")).alias("before"), "here")).alias("first"))
        kept = marks.drop("bin", "before", "words").join(first, F.col("source").eqNullSafe(F.col("of")), "left")
        marks = stored(kept.select(*kept.columns[:5], F.col("first.at").alias("bin"), F.col("first.before").alias("before"), F.col("first.here").alias("words")), "marks")
    # The draw that passes the mark counts if that comes nearer than to stop before it.
    nearer = 2 * F.col("before") + F.col("words") <= 2 * F.col("need")
    bound = F.when(F.col("need") <= 0, -1).when(F.col("bin").isNull(), 1 << DRAW_BITS).otherwise(F.col("bin") - F.when(nearer, 0).otherwise(1))
    return marks.select("source", "source_size", "target", "whole", bound.cast("long").alias("upto"))


def plan(docs: DataFrame, seed: int = 0, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` per row: how often the mix takes each document.

    Sizes are summed before the shuffle, so a source with a third of all rows is one row per task and bin.
    """
    rows = stored(measured(docs, seed), "sizes")
    mixed = rows.join(bounds(rows, most).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    copies = (F.col("whole") + (F.col("draw") <= F.col("upto")).cast("long")).alias("copies")
    return mixed.select("doc_id", "source", "size", "source_size", "target", copies)


def mix(docs: DataFrame, seed: int = 0, most: int = MOST) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the plan takes it.

    Copies follow from a row's draw and its source alone, so rows are joined with the few sources
    rather than with the plan: texts are not shuffled where sources fit the broadcast threshold.
    """
    of, whole, upto, drawn, copy = fresh(docs, "of", "whole", "upto", "draw", "copy")
    sources = bounds(stored(measured(docs, seed), "sizes"), most)
    sources = sources.select(F.col("source").alias(of), F.col("whole").alias(whole), F.col("upto").alias(upto))
    rows = docs.withColumn(drawn, draw(seed)).join(sources, column("source").eqNullSafe(F.col(of)))
    times = (F.col(whole) + (F.col(drawn) <= F.col(upto)).cast("long")).cast("int")
    repeated = rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*(column(c) for c in docs.columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = plan(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         CAST(coalesce(sum(3 * source_size) OVER before, 0) AS BIGINT) AS taken,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weights
  FROM s
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT total, taken, weights FROM o WHERE weight * (total - taken) < 3 * source_size * weights
  ORDER BY taken LIMIT 1
), t AS (
  SELECT s.source, s.source_size, coalesce(least(CAST(3 * s.source_size AS DOUBLE),
         CAST(weight * (level.total - level.taken) AS DOUBLE) / CAST(level.weights AS DOUBLE)), 0) AS target
  FROM s LEFT JOIN level ON true
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), e AS (
  SELECT *, CAST('0x' || substr(sha256('0:' || coalesce(CAST(doc_id AS VARCHAR), sha256(coalesce(text, '')))), 1, 10) AS BIGINT) AS draw
  FROM d
), g AS (
  SELECT source, draw, sum(size) AS here FROM e GROUP BY source, draw
), c AS (
  SELECT *, coalesce(sum(here) OVER (PARTITION BY source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g
)
SELECT e.doc_id, e.size, r.source_size, r.target,
       CAST(e.size * (r.whole + CASE WHEN CAST(2 * c.before + c.here AS DOUBLE) <= 2 * (r.target - r.whole * r.source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source JOIN c ON c.source IS NOT DISTINCT FROM e.source AND c.draw = e.draw
"""
