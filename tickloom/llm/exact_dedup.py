"""Exact deduplication as a stateful stream whose state is kept on disk and never expires.

Rows pass through a streaming aggregation keyed by the digest of the text. The keyed state (RocksDB,
checkpointed in a folder all executors share) holds for every digest the stable identifier of the
row that stays, the locator of its content and the size of its group. No watermark is set, so a
copy is found however late it arrives. Keys arrive in several micro-batches, and a later run that is
given the same folders reads new rows alone. The state is read back as a table.

A digest seen before is a hit, not yet a copy: the full bytes of all rows behind a hit are compared,
those of earlier runs read from the files that their locators name, as the smallest and the largest text of a digest, an aggregate that combines before the shuffle.
Were two texts to share a digest, the rows of that digest would be grouped by their bytes.

Only DataFrame operations run on executors. Null text counts as empty; of equal texts the largest
``doc_id`` stays, and a null ``doc_id`` stays only if the group has no other. Repeated rows (equal
id and text) count for the group's size and each get a row, and one of them stays. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read; ``dedup`` returns all columns of the
rows that stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import column, documents, scratch, stored
from tickloom.session import child_names, path_bytes, path_exists, sibling

ARRIVAL = "doc_id long, digest string, locator string"
#: Rows of one digest that one task compares.
PART = 64
#: Micro-batches of a run, so that later rows meet the state of earlier ones at any size; and the most bytes of keys in one.
BATCHES, MOST_BYTES = 3, 64 << 30
#: State on disk, with a small write buffer a partition: its log is allocated ahead at the buffer's size.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # A store is closed when its task ends: a worker holds open only the partitions it is at.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    # One cache for all partitions a worker opens in turn; one of each would stay behind when it is closed.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def straight(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is a row of a file of its own, its ``text`` the file's: a scan, projected and filtered alone."""
    plan = docs._jdf.queryExecution().analyzed()
    texts = _column_ids(plan)
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation" or not texts or texts != _column_ids(plan):
        return False
    roots = plan.relation().location().rootPaths()
    return "_metadata" not in map(str.lower, docs.columns) and roots.toSet().size() == roots.size()


def _column_ids(plan, name: str = "text") -> set[int]:
    """What the planner knows a column by: it stays the same until an expression or another name replaces the column."""
    columns = [plan.output().apply(i) for i in range(plan.output().size())]
    return {c.exprId().id() for c in columns if c.name().lower() == name}


def located(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` under other names with ``locator``, the file and row that a row lies in.

    Rows that may share a row of a file (repeated by ``explode`` or a join), whose text is computed, or that lie in
    no file, are written to the shared folder first. So are tables with a column that hides where a row lies.
    """
    rows = docs.toDF(*names)
    try:
        return (rows if straight(docs) else stored(rows, "located")).withColumn("locator", locator())
    except AnalysisException:  # files that do not number their rows
        return stored(rows, "located").withColumn("locator", locator())


def keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``doc_id, text`` (null as empty), ``digest, locator`` of every row."""
    rows = docs.select(column("doc_id"), column("text"))
    return _keyed(located(rows, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long")), digest)


def _keyed(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", text.alias("text"), digest(text).alias("digest"), "locator")


def locator() -> Column:
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))


def by_locator(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``locator``) with the ``text`` that lies there: only the files that are named are read.

    The files must still be there; reading fails if one is not, rather than take a digest's word for it.
    """
    spark = rows.sparkSession
    java = spark.sparkContext._jvm
    files = rows.select(F.substring_index("locator", "#", 1).alias("file")).distinct().toLocalIterator()
    paths = [java.org.apache.hadoop.fs.Path(java.java.net.URI(r.file)).toString() for r in files]
    if not paths:
        return rows.withColumn("text", F.lit("")).limit(0)
    own = spark.read.schema("text string").parquet(*paths)
    return rows.join(own.select(locator().alias("locator"), F.coalesce("text", F.lit("")).alias("text")), "locator")


def run_stream(spark: SparkSession, arrivals: str, state: str, bytes_a_batch: int) -> None:
    """Take all rows that have arrived into the keyed state, in batches of bounded size.

    A session of its own carries the state store's settings, so the caller's are left alone.
    """
    own = sibling(spark, STATE_CONF)
    rows = own.readStream.schema(ARRIVAL).option("maxBytesPerTrigger", bytes_a_batch).parquet(f"{arrivals}/*")
    kept = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("stays"), F.count("*").alias("group_size"))
    query = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, keep_id, locator, group_size``: the keyed state after its last batch."""
    own = sibling(spark, STATE_CONF)
    if not path_exists(spark, f"{state}/state/0"):
        return spark.createDataFrame([], "digest string, keep_id long, locator string, group_size long")
    rows = own.read.format("statestore").load(state)
    flat = rows.select("key.*", "value.*").toDF("digest", "stays", "group_size")
    return flat.select("digest", F.col("stays.doc_id").alias("keep_id"), F.col("stays.locator").alias("locator"), "group_size")


def groups(
    docs: DataFrame,
    arrivals: str | None = None,
    state: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    batches: int = BATCHES,
) -> DataFrame:
    """``doc_id, digest, locator, keep_id, group_size, kept`` per row of ``docs``.

    ``arrivals``: folder that new keys are appended to; ``state``: the stream's checkpoint. Both are
    fresh folders unless given; give both again to go on with more rows. The bytes of earlier rows are
    then read where their locators say, so their files must still be there.
    """
    return _groups(keyed(docs, digest), arrivals, state, batches)


def _groups(rows: DataFrame, arrivals: str | None = None, state: str | None = None, batches: int = BATCHES) -> DataFrame:
    spark = rows.sparkSession
    arrivals, state = arrivals or scratch(spark, "arrivals"), state or scratch(spark, "dedup-state")
    lot = f"{arrivals}/{uuid.uuid4().hex}"
    rows.select("doc_id", "digest", "locator").write.parquet(lot)
    run_stream(spark, arrivals, state, min(MOST_BYTES, path_bytes(spark, lot) // batches + 1))
    seen = stored(read_state(spark, state).withColumnRenamed("locator", "keep_locator"), "state")
    own = spark.read.schema(ARRIVAL).parquet(lot)
    out = own.join(seen, "digest")
    # Full bytes of all rows behind a hit. Rows are found by locator, and a large group is combined
    # in parts first, so no task holds the rows of one digest.
    part = F.pmod(F.xxhash64("locator"), F.ceil(F.col("group_size") / F.lit(PART)).cast("long")).alias("part")
    hits = out.where("group_size > 1").select("locator", "digest", part)
    whole = rows.select("doc_id", "digest", "locator", "text")
    behind = rows.select("locator", "text").join(hits, "locator")
    earlier = [x for x in child_names(spark, arrivals) if not x.startswith(("_", ".")) and x != lot.rpartition("/")[2]]
    if earlier:
        before = spark.read.schema(ARRIVAL).parquet(*(f"{arrivals}/{x}" for x in earlier))
        before = before.join(seen.where("group_size > 1").select("digest", "group_size"), "digest")
        before = before.join(own.select("digest").distinct(), "digest", "left_semi").withColumn("part", part)
        before = stored(by_locator(stored(before.drop("group_size"), "earlier-hits")), "earlier-texts")
        whole = whole.unionByName(before.drop("part"))
        behind = behind.unionByName(before.select("locator", "text", "digest", "part"))
    extremes = behind.groupBy("digest", "part").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    extremes = extremes.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    clash = stored(extremes.where("least <> most").select("digest"), "clashes")
    if not clash.isEmpty():
        apart = whole.join(clash, "digest", "left_semi").groupBy("digest", "text")
        apart = apart.agg(F.max(F.struct("doc_id", "locator")).alias("stays"), F.count("*").alias("group_size"))
        told = rows.join(apart, ["digest", "text"]).select(
            "digest", "doc_id", "locator", F.col("stays.doc_id").alias("keep_id"), F.col("stays.locator").alias("keep_locator"), "group_size"
        )
        out = out.join(clash, "digest", "left_anti").unionByName(told)
    kept = F.col("locator") == F.col("keep_locator")
    return out.select("doc_id", "digest", "locator", "keep_id", "group_size", kept.alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows, at = located(docs, names), dict(zip(map(str.lower, docs.columns), names))
    keys = rows.select(F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["text"]).alias("text"), "locator")
    dropped = _groups(_keyed(keys, sha256)).where("NOT kept").select("locator")
    return rows.join(dropped, "locator", "left_anti").select(*names).toDF(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(documents(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
