"""Lake writers. All commit through Spark's output committer straight to the target."""

from __future__ import annotations

import warnings
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.quality import QualityError, counted
from tickloom.session import beside, delete_path, files_below, path_exists, scratch_space, sibling, swap
from tickloom.sources.lake import MixedJson, read_strict_json_lines


def save_day(df: DataFrame, root: str, source: str, day: str) -> str:
    """JSONL for one source and day under ``root/source/day``, replacing that day."""
    path = f"{root}/{source}/{day}"
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def save_days(df: DataFrame, path: str, day: str = "dt") -> None:
    """JSONL split by day; days present in ``df`` are replaced, others stay."""
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(day)
        .json(path)
    )


def publish_parquet(spark: SparkSession, json_path: str, parquet_path: str, schema: T.StructType) -> int:
    """JSONL to Snappy Parquet; raises on a broken line and when there was nothing to convert.

    The target is replaced only by a conversion that succeeded.
    """
    rows, seen = counted(read_strict_json_lines(spark, json_path, schema))
    staged = beside(parquet_path)
    try:
        rows.write.option("compression", "snappy").parquet(staged)
        if seen.get["rows"] == 0:
            raise QualityError(f"no records in {json_path}")
        swap(spark, staged, parquet_path)
    finally:
        delete_path(spark, staged)
    return seen.get["rows"]


def append_checked(df: DataFrame, path: str) -> int:
    """Append to a raw table and return the rows loaded; raises on zero."""
    rows, seen = counted(df)
    rows.write.mode("append").parquet(path)
    if seen.get["rows"] == 0:
        raise QualityError(f"loaded no rows into {path}")
    return seen.get["rows"]


def folder_bytes(spark: SparkSession, folder: str, glob: str) -> int:
    """Total size of the files below a folder that match, from the file system's listing."""
    return sum(size for name, size in files_below(spark, folder) if fnmatch(name, glob))


def holds_bytes(spark: SparkSession, folder: str, glob: str) -> bool:
    """Whether a file below a folder matches and is not empty; the listing ends at the first one."""
    return any(size and fnmatch(name, glob) for name, size in files_below(spark, folder))


def compact_report(
    spark: SparkSession, folder: str, out: str, schema: T.StructType | None = None, target_bytes: int = 256 << 20, document_bytes: int = 64 << 20
) -> dict[str, int]:
    """Many small JSON files to few Snappy Parquet files of about ``target_bytes``.

    The files are parsed by as many tasks as they make splits. What came out is measured and packed into
    tasks of ``target_bytes`` of Parquet, each of which reads its parts and writes one file: nothing is
    shuffled. Returns ``rows``, the ``skipped_lines`` of ``skipped_files`` that hold lines that are no
    records, and the number of files ``set_aside``, which a warning names. The rest is compacted all the
    same. With nothing to do nothing is written.
    """
    nothing = {"rows": 0, "skipped_lines": 0, "skipped_files": 0, "set_aside": 0}
    if not path_exists(spark, folder) or not holds_bytes(spark, folder, "*.json*"):
        return nothing
    staged = beside(out)
    with scratch_space(spark, "compaction") as below:
        try:
            mixed = MixedJson(spark, folder, document_bytes, below)
            schema = mixed.schema() if schema is None else schema
            folders, rows_of = mixed.parsed(schema, f"{below}/parsed")
            # Parts are packed by Spark, the largest first, as many as fit the target; a part is split at its row groups.
            packed = sibling(spark, {"spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"})
            rows, seen = counted(rows_of(packed.read.schema(spark.read.parquet(folders[0]).schema).parquet(*folders)))
            rows.write.option("compression", "snappy").parquet(staged)
            swap(spark, staged, out)
        finally:
            delete_path(spark, staged)
        files = mixed.files()
        aside = F.col("verdict") == "set aside"
        lines, n, left = files.agg(F.coalesce(F.sum("skipped"), F.lit(0)), F.count_if(F.col("skipped") > 0), F.count_if(aside)).first()
        if left:
            for r in files.where(aside).orderBy("file").limit(20).collect():
                warnings.warn(f"{r.file} set aside: {r.reason}", stacklevel=2)
    return {"rows": seen.get["rows"], "skipped_lines": lines, "skipped_files": n, "set_aside": left}


def compact(spark: SparkSession, folder: str, out: str, schema: T.StructType | None = None, target_bytes: int = 256 << 20) -> int:
    """The same; returns the number of rows alone."""
    return compact_report(spark, folder, out, schema, target_bytes)["rows"]


def compact_all(spark: SparkSession, raw_root: str, out_root: str, schemas: dict[str, T.StructType]) -> dict[str, dict[str, int]]:
    """Compact every source folder under ``raw_root``; the report of each."""
    return {name: compact_report(spark, f"{raw_root}/{name}", f"{out_root}/{name}", schema) for name, schema in schemas.items()}
