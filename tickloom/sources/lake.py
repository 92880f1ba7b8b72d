"""Lake readers. Schemas are always given; days come from the folder layout."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import cached_property, reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.quality import require_rows
from tickloom.session import file_path, scratch_dir, sibling, stored

#: Tasks that list files which are given by name: Spark would take one for each, up to 10,000.
LISTING_TASKS = 64
CORRUPT = "_corrupt_record"
DAY_FOLDER = "{dt=,}[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
DAY_IN_PATH = "/(?:dt=)?([0-9]{4}-[0-9]{2}-[0-9]{2})/"


def _readable(names: list[str]) -> Column:
    """A record is JSON unless it was set aside whole; one with a mistyped field still has others."""
    some_field = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in names], F.lit(False))
    return some_field | F.col(CORRUPT).isNull()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """JSONL files or globs such as ``raw/<source>/*/data.jsonl``.

    A line that is no JSON becomes a row of NULLs, its text visible on request.
    """
    corrupt = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    return (
        spark.read.schema(T.StructType([*schema.fields, *corrupt]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_strict_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same, but a line that is no JSON fails the job."""
    rows = read_json_lines(spark, path, schema, keep_corrupt=True)
    checked = F.assert_true(_readable(schema.names), F.concat(F.lit("unreadable record: "), F.col(CORRUPT)))
    return rows.where(checked.isNull()).select(*schema.names)


def read_required_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return require_rows(read_strict_json_lines(spark, path, schema), path)


class MixedJson:
    """Every ``*.json*`` file below a folder, compressed or not, read by what it holds rather than by its name.

    A line that is a whole JSON object is a record; one that is a whole array holds one per element.
    A file of which less than half the lines are whole may be a document over many lines: if its
    text is one JSON object or array, it is read as such, an array of any size in parts. All other lines
    are skipped, and counted by :meth:`skipped`. A file that gives no record by either way, and one that
    holds a single record of more than ``document_bytes`` characters in a document, is set aside whole:
    :meth:`files` names it, and the others are read all the same.

    The folder is read once for the outline (lines per file) and once for records; files that may be
    documents are read once more, by name, and their parts kept. Both are written below ``below``, or to
    scratch that lasts as long as the application.
    """

    def __init__(self, spark: SparkSession, folder: str, document_bytes: int = 64 << 20, below: str | None = None):
        self.spark, self.folder, self.document_bytes = spark, folder, document_bytes
        self.below = below or scratch_dir(spark, "mixed-json")

    def _text(self, *paths: str) -> DataFrame:
        """``file, block, at, text`` of lines that are not blank; block and at give their order in the file."""
        spark = sibling(self.spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)}) if paths else self.spark
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
        text = F.btrim("value", F.lit(" \t\r\n")).alias("text")
        where, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
        rows = reader.text(list(paths) or self.folder)
        return rows.select(where, block, F.monotonically_increasing_id().alias("at"), text).where("text <> ''")

    def _lines(self) -> DataFrame:
        return self._text().select("file", "text", _whole_json("text").alias("whole"))

    @cached_property
    def _outline(self) -> DataFrame:
        """``file, lines, whole``."""
        counts = self._lines().groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if("whole").alias("whole"))
        return stored(self.spark, counts, "outline", self.below)

    @cached_property
    def _parts(self) -> DataFrame:
        """``file, text, oversized`` of files that may be documents: the object, the array in parts, or NULL."""
        found = self._outline.where(F.col("whole") * 2 < F.col("lines")).select("file").toLocalIterator()
        files = [file_path(r.file) for r in found]
        schema = "file string, text string, oversized boolean"
        if not files:
            return self.spark.createDataFrame([], schema + ", good boolean")
        order = ["file", "block", "at"]
        ordered = self._text(*files).repartition("file").sortWithinPartitions(*order).select("file", "text")
        parts = ordered.mapInArrow(_document_parts(self.document_bytes), schema)
        return stored(self.spark, parts.withColumn("good", F.coalesce(_whole_json("text"), F.lit(False))), "parts", self.below)

    @cached_property
    def _read_whole(self) -> DataFrame:
        """``file, document`` of files whose lines are no records: documents, and those with too large a record."""
        kinds = self._parts.groupBy("file").agg(F.bool_and("good").alias("document"), F.bool_or("oversized").alias("oversized"))
        return stored(self.spark, kinds.where("document OR oversized").select("file", "document"), "read-whole", self.below)

    def files(self) -> DataFrame:
        """``file, verdict, skipped, reason`` of each file: ``lines``, ``document`` or ``set aside``; lines that gave no record."""
        known = self._outline.join(self._read_whole, "file", "left")
        oversized = F.col("document").eqNullSafe(False)
        verdict = F.when(F.col("document"), "document").when(oversized | (F.col("whole") == 0), "set aside").otherwise("lines")
        skipped = F.when(F.col("document"), 0).when(oversized, F.col("lines")).otherwise(F.col("lines") - F.col("whole"))
        reason = F.when(oversized, f"a record of more than {self.document_bytes} characters").when(verdict == "set aside", "no record")
        return known.select("file", verdict.alias("verdict"), skipped.cast("long").alias("skipped"), reason.alias("reason"))

    def skipped(self) -> DataFrame:
        """``file, skipped``: lines that gave no record, for each file that has any."""
        return self.files().where("skipped > 0").select("file", "skipped")

    def _of_lines(self, lines: DataFrame) -> DataFrame:
        """``lines`` (with ``file``) without those of files that are read whole or set aside."""
        return lines if self._parts.isEmpty() else lines.join(self._read_whole.select("file"), "file", "left_anti")

    def _of_documents(self) -> DataFrame:
        return self._parts.join(self._read_whole.where("document").select("file"), "file", "left_semi").select("file", "text")

    def records(self) -> DataFrame:
        """One JSON object per row, as text."""
        texts = self._of_lines(self._lines().where("whole").select("file", "text")).unionByName(self._of_documents())
        return texts.select(F.explode(_elements("text")).alias("record"))

    def schema(self) -> T.StructType:
        """The columns found in the records."""
        return _found_schema(self.records())

    def rows(self, schema: T.StructType | None = None) -> DataFrame:
        """Records under ``schema``; a field of the wrong type is NULL. Without one, under the columns found in them."""
        return _parsed(self.records(), schema if schema is not None else self.schema())

    def parsed(self, schema: T.StructType, path: str) -> tuple[list[str], Callable[[DataFrame], DataFrame]]:
        """The same in one pass over the lines, which takes their outline on the way: (folders with what was parsed,
        a function from what is read back to the rows). Lines of documents are parsed with the others and left out there.
        """
        lines = self._lines()
        one = F.when(F.col("whole"), _elements("text"))
        record = _from_json(F.col("record"), schema).alias("r")
        lines = lines.select(F.col("file").alias("_file"), F.col("whole").alias("_whole"), F.posexplode_outer(one).alias("_at", "record"))
        lines.select("_file", "_whole", "_at", record).write.option("compression", "snappy").parquet(f"{path}/lines")
        kept = self.spark.read.parquet(f"{path}/lines")
        if "_outline" not in self.__dict__:
            self._outline = stored(self.spark, _line_counts(kept), "outline", self.below)
        folders = [f"{path}/lines"]
        if not self._parts.isEmpty():
            texts = self._of_documents().select(F.lit(None).cast("string").alias("_file"), F.explode(_elements("text")).alias("record"))
            texts = texts.select("_file", F.lit(True).alias("_whole"), F.lit(0).alias("_at"), record)
            texts.write.option("compression", "snappy").parquet(f"{path}/documents")
            folders.append(f"{path}/documents")

        def rows(read: DataFrame) -> DataFrame:
            if len(folders) > 1:
                known = self._read_whole.select(F.col("file").alias("_file"))
                read = read.join(known, "_file", "left_anti")
            return _good_rows(read.where("r IS NOT NULL").select("r.*"), schema)

        return folders, rows


def _line_counts(parsed: DataFrame) -> DataFrame:
    """``file, lines, whole`` of parsed lines; a line with many records has one that comes first."""
    first = parsed.where(F.coalesce("_at", F.lit(0)) == 0).groupBy(F.col("_file").alias("file"))
    return first.agg(F.count(F.lit(1)).alias("lines"), F.count_if("_whole").alias("whole"))


def _elements(text: str) -> Column:
    """The records of a whole JSON text: the elements of an array, or the object itself."""
    elements = F.transform(F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), lambda v: F.to_json(v))
    return F.when(F.col(text).startswith("["), elements).otherwise(F.array(text))


def _from_json(record: Column, schema: T.StructType) -> Column:
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(record, fields, {"columnNameOfCorruptRecord": CORRUPT})


def _good_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.where(_readable(schema.names)).select(*schema.names) if schema.names else rows.drop(CORRUPT)


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    return _good_rows(records.select(_from_json(F.col("record"), schema).alias("r")).select("r.*"), schema)


def _document_parts(most: int, part: int = 1 << 20) -> Callable:
    """From the ordered lines of files to ``file, text, oversized``: an object as it is, an array as arrays of about ``part`` characters.

    Only the outline is followed; whether a text is JSON is for the caller to see. A file that is no
    single object or array has a row with a NULL text, and so has one with a record of more than ``most``
    characters, which says so. Strings never span lines in JSON. A task holds one part at a time.
    """
    token = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{},]')

    def pieces(lines):
        kind, depth, held, size, item, cut, closed, long = "", 0, [], 0, 0, False, False, False
        for text in lines:
            if closed or (not kind and text[0] not in "[{"):
                yield None, False
                return
            begin = 0
            if not kind:
                kind = text[0]
                begin = int(kind == "[")
                depth = begin
            for found in token.finditer(text, begin):
                c = text[found.start()]
                if c in "[{":
                    depth += 1
                elif c in "]}":
                    depth -= 1
                    if not depth:
                        closed = True
                        if text[found.end() :].strip():
                            yield None, False
                            return
                        text = text[: found.start()] if kind == "[" else text
                        break
                elif c == "," and depth == 1 and kind == "[":
                    here = size + found.start() - begin
                    long, item = long or here - item > most, here + 1
                    if here >= part:
                        own = "\n".join([*held, text[begin : found.start()]])
                        yield f"[{own}]" if own.strip() else None, False
                        held, size, item, begin, cut = [], 0, 0, found.end(), True
            held.append(text[begin:])
            size += len(text) - begin + 1
            if size - 1 - item > most:
                held, long = [], True
        if not closed or long:
            yield None, closed
        else:
            own = "\n".join(held)
            yield own if kind == "{" else f"[{own}]" if own.strip() or not cut else None, False

    def run(batches):
        rows = (r for b in batches for r in zip(b.column("file").to_pylist(), b.column("text").to_pylist()))
        for file, lines in groupby(rows, key=lambda r: r[0]):
            for text, oversized in pieces(t for _, t in lines):
                arrays = [pa.array([file]), pa.array([text], type=pa.string()), pa.array([oversized])]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "text", "oversized"])

    return run


def _whole_json(text: str) -> Column:
    """Whether a text is a JSON object or array from its first to its last character."""
    c = F.col(text)
    closed = (c.startswith("{") & c.endswith("}")) | (c.startswith("[") & c.endswith("]"))
    return F.when(closed, F.try_parse_json(text).isNotNull()).otherwise(F.lit(False))


def _found_schema(records: DataFrame) -> T.StructType:
    """The columns of all records. Numbers with a fraction are doubles, columns of mixed kinds text."""
    found = records.agg(F.schema_of_variant_agg(F.try_parse_json("record"))).first()[0] or "OBJECT<>"
    ddl = re.sub(r"DECIMAL\(\d+, ?\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    ddl = re.sub(r"\b(VARIANT|VOID)\b", "STRING", ddl)
    empty = records.sparkSession.sql(f"SELECT CAST(NULL AS {ddl}) AS r")
    return empty.schema["r"].dataType if ddl.startswith("STRUCT") else T.StructType()


def read_mixed_json(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of :class:`MixedJson`."""
    return MixedJson(spark, folder).rows(schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text, one payload per row, for the flatten functions."""
    return spark.read.text(path, wholetext=True).select("_metadata", F.col("value").alias("payload"))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; missing ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def day_folders(start: dt.date | None = None, end: dt.date | None = None) -> str:
    """Glob of the day folders in [start, end], with or without a ``dt=`` prefix."""
    if start is None or end is None:
        return DAY_FOLDER
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    months = dict.fromkeys(f"{d:%Y-%m}" for d in days)
    picked = [f"{m}-{{{','.join(f'{d:%d}' for d in days if f'{d:%Y-%m}' == m)}}}" for m in months]
    return f"{{dt=,}}{{{','.join(picked)}}}"


def read_day_folders(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    fmt: str = "parquet",
    start: dt.date | None = None,
    end: dt.date | None = None,
    below: str = "",
) -> DataFrame:
    """Layout ``root/yyyy-MM-dd/[below]``; ``dt`` is taken from the path.

    A known range only lists its own folders; days without a folder are skipped. Without
    one, a filter on ``dt`` still prunes files, since it depends on the file path alone.
    """
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), DAY_IN_PATH, 1))
    rows = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    return rows.load(f"{root}/{day_folders(start, end)}/{below}".rstrip("/")).select(*schema.names, day.alias("dt"))


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """``dt=yyyy-MM-dd`` layout; predicates on ``dt`` prune folders."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("dt", T.DateType())])).parquet(root)


class Sources:
    """Named raw sources, resolved lazily so plans depend on names, not on locations.

    ``gated`` says their rows passed the record contracts.
    """

    def __init__(self, gated: bool = False, **loaders: Callable[[], DataFrame]):
        self.gated = gated
        self._loaders = loaders

    def __call__(self, name: str) -> DataFrame:
        return self._loaders[name]()

    def names(self) -> list[str]:
        return list(self._loaders)

    def replaced(self, **loaders: Callable[[], DataFrame]) -> Sources:
        """The same sources with some of them swapped."""
        return Sources(self.gated, **{**self._loaders, **loaders})


def replay(df: DataFrame, days: int, today: dt.date, day: str = "dt") -> DataFrame:
    """The last ``days`` landed days of a source."""
    return df.where(F.col(day) >= F.lit(today - dt.timedelta(days=days)))
