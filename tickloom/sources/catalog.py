"""Lake folders and stored facts as catalog tables, for plain SQL."""

from __future__ import annotations

import json
from hashlib import sha256

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.session import child_names, file_system
from tickloom.sources.lake import DAY_FOLDER

DT = T.StructField("dt", T.DateType())

# The folder of each lake table.
LAKE_FOLDERS = {
    "coingecko_prices": "coingecko",
    "reddit_posts": "reddit",
    "fear_greed_index": "fear_greed",
    "coingecko_trending": "trending_coins",
}


def _columns(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")


def register(
    spark: SparkSession, database: str, table: str, root: str, schema: T.StructType, partition: T.StructField | None = None
) -> str:
    """External Parquet table over a folder, created if missing, then refreshed."""
    name = f"`{database}`.`{table}`"
    by = f" PARTITIONED BY (`{partition.name}`)" if partition else ""
    fields = [*[f for f in schema if not partition or f.name != partition.name], *([partition] if partition else [])]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(fields)}) USING parquet{by} LOCATION '{root}'")
    return refresh(spark, name, root, schema, partition)


def refresh(
    spark: SparkSession, name: str, root: str, schema: T.StructType, partition: T.StructField | None = None
) -> str:
    """Update in place: add columns the schema has gained and register new day folders."""
    known = set(spark.table(name).columns)
    gained = [f for f in schema if f.name not in known]
    if gained:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(gained)})")
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        _add_bare_days(spark, name, root, partition.name)
    spark.sql(f"REFRESH TABLE {name}")
    return name


def _add_bare_days(spark: SparkSession, name: str, root: str, partition: str, batch: int = 500) -> None:
    """Partitions for folders named by the date alone, which a repair does not recognise."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{DAY_FOLDER.removeprefix('{dt=,}')}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [s.getPath() for s in (fs.globStatus(pattern) or []) if s.isDirectory()]
    for i in range(0, len(days), batch):
        parts = " ".join(f"PARTITION ({partition}='{p.getName()}') LOCATION '{p}'" for p in days[i : i + batch])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def register_lake_table(
    spark: SparkSession,
    database: str,
    table: str,
    root: str,
    schema: T.StructType | None = None,
    database_location: str | None = None,
) -> str:
    """One raw lake table over its day folders, named ``dt=yyyy-MM-dd`` or just ``yyyy-MM-dd``."""
    create_database(spark, database, database_location)
    return register(spark, database, table, root, schema or schemas.LAKE_TABLES[table], DT)


def register_lake(spark: SparkSession, database: str, root: str, database_location: str | None = None) -> list[str]:
    """All raw lake tables below ``root``."""
    return [
        register_lake_table(spark, database, table, f"{root}/{folder}", database_location=database_location)
        for table, folder in LAKE_FOLDERS.items()
    ]


def register_warehouse(spark: SparkSession, database: str, root: str, database_location: str | None = None) -> list[str]:
    """Facts and dimensions of a warehouse folder."""
    create_database(spark, database, database_location)
    day = T.StructField("report_date", T.DateType())
    return [
        register(spark, database, "fct_crypto_daily", f"{root}/fct_crypto_daily", schemas.FCT_CRYPTO_DAILY, day),
        register(spark, database, "fct_market_insights", f"{root}/fct_market_insights", schemas.FCT_MARKET_INSIGHTS, day),
        register(spark, database, "dim_coin", f"{root}/dim_coin", schemas.DIM_COIN),
        register(spark, database, "dim_date", f"{root}/dim_date", schemas.DIM_DATE),
    ]


#: Beside the day folders, and hidden from their readers: what is known of them.
KNOWN = "_columns.json"


def _fingerprints(spark: SparkSession, root: str) -> dict[str, str]:
    """A digest of names, sizes and times of the files in each day folder, from listings alone."""
    out = {}
    for day in child_names(spark, root):
        if day[0] in "._":
            continue
        fs, where = file_system(spark, f"{root}/{day}")
        found, files = fs.listFiles(where, True), []
        while found.hasNext():
            f = found.next()
            if f.getPath().getName()[0] not in "._":
                files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        if files:
            out[day] = sha256(repr(sorted(files)).encode()).hexdigest()
    return out


def discover(spark: SparkSession, root: str) -> tuple[T.StructType, list[str]]:
    """The columns of all Parquet day folders below ``root``, and the folders that had to be looked into.

    What is known is kept beside the folders: their fingerprints, and the columns found so far. Only the
    footers of new or changed folders are read, so a column that the newest day brings costs that day
    alone. Columns are never lost; folders whose columns contradict those known raise an error.
    """
    fs, where = file_system(spark, f"{root}/{KNOWN}")
    known = {"folders": {}, "columns": T.StructType().jsonValue()}
    if fs.exists(where):
        stream = fs.open(where)
        try:
            known = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    columns, now = T.StructType.fromJson(known["columns"]), _fingerprints(spark, root)
    changed = sorted(day for day, mark in now.items() if known["folders"].get(day) != mark)
    if changed:
        found = spark.read.option("mergeSchema", "true").parquet(*(f"{root}/{day}" for day in changed)).schema
        types = {f.name.lower(): f for f in columns}
        for f in found:
            old = types.get(f.name.lower())
            if old is None:
                columns = T.StructType([*columns, T.StructField(f.name, f.dataType)])
            elif old.dataType != f.dataType:
                raise ValueError(f"{root}: {f.name} is {f.dataType.simpleString()} in one of {changed[:3]}, {old.dataType.simpleString()} before")
    if now != known["folders"]:
        stream = fs.create(where, True)
        try:
            stream.write(bytearray(json.dumps({"folders": now, "columns": columns.jsonValue()}).encode()))
        finally:
            stream.close()
    return columns, changed


def register_discovered(spark: SparkSession, database: str, table: str, root: str, database_location: str | None = None) -> tuple[str, list[str]]:
    """A lake table over day folders under the columns found in them; again, to take in new days and columns.

    Returns its name and the folders that were looked into.
    """
    columns, changed = discover(spark, root)
    create_database(spark, database, database_location)
    return register(spark, database, table, root, columns, DT), changed
