"""Record contracts: coerce, check, split into valid and quarantined rows.

Built-in expressions only. Whether a record passes is one cheap predicate; what is wrong
with it, and its original text, are worked out for failing records alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.functions.columns import safe_bigint
from tickloom.session import beside, delete_path, swap

OK = "_ok"
ERRORS = "_errors"
RECORD = "_record"
#: Text a record was parsed from, where there is one.
SOURCE = "_source"


@dataclass(frozen=True)
class Field:
    """One contract field. ``optional`` fields may be NULL, and absent ones get ``default``."""

    name: str
    type: str = "string"
    optional: bool = False
    default: object = None
    min_length: int | None = None
    ge: float | None = None
    le: float | None = None
    any_value: bool = False

    def coerced(self, raw: Column) -> Column:
        if self.type == "bigint":
            return safe_bigint(raw)
        return raw.try_cast(self.type)

    def accepts(self, raw: Column, value: Column) -> Column:
        """Whether the field is fine. Names the coerced value once, so it is parsed once."""
        if self.any_value:
            return F.lit(True)
        if self.type == "string":
            fine = F.length(value) >= self.min_length if self.min_length is not None else raw.isNotNull()
        elif self.ge is None and self.le is None:
            fine = value.isNotNull()
        elif self.type == "double":
            # NaN sorts above infinity, so the range leaves it out.
            low = float("-inf") if self.ge is None else float(self.ge)
            fine = value.between(low, float("inf") if self.le is None else float(self.le))
        else:
            low, high = (self.ge, self.le)
            fine = (value >= low if low is not None else F.lit(True)) & (value <= high if high is not None else F.lit(True))
        fine = F.coalesce(fine, F.lit(False))
        return raw.isNull() | fine if self.optional else fine

    def problem(self, raw: Column, value: Column) -> Column:
        """What is wrong with a field that is not accepted, as text."""
        text = F.when(raw.isNull(), f"{self.name}: missing").when(value.isNull(), f"{self.name}: not a {self.type}")
        if self.min_length is not None:
            text = text.when(F.length(value) < self.min_length, f"{self.name}: too short")
        if self.le is not None:
            text = text.when(value > self.le, f"{self.name}: above {self.le:g}")
        if self.ge is not None:
            text = text.otherwise(f"{self.name}: below {self.ge:g}")
        return F.when(~self.accepts(raw, value), text)


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]


PRICES = Contract(
    "prices",
    (
        Field("symbol", min_length=1),
        Field("price", "double", ge=0),
        Field("timestamp"),
        Field("ingestion_date"),
    ),
)
POSTS = Contract(
    "posts",
    (
        Field("id", min_length=1),
        Field("title", optional=True, default=""),
        Field("score", "bigint", optional=True, default=0),
        Field("created_utc", optional=True),
        Field("url", optional=True, default=""),
    ),
)
INDEX = Contract(
    "index",
    (
        Field("value", "bigint", ge=0, le=100),
        Field("value_classification"),
        Field("timestamp", any_value=True),
        Field("ingestion_date"),
    ),
)
TRENDING = Contract(
    "trending",
    (
        Field("coin_id", min_length=1),
        Field("name"),
        Field("symbol"),
        Field("market_cap_rank", "bigint", optional=True),
        Field("score", "bigint", optional=True),
        Field("timestamp"),
        Field("ingestion_date"),
    ),
)


def annotate(df: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contract columns coerced to their types, plus ``_ok`` and, for bad rows, ``_errors`` and ``_record``.

    ``_record`` is the original: the text in ``_source`` if the frame has it, else the row as
    JSON. Columns outside the contract and ``keep`` are dropped; a column the frame lacks counts
    as an absent field.
    """
    values, accepted, problems = [], [], []
    for f in contract.fields:
        if f.name in df.columns:
            raw = F.col(f.name)
            value = f.coerced(raw)
            accepted.append(f.accepts(raw, value))
            problems.append(f.problem(raw, value))
        else:
            value = F.lit(f.default).cast(f.type)
            accepted.append(F.lit(f.optional))
            problems.append(F.lit(None if f.optional else f"{f.name}: missing"))
        values.append(value.alias(f.name))
    ok = reduce(lambda a, b: a & b, accepted)
    row = F.to_json(F.struct(*[c for c in df.columns if c != SOURCE]), {"ignoreNullFields": "false"})
    original = F.coalesce(F.col(SOURCE), row) if SOURCE in df.columns else row
    return df.select(
        *values,
        *keep,
        ok.alias(OK),
        F.when(~ok, F.array_compact(F.array(*problems))).alias(ERRORS),
        F.when(~ok, original).alias(RECORD),
    )


def parse_json_records(df: DataFrame, json_col: str, contract: Contract) -> DataFrame:
    """JSON text rows to raw string columns, defaults filled only where the key is absent.

    The text itself is kept as ``_source``, so a record that fails is set aside as it came.
    """
    ddl = ", ".join(f"`{f.name}` string" for f in contract.fields)
    parsed = df.select(
        F.from_json(json_col, ddl).alias("_r"), F.json_object_keys(json_col).alias("_keys"), F.col(json_col).alias(SOURCE)
    )
    out = []
    for f in contract.fields:
        value = F.col(f"_r.{f.name}")
        if f.optional and f.default is not None:
            absent = ~F.array_contains("_keys", f.name)
            value = F.when(absent, F.lit(str(f.default))).otherwise(value)
        out.append(value.alias(f.name))
    return parsed.select(*out, SOURCE)


def valid_records(annotated: DataFrame) -> DataFrame:
    return annotated.where(OK).drop(OK, ERRORS, RECORD)


def quarantined_records(annotated: DataFrame) -> DataFrame:
    return annotated.where(~F.col(OK)).select(RECORD, ERRORS)


class AllRecordsInvalid(ValueError):
    """Every record of a source failed its contract."""


def land(
    df: DataFrame, contract: Contract, path: str, day_col: str | None = None, unreadable: DataFrame | None = None
) -> dict[str, int]:
    """Write valid and quarantined rows side by side in one pass and count them.

    The folder is split by ``status=valid`` / ``status=quarantined``, so the source is
    parsed once and nothing is dropped. ``unreadable`` holds texts (``_record``, ``_errors``) that
    gave no record at all; they are quarantined and counted as well.

    Everything is written beside the target first and takes its place when it is complete.
    Raises when no record is valid, and then leaves the target as it was.
    """
    parts = ["status", day_col] if day_col else ["status"]
    own = {f.name for f in contract.fields}
    checked = annotate(df, contract, (day_col,) if day_col and day_col not in own else ())
    checked = checked.withColumn("status", F.when(F.col(OK), "valid").otherwise("quarantined")).drop(OK)
    if unreadable is not None:
        texts = unreadable.select(RECORD, ERRORS).withColumn("status", F.lit("quarantined"))
        checked = checked.unionByName(texts, allowMissingColumns=True)
    if day_col:  # one file per task and day otherwise
        checked = checked.hint("rebalance", *parts)
    # Counted in the writing stage, whose tasks report once even when stages before it are repeated.
    seen = Observation()
    bad = F.count_if(F.col("status") == "quarantined")
    checked = checked.observe(seen, F.count(F.lit(1)).alias("records"), bad.alias("quarantined"))
    spark, staged = df.sparkSession, beside(path)
    try:
        checked.write.partitionBy(*parts).parquet(staged)
        counts = {"records": seen.get["records"], "quarantined": seen.get["quarantined"]}
        if counts["records"] == counts["quarantined"]:
            raise AllRecordsInvalid(f"{contract.name}: all {counts['records']} records failed the contract")
        swap(spark, staged, path)
    finally:
        delete_path(spark, staged)
    return counts
