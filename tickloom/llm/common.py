"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Hashable, Iterator
from contextlib import suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: White space between words: the space and \x09 to \x0D, nothing else.
WORD = r"[^\x20\x09-\x0D]+"


def find_package(spark: SparkSession) -> None:
    """Let Python workers that see the driver's disk import this package wherever they were started.

    On a cluster the package is installed or sent along with ``--py-files``, and this changes nothing.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns to add to ``df``: those given, made longer where ``df`` has them in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared ``spark.checkpoint.dir`` (without that setting, in the warehouse), there until the driver ends."""
    return scratch_dir(spark, label)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, kept when executors are lost."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_finished_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage, between the phases of an operator that runs many queries.

    Plans, broadcast tables and shuffle files of finished queries stay until the driver does so. Left to itself it
    first lets its heap grow to all that it may have, and the executors' disks fill meanwhile.
    """
    gc.collect()  # the plans that Python still names
    spark.sparkContext._jvm.System.gc()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts; null counts as empty."""
    return pc.fill_null(batch.column(name), "").to_pylist()


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The batch's texts in UTF-8; null counts as empty."""
    return pc.fill_null(batch.column(name).cast(pa.binary()), b"").to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that lists made from one stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_KEPT: dict[str, tuple[Hashable, object]] = {}


def kept(kind: str, key: Hashable, make: Callable[[], object]):
    """What this Python worker keeps over the tasks it runs: one value of each kind, that of the last key."""
    if kind not in _KEPT or _KEPT[kind][0] != key:
        _KEPT.pop(kind, None)
        _KEPT[kind] = key, make()
    return _KEPT[kind][1]


def let_go() -> None:
    """Drop what earlier tasks have kept. A worker outlives its operator, and its memory counts for the executor."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        hand_back()


def hand_back() -> None:
    """Return freed memory to the system, as far as the libraries in use can."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError, TypeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable:
    """``run``, for ``mapInArrow``, without what other operators' tasks have kept (unless it ``keeps``); its own memory goes with it."""

    def whole(batches):
        if not keeps:
            let_go()
        yield from run(batches)
        hand_back()

    return whole


def per_row(
    docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], keep: list[tuple[str, str]], fields: str, keeps: bool = False
) -> DataFrame:
    """One output row per input row: columns ``keep`` of ``docs`` unchanged, then those that the function adds.

    ``keep``: (column, name it gets). ``make`` runs once per task and returns a function from a
    batch to ``fields`` (a DDL schema), as Arrow arrays or lists. ``keeps``: it uses what is :func:`kept`
    in the worker, which any other task drops.
    """
    find_package(docs.sparkSession)
    own = docs.select(*(column(c).alias(name) for c, name in keep))
    out_names = [name for _, name in keep if name != "text"]
    schema = ", ".join([f"`{n}` {own.schema[n].dataType.simpleString()}" for n in out_names] + [fields])

    def run(batches):
        added, kinds = make(), None
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            new = added(batch)
            arrays = [batch.column(n) for n in out_names]
            kinds = kinds or arrow_types(fields)
            for name, kind in kinds.items():
                value = new[name]
                arrays.append(value if isinstance(value, pa.Array) else pa.array(value, type=kind))
            yield pa.RecordBatch.from_arrays(arrays, names=[*out_names, *kinds])

    return own.mapInArrow(tidy(run, keeps), schema)


def arrow_types(ddl: str) -> dict[str, pa.DataType]:
    """Arrow types of a DDL schema of plain types and arrays of them."""
    plain = {
        "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }
    out = {}
    for part in ddl.split(","):
        name, kind = part.split()
        out[name] = pa.list_(plain[kind[6:-1]]) if kind.startswith("array<") else plain[kind]
    return out
