"""Session settings, and files and folders on whatever filesystem a path names."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# Settings every result depends on: days are UTC days, bad casts raise.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """A session in which the required settings hold: the given one, or a sibling if they differ there.

    The given session is never changed.
    """
    if all(spark.conf.get(key).lower() == value.lower() for key, value in REQUIRED_CONF.items()):
        return spark
    return sibling(spark, REQUIRED_CONF)


def sibling(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session beside the given one, with its settings and then ``conf``. A bare new session would start from defaults."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **conf}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shuffle_partitions(input_bytes: int, per_partition: int = 256 << 20) -> int:
    """Partitions a shuffle of that much input should start with.

    For whoever submits the job, as ``spark.sql.shuffle.partitions`` or
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``: adaptive execution merges
    partitions that turn out small but never adds any.
    """
    return max(1, -(-input_bytes // per_partition))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``, or under the warehouse if that is unset.

    Folders lie below one of the application's, which is deleted when the driver ends: frames that are handed
    out read from it, so it cannot go earlier.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    own = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    if own not in _TO_CLEAR:
        _TO_CLEAR.add(own)
        atexit.register(_clear, spark.sparkContext, own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


_TO_CLEAR: set[str] = set()


def _clear(context, folder: str) -> None:
    with suppress(Exception):  # the JVM may be gone by then
        java = context._jvm
        conf = context._jsc.hadoopConfiguration() if context._jsc else java.org.apache.hadoop.conf.Configuration()
        where = java.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(conf).delete(where, True)


@contextmanager
def scratch_space(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder that is deleted in the end, whatever happens."""
    path = scratch_dir(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)


def stored(spark: SparkSession, df: DataFrame, label: str, below: str | None = None) -> DataFrame:
    """``df`` written to scratch and read back: computed once, and safe when executors are lost.

    ``below`` is the scratch space it goes to and disappears with.
    """
    path = f"{below}/{label}" if below else scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def file_path(uri: str) -> str:
    """The path that readers take for a file as ``_metadata.file_path`` names it, where odd characters are encoded."""
    return unquote(uri)


def files_below(spark: SparkSession, folder: str) -> Iterator[tuple[str, int]]:
    """Name and size of every file below a folder, as the listing goes on.

    Plain statuses: those of ``listFiles`` carry permissions, which cost a local file system a process each.
    """
    fs, where = file_system(spark, folder)
    todo = [where]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if status.isDirectory():
                todo.append(status.getPath())
            else:
                yield status.getPath().getName(), status.getLen()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size below a path, from the filesystem's own summary."""
    fs, where = file_system(spark, path)
    return fs.getContentSummary(where).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    fs, where = file_system(spark, path)
    return fs.exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def beside(path: str) -> str:
    """A fresh hidden sibling of a path: on the same filesystem, and passed over by readers of its parent."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staged-{name}-{uuid.uuid4().hex}"


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another one; the old one goes once the new one is there."""
    fs, new = file_system(spark, staged)
    _, place = file_system(spark, target)
    if not fs.exists(new):
        raise FileNotFoundError(staged)
    old = None
    if fs.exists(place):
        _, old = file_system(spark, beside(target))
        if not fs.rename(place, old):
            raise OSError(f"cannot move {target} aside")
    fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        if old is not None:
            fs.rename(old, place)
        raise OSError(f"cannot move {staged} to {target}")
    if old is not None:
        fs.delete(old, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it is missing. One listing, no file is opened."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return []
    return [s.getPath().getName() for s in fs.listStatus(where)]
