"""Token ids as binary shards: independent zstandard frames, checksums and a seek table at the end.

A shard holds the ids of consecutive documents in ascending ``doc_id`` order. Its ids are cut into
frames that decompress on their own. After them come two skippable frames, which any zstandard
reader passes over: the document index (id, first token within the shard, number of tokens) and,
last, a seek table in the public seekable layout (compressed size, size, 32-bit xxh64 checksum of
each frame, then their number, a descriptor byte and a magic number). A reader takes the last bytes
of a file, then the index, then only the frames it needs.

Null text counts as empty: such a document has the end id alone. Rows with a null ``doc_id`` come
first; repeated rows are written and read once each. An empty table gives no shard and no row. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import column, documents, find_package, scratch, slices
from tickloom.llm.pieces import PieceCache, shared_cache, tokenizer
from tickloom.session import file_system

SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_TOKENS = 1 << 18
MANIFEST = "shard long, path string, width int, first_doc long, last_doc long, n_docs long, n_tokens long"
INDEX = np.dtype([("doc", "<i8"), ("null", "?"), ("start", "<i8"), ("n", "<i8")])


def skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class ShardWriter:
    """Writes one shard. Memory is bounded by one frame and the document index."""

    def __init__(self, out, width: int, frame_tokens: int = FRAME_TOKENS):
        self.out, self.width, self.bytes_a_frame = out, width, frame_tokens * width
        self.pending, self.pending_bytes, self.frames, self.index, self.tokens = [], 0, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=False)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width
        self.index.append((doc_id or 0, doc_id is None, self.tokens, n))
        self.tokens += n
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        while self.pending_bytes >= self.bytes_a_frame:
            data = b"".join(self.pending)
            self._frame(data[: self.bytes_a_frame])
            self.pending = [data[self.bytes_a_frame :]]
            self.pending_bytes = len(self.pending[0])

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(packed)

    def close(self) -> None:
        if self.pending_bytes:
            self._frame(b"".join(self.pending))
        index = self.compressor.compress(np.array(self.index, dtype=INDEX).tobytes())
        self.out.write(skippable(SKIPPABLE_INDEX, index))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC)
        self.out.write(skippable(SKIPPABLE_SEEK, table + foot))


class ShardReader:
    """Reads one shard through a seekable file; frames are decompressed on demand, the last one is kept."""

    def __init__(self, file, size: int, width: int):
        self.file, self.width, self.kept = file, width, (-1, b"")
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - 9 - 12 * n
        self.frames = np.frombuffer(self._at(table, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.packed = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.plain = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        magic, length = struct.unpack("<II", self._at(int(self.packed[-1]), 8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index after the frames")
        self.decompressor = zstandard.ZstdDecompressor()
        self.index = np.frombuffer(self.decompressor.decompress(self._at(int(self.packed[-1]) + 8, length)), dtype=INDEX)

    def _at(self, where: int, length: int) -> bytes:
        self.file.seek(where)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        if self.kept[0] != k:
            data = self.decompressor.decompress(self._at(int(self.packed[k]), int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"checksum of frame {k} does not match")
            self.kept = (k, data)
        return self.kept[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the shard on."""
        begin, end = start * self.width, (start + n) * self.width
        k = int(np.searchsorted(self.plain, begin, side="right")) - 1
        parts = []
        while begin < end:
            at, last = int(self.plain[k]), int(self.plain[k + 1])
            parts.append(self.frame(k)[begin - at : min(end, last) - at])
            begin, k = last, k + 1
        return np.frombuffer(b"".join(parts), dtype=f"<u{self.width}")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first token within the shard, ids) of every document, in order."""
        for doc, null, start, n in self.index.tolist():
            yield (None if null else doc), start, self.ids(start, n)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; one without a scheme is an absolute path of this machine."""
    if ":/" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", re.sub("^s3[an]://", "s3://", uri)))


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme Spark would read it by, so that tasks write where the manifest goes.

    Raises before anything is written if that file system is not one that tasks can open.
    """
    system, where = file_system(spark, folder)
    out = where.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    place(out)
    return out


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int | None = None, shards: int | None = None, frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Encode ``docs`` and write shards below ``folder``; the manifest, one row per shard, is stored beside them.

    Documents are dealt out by ranges of ``doc_id``. Each attempt of a task writes a file of its
    own; a file counts once the manifest names it, so lost or repeated tasks leave no mark on the result.
    """
    spark = docs.sparkSession
    find_package(spark)
    folder = qualified(spark, folder)
    width = 2 if max(tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id or 0) <= 1 << 16 else 4
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        kind, code = f"<u{width}", {2: "H", 4: "I"}[width]
        make = lambda: PieceCache(tokenizer(tokenizer_path), lambda _, ids: array(code, ids).tobytes(), spaced=False)
        cache = shared_cache(("ids", tokenizer_path), make)
        end = b"" if end_id is None else np.array([end_id], dtype=kind).tobytes()
        path, out, n, first, last = f"{folder}/shard-{uuid.uuid4().hex}.zst", None, 0, None, None
        for batch in slices(batches, 512):
            if out is None and batch.num_rows:
                where, name = place(path)
                where.create_dir(name.rpartition("/")[0], recursive=True)
                out = where.open_output_stream(name, compression=None)
                shard = ShardWriter(out, width, frame_tokens)
            ids, at = cache.joined(batch.column("text"))
            for doc_id, begin, upto in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                shard.add(doc_id, b"".join((ids[begin:upto], end)))
                first, last, n = doc_id if not n else first, doc_id, n + 1
        if out is not None:
            shard.close()
            out.close()
            from pyspark import TaskContext

            values = [TaskContext.get().partitionId(), path, width, first, last, n, shard.tokens]
            kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip(values, kinds)], names=names)

    manifest = ordered.mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, with ``base``: the ids in all shards before it.

    Shards are counted in thousands however large the corpus is, so one window over them is small.
    """
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the files: ``start`` counts all ids before it."""
    find_package(spark)
    manifest = read_manifest(spark, folder).select("path", "width", "base")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(n).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")


def _read(batches):
    for batch in batches:
        for x in batch.to_pylist():
            where, name = place(x["path"])
            with where.open_input_file(name) as f:
                out, size = [], 0
                for doc_id, start, ids in ShardReader(f, f.size(), x["width"]).documents():
                    out.append((doc_id, x["base"] + start, len(ids), ids.astype("<u4").tobytes()))
                    size += 4 * len(ids)
                    if size > 8 << 20:
                        yield _rows(out)
                        out, size = [], 0
                if out:
                    yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "start", "n_tokens", "ids"])


def read_documents(manifest: list[dict], wanted: set[int]) -> dict[int, np.ndarray]:
    """Ids of single documents, by random access: only the frames they lie in are decompressed."""
    found = {}
    for x in manifest:
        inside = {d for d in wanted if x["first_doc"] is None or x["first_doc"] <= d <= (x["last_doc"] if x["last_doc"] is not None else d)}
        if inside:
            where, name = place(x["path"])
            with where.open_input_file(name) as f:
                reader = ShardReader(f, f.size(), x["width"])
                for doc, null, start, n in reader.index[np.isin(reader.index["doc"], list(inside))].tolist():
                    if not null:
                        found[doc] = reader.ids(start, n)
    return found


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-shards")
    write_shards(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    out = read_shards(spark, folder)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))
