"""SimHash near-duplicates, compared at anchor points.

A fingerprint holds for each of its 64 bits whether most hashes of the text's word shingles set it. Two
fingerprints link when at most ``distance`` bits differ, and links form groups.

Anchor points: the words of a covering code lie so that every bit string is within the code's covering
radius r of one of them, its home anchor. If two strings differ in t bits or less, each lies within r + t
of the other's home. So a fingerprint is sent to every anchor within r + t, and at each anchor those
whose home it is are compared with all that were sent. The 64 bits are cut into segments, each with a code
of its own, since ``distance`` differing bits leave at most t = distance // segments in one of them: the
number of anchors within reach grows steeply with t, and a code over all 64 bits reaches thousands.

The codes are linear: every bit has a column, the columns of a word's ones add up to its syndrome, and the
anchors are the words with syndrome 0. Bits come in blocks of 15 with the columns 1 to 15 (a Hamming code,
radius 1), or freely with column 0 (radius 0). The anchors near a string are found by adding those patterns
of few bits that have the string's syndrome. Finer codes send more and compare less, so of three codes the
one is taken that costs least for the number of distinct fingerprints; all give the same links.

Only distinct fingerprints travel, 8 bytes each with the anchor. An anchor with more than ``block`` of them
is dealt into blocks: home fingerprints by visitors, each pair of blocks compared in one place. Every place
returns what connects its fingerprints, not all pairs: each with the smallest of its group there.

Words are those of the contract, letters A to Z in lower case. A text with fewer words than a shingle is one
shingle, and one without words (null, empty, blank) has fingerprint 0 and links like any other. Repeated rows
each get a row; a null ``doc_id`` gives way to any other in its group. An empty table gives an empty result.
Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, column, documents, per_row, slices, stored
from tickloom.llm.jaccard_join import components

SEED = 42
BITS = 64
#: Fingerprints at one anchor, beyond which they are dealt into blocks of so many.
BLOCK = 1 << 13
#: Pairs that are compared in one step.
PAIRS_AT_ONCE = 1 << 20
#: Segments by (Hamming blocks, free bits): few anchors, more, and every string its own anchor.
CODES = (((1, 6), (1, 6), (1, 7)), ((2, 2), (2, 2)), ((0, 32), (0, 32)))
#: Cost of sending a fingerprint to an anchor, in comparisons.
SEND = 400
#: Shingles whose bits are counted in one step.
SHINGLES_AT_ONCE = 1 << 14


class Segment:
    """Bits ``shift`` to ``shift + width - 1`` of a fingerprint, with a linear covering code."""

    def __init__(self, number: int, shift: int, hamming: int, free: int, threshold: int):
        self.number, self.shift = number, shift
        columns = [c << 4 * i for i in range(hamming) for c in range(1, 16)] + [0] * free
        self.columns = np.array(columns, dtype=np.int64)
        self.width, self.threshold, self.radius = len(columns), threshold, hamming
        patterns = [(bits, sum(1 << b for b in bits)) for n in range(self.radius + threshold + 1) for bits in combinations(range(self.width), n)]
        syndromes = np.array([int(np.bitwise_xor.reduce(self.columns[list(bits)])) if bits else 0 for bits, _ in patterns])
        values = np.array([value for _, value in patterns], dtype=np.int64)
        order = np.argsort(syndromes, kind="stable")  # lightest first within a syndrome: the first pattern leads home
        self.patterns, self.starts = values[order], np.searchsorted(syndromes[order], np.arange((1 << 4 * hamming) + 1))
        self.reached = len(patterns) / (1 << 4 * hamming)
        self.anchors = 1 << self.width - 4 * hamming

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        for bit, c in enumerate(self.columns):
            if c:
                out ^= np.where((words >> bit) & 1 == 1, c, 0)
        return out

    def visits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``prints``, anchor and whether it is the home, for all anchors within radius + threshold."""
        words = ((prints >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)).astype(np.int64)
        syndrome = self.syndrome(words)
        many = self.starts[syndrome + 1] - self.starts[syndrome]
        row = np.repeat(np.arange(len(prints)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        anchor = words[row] ^ self.patterns[self.starts[syndrome][row] + nth]
        return row, anchor << 2 | self.number, nth == 0


@dataclass
class Covering:
    """One code per segment; together they cover all pairs at ``distance``."""

    segments: list[Segment]

    @staticmethod
    def of(code: tuple[tuple[int, int], ...], distance: int) -> Covering:
        segments, shift = [], 0
        for number, (hamming, free) in enumerate(code):
            segments.append(Segment(number, shift, hamming, free, distance // len(code)))
            shift += segments[-1].width
        assert shift == BITS and len(code) < 4
        return Covering(segments)

    def cost(self, n: int) -> float:
        """Sending and comparing, in comparisons per fingerprint, for n that are spread evenly."""
        return sum(s.reached * (SEND + n / s.anchors) for s in self.segments)


def covering(n: int, distance: int) -> Covering:
    """The cheapest code for n distinct fingerprints."""
    return min((Covering.of(code, distance) for code in CODES), key=lambda c: c.cost(n))


def fingerprint(text: bytes, size: int) -> int:
    words = text.lower().split()  # of bytes: A to Z, and white space as in the contract
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    many = max(1, len(words) - size + 1)
    starts = np.concatenate([[0], ends[: many - 1] + 1]).tolist()
    ends = ends[-many:].tolist()
    set_bits = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, many, SHINGLES_AT_ONCE):
        part = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE])]
        hashes = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > many, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id, print`` per row of ``docs``; the 64 bits as a signed number."""

    def make():
        def run(batch):
            prints = np.array([fingerprint(t, size) for t in bytes_of(batch)], dtype=np.uint64)
            return {"print": pa.array(prints.view(np.int64))}

        return run

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    return per_row(rows, make, [("doc_id", "doc_id"), ("text", "text")], "print long")


def visits(prints: DataFrame, code: Covering) -> DataFrame:
    """``anchor, print, home``: every fingerprint at every anchor within reach."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, 4096):
            own = batch.column("print").to_numpy()
            for segment in code.segments:
                row, anchor, home = segment.visits(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own[row]), pa.array(home)], names=["anchor", "print", "home"])

    return prints.select("print").mapInArrow(run, "anchor long, print long, home boolean")


def dealt(sent: DataFrame, block: int) -> DataFrame:
    """``anchor, bx, by, print, home, guest``: each home block of an anchor beside each of its visitor blocks.

    Nearly all anchors have one of each, and then a row of a home is both. Only crowded ones are looked up.
    """
    counts = sent.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if("home").alias("h"))
    many = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("long")
    crowded = counts.where((F.col("n") > block) & (F.col("h") > 0)).select("anchor", many("h").alias("nx"), many("n").alias("ny"))
    rows = sent.join(crowded, "anchor", "left").fillna(1, ["nx", "ny"])
    mine = lambda count: F.pmod(F.xxhash64("print"), F.col(count))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    one = (F.col("nx") == 1) & (F.col("ny") == 1)
    guests = rows.select("anchor", each("nx").alias("bx"), mine("ny").alias("by"), "print", (F.col("home") & one).alias("home"), F.lit(True).alias("guest"))
    homes = rows.where(F.col("home") & ~one)
    homes = homes.select("anchor", mine("nx").alias("bx"), each("ny").alias("by"), "print", F.lit(True).alias("home"), F.lit(False).alias("guest"))
    return guests.unionByName(homes)


def links(prints: DataFrame, distance: int, code: Covering, block: int = BLOCK) -> DataFrame:
    """``x, y``: fingerprints and smaller ones they are connected with; their groups are those of all links."""

    def run(batches: Iterator[pa.RecordBatch]):
        for place, own, home, guest in _places(batches):
            x, y = _connected(place, own, home, guest, distance)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    key = ["anchor", "bx", "by"]
    rows = dealt(visits(prints, code), block).repartition(*key).sortWithinPartitions(*key)
    return rows.mapInArrow(run, "x long, y long").distinct()


def _places(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16):
    """Rows in order of their place, some whole places at a time: number of the place, print, home and guest."""
    held: list[list[np.ndarray]] = []

    def columns(parts):
        return [np.concatenate(c) for c in zip(*parts)]

    def out(anchor, bx, by, own, home, guest):
        new = np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (bx[1:] != bx[:-1]) | (by[1:] != by[:-1])])
        return np.cumsum(new), own, home, guest

    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(p[0]) for p in held) < rows:
            continue
        anchor, bx, by, *_ = whole = columns(held)
        last = np.flatnonzero((anchor != anchor[-1]) | (bx != bx[-1]) | (by != by[-1]))
        cut = last[-1] + 1 if len(last) else 0
        held = [[c[cut:] for c in whole]]
        if cut:
            yield out(*(c[:cut] for c in whole))
    if held and len(held[0][0]):
        yield out(*columns(held))


def _connected(place, own, home, guest, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """What links of homes and guests of the same place connect: each print with the smallest of its group."""
    guests = np.flatnonzero(guest)
    many = np.bincount(place[guests], minlength=place[-1] + 1)
    first = np.cumsum(many) - many
    homes = np.flatnonzero(home)
    work = np.cumsum(many[place[homes]])
    values, name = np.unique(own, return_inverse=True)
    bits, root = own.view(np.uint64), np.arange(len(values))
    at = 0
    while at < len(homes):
        # Homes whose comparisons make up one step; one home alone may exceed it by a block's guests.
        until = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        part = homes[at:until]
        n = many[place[part]]
        x = np.repeat(part, n)
        y = guests[np.repeat(first[place[part]], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)]
        near = np.bitwise_count(bits[x] ^ bits[y]) <= distance
        _join(root, name[x[near]], name[y[near]])
        at = until
    moved = np.flatnonzero(root != np.arange(len(root)))
    return values[moved], values[root[moved]]


def _join(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Make ``root`` name the smallest member of each group once the links from x to y are added."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def groups(docs: DataFrame, size: int = 5, distance: int = 4, block: int = BLOCK, code: Covering | None = None) -> DataFrame:
    """``doc_id, print, component_id`` per row of ``docs``; the id is the smallest of the row's group."""
    rows = stored(fingerprints(docs, size), "prints")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    code = code or covering(prints.count(), distance)
    found = stored(links(prints, distance, code, block), "print-links")
    roots = components(found).withColumnRenamed("node", "print")
    placed = stored(prints.join(roots, "print").select("print", "root", "least"), "placed-prints")
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    # Fingerprints without links stand for themselves.
    grouped = placed.join(first, "root").select("print", F.col("component_id").alias("grouped"))
    of = prints.join(grouped, "print", "left").select("print", F.coalesce("grouped", "least").alias("component_id"))
    return rows.join(of, "print").select("doc_id", "print", "component_id")


def op11_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(documents(spark, sf_dir), size=4, distance=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
