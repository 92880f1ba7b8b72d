"""Periodic runs: stretches of a text in which the words repeat with some period.

A run is a maximal stretch with smallest period q and at least ``max(24, 3 q)`` words. Candidates come
from internal pattern matching:

* A suffix array of the words is built by doubling. Its ranks at each round name all factors of length
  1, 2, 4, ..., so the occurrences of a factor are a range of the array, and two places are compared
  by a few equal names.
* Let m be the power of two with m <= q < 2 m, but 8 at least. A run holds a dyadic block, one of
  length m that starts at a multiple of m, whose copy q words later lies in the run too. So each block
  asks for its occurrences among the m places of the window next to it (blocks of 8 also for the
  places 1 to 7 words on), as successors within its range of the suffix array, by a wavelet tree.
* Three or more occurrences in one window are an arithmetic progression whose step d is the smallest
  period of the block. Then block and copies lie in stretches of period d, and a run with a longer
  period must shift the start or the end of one onto that of the other: two candidates, however many
  the occurrences are. One or two occurrences are candidates themselves.
* A candidate is extended to both sides by comparing names, widest first. Of candidates with equal ends
  the smallest period counts; the smallest period of such a stretch is always a candidate.

Texts are read whole and independently, some thousand words of several texts at a time, with words named
apart per text; a longer text is worked on alone, in memory that grows with its words (some 100 bytes a
word, more where all of it repeats). Null, empty and blank texts have no words and no runs. Ties for the
strongest run go to the smallest start, then period. Repeated rows each get a row, an empty table gives an
empty result, and only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, column, documents, per_row

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Shortest dyadic block: what is left of the shortest run without one period of 8 still holds one.
LEAST_BLOCK = 8
#: Words of several texts that are worked on together.
WORDS_AT_ONCE = 1 << 16


class Factors:
    """Suffix array of a sequence of names, and the ranks of its factors of length 1, 2, 4, ...

    ``ranks[k][i]`` is the place in the suffix array where suffixes that share the 2**k names from i begin.
    ``ranks`` ends at the first length at which no factor occurs twice.
    """

    def __init__(self, names: np.ndarray):
        n = self.n = len(names)
        order = np.argsort(names, kind="stable")
        self.array = order.astype(np.int32)
        self.ranks: list[np.ndarray] = []
        self.ranks.append(self._rank(np.full(n, -1, dtype=np.int32), np.arange(n, dtype=np.int32), order, names[order]))
        while 1 << len(self.ranks) - 1 < n:
            rank, width = self.ranks[-1], 1 << len(self.ranks) - 1
            slots = np.flatnonzero(self.shared(rank))
            if not len(slots):
                break
            at = self.array[slots]
            after = np.full(len(at), -1, dtype=np.int64)
            inside = at + width < n
            after[inside] = rank[at[inside] + width]
            key = rank[at].astype(np.int64) * (n + 1) + after
            order = np.argsort(key, kind="stable")
            self.array[slots] = at[order]
            self.ranks.append(self._rank(rank, slots.astype(np.int32), at[order], key[order]))

    @staticmethod
    def _rank(old: np.ndarray, slots: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks in which suffixes ``at``, that now fill ``slots`` in the order of ``keys``, are told apart by them."""
        new = old.copy()
        if len(keys):
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            new[at] = slots[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        return new

    def shared(self, rank: np.ndarray) -> np.ndarray:
        """For each place of the suffix array, whether its factor occurs more than once."""
        in_order = rank[self.array]
        same = in_order[1:] == in_order[:-1]
        return np.concatenate([same, [False]]) | np.concatenate([[False], same]) if self.n else np.zeros(0, dtype=bool)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a < b, how many names from a on equal those from b on."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in self._down():
            width = 1 << k
            go = np.flatnonzero(b + width <= self.n)
            go = go[self.ranks[k][a[go]] == self.ranks[k][b[go]]]
            a[go] += width
            b[go] += width
        return a - start

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a < b, how many names just before a equal those just before b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in self._down():
            width = 1 << k
            go = np.flatnonzero(a >= width)
            go = go[self.ranks[k][a[go] - width] == self.ranks[k][b[go] - width]]
            a[go] -= width
            b[go] -= width
        return start - a

    def _down(self):
        """Widths from the widest; that one repeatedly would not match, as nothing of twice its width occurs twice."""
        return range(len(self.ranks) - 1, -1, -1)


class Wavelet:
    """Wavelet tree of a sequence of numbers, level by level: how many are below a bound in a range, and the j-th smallest."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.before = bits, [], []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(~ones, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at places low to high - 1 are below the bound, itself of no more bits."""
        count = np.zeros(len(low), dtype=np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before = self.before[level]
            zero_low, zero_high = before[low], before[high]
            one = (bound >> bit) & 1 == 1
            count += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, self.zeros[level] + low - zero_low, zero_low)
            high = np.where(one, self.zeros[level] + high - zero_high, zero_high)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The j-th smallest number, from 0, at places low to high - 1."""
        value = np.zeros(len(low), dtype=np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before = self.before[level]
            zero_low, zero_high = before[low], before[high]
            zeros = zero_high - zero_low
            one = j >= zeros
            value |= np.where(one, 1 << bit, 0)
            j = np.where(one, j - zeros, j)
            low = np.where(one, self.zeros[level] + low - zero_low, zero_low)
            high = np.where(one, self.zeros[level] + high - zero_high, zero_high)
        return value


def candidates(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that every run has at least one of."""
    n, least = factors.n, LEAST_BLOCK.bit_length() - 1
    places, periods = [], []
    if len(factors.ranks) > least:
        # Only places whose shortest block occurs again are asked about, so only they are in the tree.
        often = factors.shared(factors.ranks[least])
        slot = np.concatenate([[0], np.cumsum(often)])
        tree = Wavelet(factors.array[often].astype(np.int64), max(1, n.bit_length()))
        for k in range(least, len(factors.ranks)):
            width, rank = 1 << k, factors.ranks[k]
            block = np.arange(0, n - width + 1, width)
            low = rank[block].astype(np.int64)
            sizes = np.bincount(rank, minlength=n)[low]
            block, low, high = block[sizes > 1], low[sizes > 1], (low + sizes)[sizes > 1]
            for nearest in [1, width] if k == least else [width]:
                furthest = np.minimum(block + (width if nearest == 1 else 2 * width), n)
                for place, period in _in_window(factors, tree, block, slot[low], slot[high], block + nearest, furthest):
                    places.append(place)
                    periods.append(period)
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _in_window(factors: Factors, tree: Wavelet, block, low, high, nearest, furthest):
    """Candidates from the occurrences of each block at places nearest to furthest - 1, as (places, periods)."""
    nearest = np.minimum(nearest, furthest)
    passed = tree.below(low, high, nearest)
    count = tree.below(low, high, furthest) - passed
    block, low, high, passed, count = (x[count > 0] for x in (block, low, high, passed, count))
    first = tree.smallest(low, high, passed)
    yield block, first - block
    two = count > 1
    block, first, count = block[two], first[two], count[two]
    second = tree.smallest(low[two], high[two], passed[two] + 1)
    yield block, second - block
    row = count > 2  # a progression: its step is the smallest period of the block
    block, first, step = block[row], first[row], (second - first)[row]
    yield block, (first - factors.behind(first, first + step)) - (block - factors.behind(block, block + step))
    yield block, (first + factors.ahead(first, first + step)) - (block + factors.ahead(block, block + step))


def runs_of(names: np.ndarray) -> np.ndarray:
    """``start, length, period`` of all runs of a sequence of names, by start, then period."""
    none = np.zeros((0, 3), dtype=np.int64)
    if len(names) < LEAST_WORDS:
        return none
    factors = Factors(names)
    place, period = candidates(factors)
    real = (period > 0) & (place + period < len(names))
    pairs = np.unique(np.stack([place[real], period[real]], axis=1), axis=0)
    if not len(pairs):
        return none
    place, period = pairs[:, 0], pairs[:, 1]
    start = place - factors.behind(place, place + period)
    end = place + period + factors.ahead(place, place + period)
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    found = np.stack([start, end, period], axis=1)[long]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    smallest = np.ones(len(found), dtype=bool)
    smallest[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[smallest]
    found[:, 1] -= found[:, 0]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, given as words: one sequence of names for all, words named apart per text."""
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    words = pa.array([w for words in texts for w in words], type=pa.binary()).dictionary_encode()
    names = words.indices.to_numpy().astype(np.int64) + np.repeat(np.arange(len(texts)), sizes) * max(1, len(words.dictionary))
    found = runs_of(names)
    ends = np.cumsum(sizes)
    of = np.searchsorted(ends, found[:, 0], side="right")
    found[:, 0] -= (ends - sizes)[of]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and of each run's first period, joined by a space; a word goes if any run repeats it."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_words, starts, lengths, periods, collapsed`` per row of ``docs``: its runs by start, then period.

    ``collapsed`` is the text without repeated periods. ``rewrite`` may change a text's words first, given its id.
    """

    def make():
        def run(batch):
            out = {"n_words": [], "starts": [], "lengths": [], "periods": [], "collapsed": []}
            ids = batch.column("doc_id").to_pylist()
            waiting: list[list[bytes]] = []
            many = 0

            def work():
                for words, runs in zip(waiting, runs_of_texts(waiting)):
                    out["n_words"].append(len(words))
                    for name, values in zip(("starts", "lengths", "periods"), runs.T):
                        out[name].append(values)
                    out["collapsed"].append(collapsed(words, runs).decode())
                waiting.clear()

            for doc_id, text in zip(ids, bytes_of(batch)):
                words = text.split()  # of bytes: at white space as in the contract
                words = rewrite(doc_id, words) if rewrite else words
                if waiting and many + len(words) > WORDS_AT_ONCE:
                    work()
                    many = 0
                waiting.append(words)
                many += len(words)
            work()
            return out

        return run

    keep = [("doc_id", "doc_id"), ("text", "text")]
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    return per_row(rows, make, keep, "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string")


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text, by a hash of its id, with a part of it repeated to the end; a text without an id as it is."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


def strongest(runs: str) -> Column:
    """Of ``runs`` (structs of start, length, period, by start, then period) the first of the greatest length / period."""
    longer = lambda x, best: best["period"].isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(longer(x, best), x).otherwise(best))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_runs(documents(spark, sf_dir), repeated_tail)
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    out = out.select("doc_id", "collapsed", runs.alias("runs")).withColumn("best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
