"""Byte-level BPE: encoding to ids with character offsets, and decoding.

The vocabulary is a file of ranks (base64 bytes and a rank per line). It is loaded into the
tokenizers library by writing every byte as one visible character, as byte-level models do, and by
listing every pair of tokens whose concatenation is a token, ordered by the rank of the result.
Text is split by a pattern first, and each match is merged on its own. No special tokens exist:
every text is ordinary text. Decoding looks ids up in the byte table and joins the bytes; a
character split over several ids comes back whole once the bytes stand together, and bytes that
are no whole character (in a cut list of ids) are shown as the replacement character in text.

Null text counts as empty: no ids, no bytes. Repeated rows each get a row, an empty table none.
Ids unknown to the vocabulary make decoding fail. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from tickloom.llm.common import bytes_of, documents, kept, per_row, texts_of
from tickloom.llm.pieces import PieceCache, byte_characters, shared_cache


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        letters = byte_characters()
        shown = {token: "".join(letters[b] for b in token) for token in self.ranks}
        merges, self.unsure = [], set()
        for token, _ in sorted(self.ranks.items(), key=lambda x: x[1]):
            cuts = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in self.ranks and token[i:] in self.ranks]
            merges += [(shown[a], shown[b]) for a, b in cuts]
            lefts = {a: b for a, b in cuts}
            # Two overlapping pairs with the same result: the library goes by the order of pairs, ranks by place.
            if any(b in lefts and b != a for a, b in cuts):
                self.unsure.add(self.ranks[token])
        model = models.BPE(vocab={shown[t]: r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True)
        self.library = Tokenizer(model)
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False),
            ]
        )

    def merged(self, piece: str) -> list[int]:
        """Ids by the definition: of all neighbours whose bytes are a token, the lowest rank, leftmost first, joins."""
        out = []
        for match in self.pattern.findall(piece):
            data = match.encode()
            out += [self.ranks[data]] if data in self.ranks else self._merge(data)
        return out

    def _merge(self, data: bytes) -> list[int]:
        """Pairs wait in a heap by rank and place; parts are a linked list by the places where they begin."""
        n, rank_of = len(data), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a place
        waiting = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(data[i : i + 2])) is not None]
        heapify(waiting)
        while waiting:
            _, at, upto = heappop(waiting)
            middle = end[at]
            if middle <= at or middle >= n or end[middle] != upto:  # one of the two has been joined since
                continue
            end[at], end[middle] = upto, -1
            if upto < n:
                before[upto] = at
                if (r := rank_of(data[at : end[upto]])) is not None:
                    heappush(waiting, (r, at, end[upto]))
            left = before[at]
            if left >= 0 and (r := rank_of(data[left:upto])) is not None:
                heappush(waiting, (r, left, upto))
        return [self.ranks[data[i:e]] for i, e in enumerate(end) if e > i]

    def settled(self, piece: str, ids: list[int]) -> list[int]:
        """The library's ids, settled by the definition where the order of pairs could matter."""
        return ids if self.unsure.isdisjoint(ids) else self.merged(piece)

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """Character span of each id: a character split over ids belongs to the span of each of them."""
        starts = np.cumsum([0] + [len(self.bytes_of[i]) for i in ids])
        lead = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
        seen = np.concatenate([[0], np.cumsum(lead)])
        first = [int(seen[s + 1]) - 1 if s < len(lead) else int(seen[s]) for s in starts[:-1]]
        return list(zip(first, (int(seen[e]) for e in starts[1:])))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def load(path: str, pattern: str) -> ByteBpe:
    return kept("ranks", (path, pattern), lambda: ByteBpe(path, pattern))


def _ids_of(bpe: ByteBpe, path: str, pattern: str):
    def value(piece, ids):
        return array("i", bpe.settled(piece, ids)).tobytes()

    cache = shared_cache((path, pattern), lambda: PieceCache(bpe.library, value))
    return lambda batch: [np.frombuffer(b"".join(x), dtype=np.int32) for x in cache.values(bytes_of(batch))]


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, offsets: bool = False) -> DataFrame:
    """``doc_id, ids`` per row; with ``offsets`` also ``starts`` and ``ends``, the character span of each id."""

    def make():
        bpe = load(path, pattern)
        of = _ids_of(bpe, path, pattern)

        def run(batch):
            ids = of(batch)
            if not offsets:
                return {"ids": ids}
            spans = [bpe.offsets(t, i.tolist()) for t, i in zip(texts_of(batch), ids)]
            return {"ids": ids, "starts": [[s for s, _ in x] for x in spans], "ends": [[e for _, e in x] for x in spans]}

        return run

    fields = "ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    return per_row(docs, make, [("doc_id", "doc_id"), ("text", "text")], fields, keeps=True)


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, bytes, text`` of rows of ids; null ids count as none."""

    def make():
        bpe = load(path, pattern)

        def run(batch):
            whole = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            return {"bytes": whole, "decoded": [x.decode("utf-8", "replace") for x in whole]}

        return run

    out = per_row(encoded, make, [("doc_id", "doc_id"), ("ids", "ids")], "bytes binary, decoded string", keeps=True)
    return out.select("doc_id", "bytes", F.col("decoded").alias("text"))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, ids, bytes``: each text encoded and its ids decoded, in one pass of Python."""

    def make():
        bpe = load(path, pattern)
        of = _ids_of(bpe, path, pattern)

        def run(batch):
            ids = of(batch)
            return {"ids": ids, "bytes": [bpe.decode(x.tolist()) for x in ids]}

        return run

    return per_row(docs, make, [("doc_id", "doc_id"), ("text", "text")], "ids array<int>, bytes binary", keeps=True)


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of rows of ids and decoded bytes."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
