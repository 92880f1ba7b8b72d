"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text knows every substring of that text. A document
is parsed from left to right into phrases, each the longest match the automaton still knows; a text
in the automaton's language falls into few long phrases, any other into many short ones. A phrase
costs the log of the length of the text it was found in, since any place there may be meant, so
languages that learned from little text compare with those that learned from much. A letter that a
language has not learned costs as much as a phrase of the longest text. The language with the least
cost wins, ties going to the first name; among equally long texts that is the fewest phrases.

Texts are reduced to lower-case letters with one space between runs of them; letters that no language
has learned match nothing. An automaton is a dense table of (state, symbol) for the ``COMMON`` most
frequent letters of its language, and a sorted list of moves for all others. A batch of documents
is parsed at once: whole texts are laid out as rows of ``BLOCK`` symbols, phrases end with their
row, and one numpy lookup per symbol, with a search for letters beyond the table, moves all rows on.

Learning keeps at most ``chars_a_language`` characters per language, letters and the spaces between
words, from rows chosen by a hash, and ``chars_in_all`` of all languages together, in equal parts; these
bounds fix the size of the model whatever the corpus holds. A language with less labelled text than its
part learns from all of it. Of more than ``most_languages`` labels, those with the most text are learned.

Null text, or text without a letter, is ``und`` with score 0. Repeated rows each get a row. Without
a labelled row nothing can be predicted, and every text is ``und``. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import column, documents, find_package, per_row, slices, texts_of

BLOCK = 512
COMMON = 62  # letters in a table's row, with the space and the unknown letter: 64; moves by other letters are listed
CHARS_A_LANGUAGE = 40_000
#: Letters of all languages together: 26 languages learn 40,000 each, 200 languages 5,000, in tables of some 240 MB for 26 letters.
CHARS_IN_ALL = 1 << 20
MOST_LANGUAGES = 1000


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letters(text: str) -> np.ndarray:
    """Code points in lower case, every run of other characters one space, none at the ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    if not len(codes):
        return codes
    own = is_letter(codes)
    codes = np.where(own, codes, 32)
    keep = own.copy()
    keep[1:] |= own[:-1]
    codes = codes[keep]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


_LETTER = np.zeros(1 << 16, dtype=bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def is_letter(codes: np.ndarray) -> np.ndarray:
    own = _LETTER[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    own[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return own


def suffix_edges(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions symbol -> state of each state of the suffix automaton of a sequence; 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        now = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = now
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return edges


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """The same as a table (state, symbol) -> state; 0 (the start) means none."""
    return dense(suffix_edges(symbols), width)


def dense(edges: list[dict[int, int]], width: int) -> np.ndarray:
    """The moves by symbols below ``width`` as a table (state, symbol) -> state."""
    moves = np.zeros((len(edges), width), dtype=np.int32)
    for state, out in enumerate(edges):
        for c, to in out.items():
            if c < width:
                moves[state, c] = to
    return moves


class Automaton:
    """One language. ``table[state * width + column]`` is ``2 * width * next + new phrase``; states are kept times the width.

    Columns: 0 the space, then the common letters, ``width - 1`` a letter the language lacks, and from
    ``width`` on the other letters, whose moves are ``listed`` under ``state * width * letters + column``.
    """

    def __init__(self, own: np.ndarray, symbols: int):
        found, times = np.unique(own[own > 0], return_counts=True)
        found = found[np.lexsort((found, -times))]
        self.width = min(len(found), COMMON) + 2
        self.columns = np.full(symbols, self.width - 1, dtype=np.int32)
        self.columns[0] = 0
        self.columns[found[:COMMON]] = np.arange(1, self.width - 1)
        self.columns[found[COMMON:]] = np.arange(self.width, self.width + len(found) - self.width + 2)
        self.letters = len(found) + 2
        self.foreign = self.columns == self.width - 1
        self.foreign[0] = not (own == 0).any()
        edges = suffix_edges(self.columns[own].tolist())
        moves = dense(edges, self.width)
        begun = np.where(moves > 0, moves, moves[0][None, :]).astype(np.int64)
        new = (moves == 0) | (np.arange(len(moves)) == 0)[:, None]
        begun[:, self.width - 1] = 0  # an unknown letter is a phrase, and nothing goes on from it
        state = np.int32 if 2 * self.width * len(moves) < 2**31 else np.int64
        self.table = (begun * self.width * 2 + new).astype(state).ravel()
        more = sorted((at * self.width * self.letters + c, 2 * self.width * to + (at == 0)) for at, out in enumerate(edges) for c, to in out.items() if c >= self.width)
        self.listed = np.array([k for k, _ in more], dtype=np.int64)
        self.targets = np.array([to for _, to in more], dtype=state)

    def after(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """What the table would hold for letters beyond it; the start has a move for each."""
        keys = state.astype(np.int64) * self.letters + column
        place = np.minimum(np.searchsorted(self.listed, keys), len(self.listed) - 1)
        none = self.listed[place] != keys
        place[none] = column[none] - self.width  # the start's moves come first, in the order of columns
        return self.targets[place]


class CrossParser:
    """The automata of all languages over all letters they have learned."""

    def __init__(self, learned: dict[str, np.ndarray]):
        self.names = sorted(learned)
        codes = np.unique(np.concatenate([np.zeros(0, dtype=np.uint32), *learned.values()]))
        self.alphabet = codes[codes != 32].astype(np.uint32)
        self.width = len(self.alphabet) + 2
        self.lengths = [len(learned[name]) for name in self.names]
        self.costs = np.log(np.array(self.lengths, dtype=np.float64) + 1)
        self.automata = [Automaton(self.symbols(learned[name]), self.width) for name in self.names]
        self.foreign = np.stack([a.foreign for a in self.automata], axis=1).astype(np.int64) if self.names else np.zeros((self.width, 0), dtype=np.int64)

    @property
    def table(self) -> np.ndarray:
        """The tables of all languages, one behind the other."""
        return np.concatenate([np.zeros(0, dtype=np.int32), *(a.table for a in self.automata)])

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """0 the space, 1.. the alphabet, the last the unknown letter."""
        place = np.searchsorted(self.alphabet, codes)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == codes if len(self.alphabet) else np.zeros(len(codes), bool)
        out = np.where(known, place + 1, self.width - 1)
        out[codes == 32] = 0
        return out.astype(np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases per (text, language); rows of ``BLOCK`` symbols are parsed side by side."""
        total = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        blocks = [(i, at, min(BLOCK, len(x) - at)) for i, x in enumerate(texts) for at in range(0, len(x), BLOCK)]
        if not blocks or not self.names:
            return total
        blocks.sort(key=lambda b: -b[2])
        lengths = np.array([n for _, _, n in blocks])
        laid = np.zeros((BLOCK, len(blocks)), dtype=np.int32)
        for k, (i, at, n) in enumerate(blocks):
            laid[:n, k] = texts[i][at : at + n]
        active = np.searchsorted(-lengths, -np.arange(BLOCK), side="left")  # rows longer than the step
        owner = np.array([i for i, _, _ in blocks])
        for k, own in enumerate(self.automata):
            columns = own.columns[laid]
            beyond = len(own.listed) and columns >= own.width
            within = np.where(beyond, own.width - 1, columns) if np.any(beyond) else columns
            state = np.zeros(len(blocks), dtype=own.table.dtype)
            count = np.zeros(len(blocks), dtype=np.int32)
            for step in range(BLOCK):
                n = active[step]
                if not n:
                    break
                found = own.table[state[:n] + within[step, :n]]
                if within is not columns:
                    at = np.flatnonzero(beyond[step, :n])
                    found[at] = own.after(state[at], columns[step, at])
                count[:n] += found & 1
                state[:n] = found >> 1
            np.add.at(total[:, k], owner, count)
        return total

    def cost(self, texts: list[np.ndarray]) -> np.ndarray:
        """Nats per (text, language): phrases by the length of the language's text, letters it lacks by the greatest such."""
        lacking = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        for i, x in enumerate(texts):
            times = np.bincount(x)
            seen = np.flatnonzero(times)
            lacking[i] = times[seen] @ self.foreign[seen]
        return self.phrases(texts) * self.costs + lacking * (self.costs.max(initial=0) - self.costs)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        codes = [letters(t) for t in texts]
        costs = self.cost([self.symbols(c) for c in codes])
        out = []
        for c, row in zip(codes, costs):
            if not len(c) or not self.names:
                out.append(("und", 0.0))
            elif len(row) == 1:
                out.append((self.names[0], 1.0))
            else:
                best = int(np.argmin(row))
                second = np.partition(row, 1)[1]
                out.append((self.names[best], float(1 - row[best] / second) if second else 0.0))
        return out


def learn(docs: DataFrame, chars_a_language: int = CHARS_A_LANGUAGE, chars_in_all: int = CHARS_IN_ALL, most_languages: int = MOST_LANGUAGES) -> CrossParser:
    """A parser from rows that are not held out and have a language.

    Per language, rows are taken in the order of a hash until their letters fill the bound. A threshold
    on the hash leaves a few rows per language before these are put in order, so a language with most
    of the rows is not sorted in one task; where these rows do not fill the bound, the threshold is
    raised until they do or all rows are in. At most the bound, and the row that reaches it, come to the driver.
    """
    find_package(docs.sparkSession)
    rows = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text"), column("lang").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    # Hashes below a threshold per language: those are expected to hold three times the bound, and twenty rows
    # at least. Known to the plan as literals, one per language, so other rows are left out before any shuffle.
    usable = F.least(F.length("text"), F.lit(chars_a_language))
    counts = rows.where("text <> ''").groupBy("lang").agg(F.sum(usable).alias("total"), F.count("*").alias("rows"))
    sizes = counts.orderBy(F.desc("total"), "lang").limit(most_languages).collect()
    chars_a_language = min(chars_a_language, max(1, chars_in_all // max(1, len(sizes))))
    shares = {r["lang"]: max(3.0 * chars_a_language / r["total"], 20.0 / r["rows"]) for r in sizes}
    joined = {}
    while shares:
        got = _letters_below(rows, shares, chars_a_language)
        joined |= got
        shares = {x: 8 * s for x, s in shares.items() if s < 1 and len(got.get(x, ())) < chars_a_language}
    return CrossParser({lang: whole for lang, whole in joined.items() if len(whole)})


def _letters_below(rows: DataFrame, shares: dict[str, float], most: int) -> dict[str, np.ndarray]:
    """Up to ``most`` letters and spaces per language, from the rows whose hash lies in the first share of all hashes."""
    limits = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    position = (F.col("h") / F.lit(2.0**64)) + F.lit(0.5)
    below = rows.where(position <= F.try_element_at(limits, F.col("lang")))

    def run(batches):
        for batch in slices(batches):
            texts = [letters(x)[:most] for x in texts_of(batch)]
            plain = pa.array([x.astype("<u4").tobytes().decode("utf-32-le") for x in texts], type=pa.string())
            sizes = pa.array([len(x) + 1 for x in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), sizes, plain], names=["lang", "h", "n", "plain"])

    # Equal rows teach once, and are combined before the shuffle.
    reduced = below.mapInArrow(run, "lang string, h long, n long, plain string").where("n > 1")
    once = reduced.groupBy("lang", "h").agg(F.first("n").alias("n"), F.first("plain").alias("plain"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("h")) - F.col("n")
    taken = once.withColumn("before", before).where(F.col("before") < most).select("lang", "h", "plain")
    parts: dict[str, list[str]] = {}
    for lang, _, plain in sorted(tuple(r) for r in taken.collect()):
        parts.setdefault(lang, []).append(plain)
    return {lang: np.frombuffer("".join(p + " " for p in own).encode("utf-32-le"), dtype=np.uint32)[:most] for lang, own in parts.items()}


def identify(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """``doc_id, lang_pred, score`` per row. The score is the share of phrases saved against the second best."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    def make():
        def run(batch):
            out = shared.value.predict(texts_of(batch))
            return {"lang_pred": [x for x, _ in out], "score": [y for _, y in out]}

        return run

    return per_row(docs, make, [("doc_id", "doc_id"), ("text", "text")], "lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs, learn(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
