"""N-gram Jaccard join: documents whose sets of word shingles are similar, and the groups that links form.

Documents with equal sets form a class; all further work is on classes. The join filters candidates
by prefixes under several global token orders. Under any total order two sets with Jaccard
similarity of at least t share a token among the first n - ceil(t n) + 1 of each, so a pair must
pass for every order:

* order 1 puts rare tokens first: first those made of rare words, and last of all those that many
  prefixes share. It forms the candidates, as rare tokens make short lists; lengths and positions of
  the shared token are tested in the join.
* orders 2 and 3 are two permutations of the tokens. Each class carries its prefixes under both, 32 bits
  a token, and a candidate whose prefixes have none in common under either is dropped before any text is
  fetched. So are members of a long list that meet no other one under both orders.

A list of at most ``LONG_LIST`` classes under a token yields its pairs. A longer one is never paired
up: each member meets the list's leader (the one that shares most tokens with others), and since only
connected groups matter, members in the leader's group are settled. What is left meets the list in
blocks of bounded size, compared by one sparse-to-dense product each, and a block returns at most a
spanning forest of its links. No partner is dropped and no list is cut: the split into lists, leaders
and blocks only decides where a pair is looked at. Which words and tokens count as common affects
order 1 alone; any choice gives the same result. The tables of common words (at most 2**16 can have
a share of 2**-16) and of shared tokens (``MOST_SHARED``) that are sent to all tasks are bounded.

Words and sets are those of the contract: letters A to Z in lower case, ``size`` words per shingle, a
shorter text is one shingle, null or blank text has an empty set and links with nothing. Shingles
are 63-bit hashes, classes 128-bit hashes of their sets. Sets are not stored or sent: they are larger
than the texts they come from and do not compress, so texts travel and are cut up where they meet.
Repeated rows each get a row. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, column, documents, find_package, fresh, let_finished_go, per_row, slices, stored, tidy
from tickloom.session import scratch_space

LONG_LIST = 16
#: Rounds of ``components`` from one collection of the driver's garbage to the next.
ROUNDS = 4
MOST_SHARED = 1 << 18
FILTER_BITS = 1 << 24
#: Words with a share of all words above 2**-COMMON_BITS are common; their class is 0 to 15.
COMMON_BITS = 16
BLOCK_TOKENS = 1 << 15
#: Tokens that a prefix is kept longer than half as long again.
SPARE = 16
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    """Hash of a word, its class in the low four bits; a bounded table of those seen."""

    def __init__(self, classes: dict[bytes, int], most: int):
        super().__init__()
        self.classes, self.most = classes, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word) & ~15 | self.classes.get(word, 0)
        return h


class Shingler:
    """Sets of shingles in order 1, as far as words settle it: the classes of a shingle's words are its leading bits."""

    def __init__(self, size: int, classes: dict[bytes, int], most_words: int = 300_000):
        self.size, self.words = size, _Words(classes, most_words)
        self.weights = mixed(np.arange(1, size + 1, dtype=np.uint64) * _K[0]) | np.uint64(1)

    def tokens(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A to Z, and white space as in the contract
        if not words:
            return np.zeros(0, dtype=np.int64)
        h = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.size, len(h))
        many = len(h) - n + 1
        common = (h & np.uint64(15)).astype(np.int64)
        total, rank = np.full(many, n, dtype=np.uint64), np.zeros(many, dtype=np.int64)
        for i in range(n):
            total += h[i : many + i] * self.weights[i]
            rank += common[i : many + i]
        return np.unique((mixed(total) >> np.uint64(7)).view(np.int64) | np.minimum(rank, 63) << 57)


def common_words(docs: DataFrame) -> dict[bytes, int]:
    """Class 0 to 15 of every common word, by the logarithm of its share of all words.

    Each task reports its words with a share above half the limit, 2**17 at most.
    """
    find_package(docs.sparkSession)

    def run(batches):
        counts: Counter = Counter()
        total = 0
        for batch in slices(batches):
            for text in bytes_of(batch):
                words = text.lower().split()
                counts.update(words)
                total += len(words)
            rare = 1
            while len(counts) > 600_000:  # rare words go; the common ones are seen again and again
                counts = Counter({w: c for w, c in counts.items() if c > rare})
                rare *= 2
        own = [(w, c) for w, c in counts.items() if c << COMMON_BITS + 1 > total]
        cols = [pa.array([w for w, _ in own], type=pa.binary()), pa.array([c for _, c in own], type=pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["word", "c"])
        yield pa.RecordBatch.from_arrays([pa.array([None], type=pa.binary()), pa.array([total], type=pa.int64())], names=["word", "c"])

    found = docs.select(column("text").alias("text")).mapInArrow(tidy(run), "word binary, c long")
    counts = stored(found.groupBy("word").agg(F.sum("c").alias("c")), "words")
    total = counts.where("word IS NULL").agg(F.sum("c")).first()[0] or 0
    top = counts.where(F.col("word").isNotNull() & (F.col("c") * (1 << COMMON_BITS) > total)).toArrow()
    share = np.log2(np.maximum(1, top["c"].to_numpy()) / max(1, total))
    return dict(zip(top["word"].to_pylist(), np.clip(COMMON_BITS + share, 0, 15).astype(int).tolist()))


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def first_under(tokens: np.ndarray, order: int, length: int) -> np.ndarray:
    """32 bits of each of the first tokens under order 2 or 3; equal tokens agree in them, so none that meet are lost."""
    keys = mixed((tokens.view(np.uint64) ^ _K[order]) * _K[order + 1])
    first = tokens[np.argpartition(keys, length - 1)[:length]] if 0 < length < len(tokens) else tokens[:length]
    return first.astype(np.uint32).view(np.int32)


def _class_of(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def front(tokens: np.ndarray, is_late: np.ndarray, length: int, whole: bool) -> np.ndarray | None:
    """The first ``length`` of a set when late tokens go last, given its beginning (or the ``whole`` set); None if that does not reach."""
    if not is_late[:length].any():
        return tokens[:length]
    early = tokens[~is_late]
    if len(early) >= length:
        return early[:length]
    return np.concatenate([early, tokens[is_late]])[:length] if whole else None


def is_in(tokens: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(tokens), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, tokens), len(ascending) - 1)] == tokens


def with_prefix(docs: DataFrame, size: int, percent: int, words) -> DataFrame:
    """``doc_id, hash, n, class, prefix, second, third``: the prefixes under all orders, 32 bits of each token under the last two.

    That under order 1 goes by the common words alone and is half as long again, for tokens that turn out to be shared.
    """

    def make():
        shingler = Shingler(size, words.value)

        def run(batch):
            out = {"n": [], "class": [], "prefix": [], "second": [], "third": []}
            for text in bytes_of(batch):
                tokens = shingler.tokens(text)
                length = prefix_length(len(tokens), percent)
                out["n"].append(len(tokens))
                out["class"].append(_class_of(tokens))
                out["prefix"].append(tokens[: length + (length >> 1) + SPARE])
                out["second"].append(first_under(tokens, 1, length))
                out["third"].append(first_under(tokens, 3, length))
            return out

        return run

    keep = [("doc_id", "doc_id"), ("hash", "hash"), ("text", "text")]
    return per_row(named(docs), make, keep, "n long, class binary, prefix array<long>, second array<int>, third array<int>")


def late_last(rows: DataFrame, percent: int, late) -> DataFrame:
    """``rows`` of :func:`with_prefix` with the prefix under order 1; NULL where its text is needed for that."""
    find_package(rows.sparkSession)

    def run(batches):
        for batch in slices(batches, 2048):
            held = batch.column("prefix")
            at = held.offsets.to_numpy()
            tokens, at = held.values.to_numpy()[at[0] : at[-1]], at - at[0]
            is_late, out = is_in(tokens, late.value), []
            for n, begin, end in zip(batch.column("n").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                out.append(front(tokens[begin:end], is_late[begin:end], prefix_length(n, percent), end - begin == n))
            yield batch.set_column(batch.schema.get_field_index("prefix"), "prefix", pa.array(out, type=pa.list_(pa.int64())))

    return rows.mapInArrow(tidy(run), rows.schema)


def from_texts(classes: DataFrame, texts: Texts, size: int, percent: int, words, late) -> DataFrame:
    """``classes`` with the prefix under order 1, from their texts."""

    def run(batches):
        shingler = Shingler(size, words.value)
        for batch in slices(batches):
            found = [shingler.tokens(text) for text in bytes_of(batch)]
            out = [front(t, is_in(t, late.value), prefix_length(len(t), percent), True) for t in found]
            batch = batch.drop_columns(["text"])
            yield batch.set_column(batch.schema.get_field_index("prefix"), "prefix", pa.array(out, type=pa.list_(pa.int64())))

    # Rows that repeat id and text come as often as they are there.
    return texts.join(classes, "cid", "text").mapInArrow(tidy(run), classes.schema).dropDuplicates(["cid"])


def named(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and a hash of the text, which tells rows that repeat an id apart."""
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    return rows.withColumn("hash", F.xxhash64("text"))


def shared_tokens(prefixes: DataFrame, percent: int, long_list: int, most: int) -> np.ndarray:
    """Tokens in more than ``long_list`` prefixes, ascending; the commonest ``most`` if there are more."""
    own = F.slice("prefix", 1, F.expr(f"CAST(n - ({percent} * n + 99) div 100 + 1 AS INT)"))  # prefix_length
    counts = prefixes.select(F.explode(own).alias("token")).groupBy("token").agg(F.count("*").alias("c"))
    top = counts.where(F.col("c") > long_list).orderBy(F.desc("c"), "token").limit(most).select("token")
    return np.sort(top.toArrow()["token"].to_numpy())


def viable(percent: int) -> Column:
    """Lengths allow the similarity, and so do the places of the shared token (in a.pos, b.pos of a.n, b.n)."""
    n, m = F.col("a.n"), F.col("b.n")
    rest = F.least(n - F.col("a.pos"), m - F.col("b.pos"))
    return (100 * n >= percent * m) & (100 * m >= percent * n) & ((100 + percent) * rest >= percent * (n + m))


def candidates(classes: DataFrame, percent: int, long_list: int) -> tuple[DataFrame, DataFrame]:
    """(pairs ``x, y`` of class numbers with x < y, members ``leader, cid, n`` of the long lists).

    Lists of one class never leave the exchange on the token; counting a list and taking its rows share it.
    """
    postings = classes.select("cid", "n", F.posexplode("prefix").alias("pos", "token")).repartition("token")
    counts = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    lists = stored(postings.join(counts, "token"), "lists")
    short = lists.where(F.col("c") <= long_list)
    pairs = short.alias("a").join(short.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.cid") < F.col("b.cid")) & viable(percent))
    pairs = pairs.select(F.col("a.cid").alias("x"), F.col("b.cid").alias("y"))
    # The member that shares most of its prefix leads: it leads most lists of its neighbourhood.
    shared = lists.groupBy("cid").agg(F.count("*").alias("shared"))
    long = lists.where(F.col("c") > long_list).join(shared, "cid")
    lead = long.groupBy("token").agg(F.max(F.struct("shared", (-F.col("cid")).alias("back"), "n", "pos")).alias("l"))
    lead = lead.select("token", (-F.col("l.back")).alias("cid"), "l.n", "l.pos")
    met = long.alias("a").join(lead.alias("b"), F.col("a.token") == F.col("b.token"))
    members = stored(met.select(F.col("b.cid").alias("leader"), F.col("a.cid").alias("cid"), F.col("a.n").alias("n")).distinct(), "members")
    star = met.where((F.col("a.cid") != F.col("b.cid")) & viable(percent))
    star = star.select(F.least("a.cid", "b.cid").alias("x"), F.greatest("a.cid", "b.cid").alias("y"))
    return stored(pairs.unionByName(star).distinct(), "pairs"), members


def bits_of(ids: DataFrame, slot: Column) -> DataFrame:
    """``w, b``: a bitmap with the slots of all rows set, in words of 64; as many rows at most as it has words."""
    words = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
    return words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(s & 63 AS INT))")).alias("b"))


class Texts:
    """Texts of the ``needed`` classes (``cid, stands, hash``), to be joined to rows that name a class.

    A bitmap over the rows that stand for them keeps other texts out; what it lets through by chance
    the joins drop. Rows that repeat id and text come through as often as they are there.
    """

    def __init__(self, docs: DataFrame, needed: DataFrame, bits: int):
        slot = F.pmod(F.xxhash64(F.col("doc_id"), F.col("hash")), F.lit(bits)).cast("long")
        self.needed = stored(needed.select("cid", "stands", "hash"), "needed")
        of_needed = self.needed.select(F.col("stands").alias("doc_id"), "hash")
        bitmap = F.broadcast(bits_of(of_needed, slot))
        rows = named(docs).withColumn("slot", slot).join(bitmap, F.shiftright("slot", 6) == F.col("w"))
        self.kept = stored(rows.where(F.expr("shiftright(b, CAST(slot & 63 AS INT)) & 1 = 1")).select("doc_id", "text", "hash"), "texts")

    def join(self, rows: DataFrame, cid: str, name: str) -> DataFrame:
        """``rows`` with the text of the class in column ``cid`` as ``name``: one shuffle of the texts."""
        want = self.needed.select(F.col("cid").alias("_cid"), F.col("stands").alias("_stands"), F.col("hash").alias("_want"))
        found = rows.join(want, F.col(cid) == F.col("_cid"))
        kept = self.kept.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.col("text").alias(name))
        met = found.join(kept, (F.col("_want") == F.col("_hash")) & F.col("_stands").eqNullSafe(F.col("_id")))
        return met.select(*rows.columns, name)


def agreed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The candidates whose prefixes meet under orders 2 and 3 as well. Prefixes travel, texts do not."""
    prefixes = classes.select("cid", "second", "third")
    a, b = (prefixes.select(*(F.col(c).alias(f"{c}_{side}") for c in prefixes.columns)) for side in "xy")
    both = pairs.join(a, F.col("x") == F.col("cid_x")).join(b, F.col("y") == F.col("cid_y"))
    return both.where(F.arrays_overlap("second_x", "second_y") & F.arrays_overlap("third_x", "third_y")).select("x", "y")


def verified(pairs: DataFrame, texts: Texts, size: int, percent: int, words) -> DataFrame:
    """The pairs that are similar indeed."""
    met = texts.join(texts.join(pairs, "x", "a"), "y", "b")

    def run(batches):
        shingler = Shingler(size, words.value)
        known: dict[int, np.ndarray] = {}

        def tokens(cid, text):
            if cid not in known:
                if len(known) >= 512:
                    known.clear()
                known[cid] = shingler.tokens(text)
            return known[cid]

        for batch in slices(batches, 256):
            rows = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), bytes_of(batch, "a"), bytes_of(batch, "b"))
            keep = [similar(tokens(x, one), tokens(y, other), percent) for x, y, one, other in rows]
            yield batch.select(["x", "y"]).filter(pa.array(keep, type=pa.bool_()))

    return met.mapInArrow(tidy(run), "x long, y long")


def meet(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common tokens of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    return int(np.count_nonzero(b[place] == a))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = meet(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node: the smallest node it is connected with.

    Every round each node takes the smallest root among its own and its neighbours', then its root's
    root; rounds are written tables, and their number grows with the logarithm of a group's width
    for all but odd shapes.
    """
    both = links.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(links.select(F.col("y").alias("u"), F.col("x").alias("v")))
    edges = stored(both.distinct(), "edges")
    roots = stored(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")), "roots")
    for k in count(1):
        near = edges.join(roots, edges["v"] == roots["node"]).groupBy("u").agg(F.min("root").alias("near"))
        taken = roots.join(near, roots["node"] == near["u"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = roots.select(F.col("node").alias("at"), F.col("root").alias("up"))
        new = stored(taken.join(up, F.col("root") == F.col("at"), "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        roots = new.select("node", "root")
        if new.where("old <> root").isEmpty():
            return roots
        if k % ROUNDS == 0:
            let_finished_go(links.sparkSession)


def _forest(x: list, y: list, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks of (cid, root, tokens), groups they have already taken as one."""
    if not x or not y:
        return []
    tx, ty = np.concatenate([t for _, _, t in x]), np.concatenate([t for _, _, t in y])
    common = np.intersect1d(tx, ty)

    def marks(rows, flat):
        sizes = np.array([len(t) for _, _, t in rows])
        place = np.minimum(np.searchsorted(common, flat), max(0, len(common) - 1))
        hit = common[place] == flat if len(common) else np.zeros(len(flat), dtype=bool)
        out = np.zeros((len(rows), len(common)), dtype=np.float32)
        out[np.repeat(np.arange(len(rows)), sizes)[hit], place[hit]] = 1
        return out, sizes

    (mx, nx), (my, ny) = marks(x, tx), marks(y, ty)
    both = (mx @ my.T).astype(np.int64)
    parent: dict[int, int] = {}

    def top(v):
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    out = []
    for i, j in zip(*np.nonzero(100 * both >= percent * (nx[:, None] + ny[None, :] - both))):
        a, b = top(x[i][1]), top(y[j][1])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x[i][0], y[j][0]))
    return out


def unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``leader, cid, n, root, open``: lists in which some member is outside its leader's group; open says which."""
    of = roots.select(F.col("node").alias("cid"), "root")
    lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("lead_root"))
    known = members.join(of, "cid", "left").join(lead, "leader", "left")
    known = known.select("leader", "cid", "n", F.coalesce("root", "cid").alias("root"), F.coalesce("lead_root", "leader").alias("lead_root"))
    known = stored(known.select("leader", "cid", "n", "root", (F.col("root") != F.col("lead_root")).alias("open")), "known")
    return known.join(known.where("open").select("leader").distinct(), "leader", "left_semi")


def able(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of ``lists`` that meet another one, one of the two open, under order 2 and under order 3.

    Tokens are counted per list, before the shuffle, so no list is held and no pairs are made.
    """
    out = lists
    for order in ("second", "third"):
        rows = out.join(classes.select("cid", order), "cid").select("leader", "cid", "open", F.explode(F.array_distinct(order)).alias("token"))
        counts = rows.groupBy("leader", "token").agg(F.count("*").alias("c"), F.bool_or("open").alias("any"))
        meeting = rows.join(counts.where((F.col("c") > 1) & F.col("any")).select("leader", "token"), ["leader", "token"], "left_semi")
        out = out.join(meeting.select("leader", "cid").distinct(), ["leader", "cid"], "left_semi")
    return out.select(*lists.columns)


def block_links(lists: DataFrame, texts: Texts, size: int, percent: int, words, block_tokens: int) -> DataFrame:
    """Links ``x, y`` of the open members of lists with any member of their list.

    Open members and all members are dealt into blocks of bounded size by a hash; each pair of an open
    block and a block meets in one group. A list that fits one block travels once.
    """
    opened = F.sum(F.when(F.col("open"), F.col("n")))
    many = lambda total: F.ceil(total / F.lit(block_tokens)).cast("long")
    sizes = lists.groupBy("leader").agg(many(opened).alias("nx"), many(F.sum("n")).alias("ny"))
    rows = lists.join(sizes, "leader")
    mine = lambda count: F.pmod(F.xxhash64("cid"), F.col(count))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    one = (F.col("nx") == 1) & (F.col("ny") == 1)
    among = rows.select("leader", each("nx").alias("bx"), mine("ny").alias("by"), "cid", "root", (F.col("open") & one).alias("left"), F.lit(True).alias("right"))
    more = rows.where(F.col("open") & ~one)
    more = more.select("leader", mine("nx").alias("bx"), each("ny").alias("by"), "cid", "root", F.lit(True).alias("left"), F.lit(False).alias("right"))

    def run(table: pa.Table) -> pa.Table:
        shingler = Shingler(size, words.value)
        rows = [(r["cid"], r["root"], shingler.tokens(r["text"].encode()), r["left"], r["right"]) for r in table.to_pylist()]
        found = _forest([r[:3] for r in rows if r[3]], [r[:3] for r in rows if r[4]], percent)
        return pa.table([pa.array(c, type=pa.int64()) for c in ([a for a, _ in found], [b for _, b in found])], names=["x", "y"])

    met = texts.join(among.unionByName(more), "cid", "text")
    return met.groupBy("leader", "bx", "by").applyInArrow(run, "x long, y long")


def groups(docs: DataFrame, size: int = 5, percent: int = 80, long_list: int = LONG_LIST, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``; the id is the smallest of the row's group."""
    return _grouped(docs, size, percent, long_list, block_tokens).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, size: int, percent: int, long_list: int = LONG_LIST, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The same with the ``hash`` of the text and the ``root`` of the group, which tells groups that share an id apart; NULL without shingles."""
    spark = docs.sparkSession
    find_package(spark)
    words = spark.sparkContext.broadcast(common_words(docs))
    with scratch_space(spark, "prefixes") as path:
        with_prefix(docs, size, percent, words).write.parquet(path)
        full = spark.read.parquet(path)
        late = spark.sparkContext.broadcast(shared_tokens(full, percent, long_list, MOST_SHARED))
        each = late_last(full.where("n > 0"), percent, late).dropDuplicates(["class"]).withColumn("cid", F.monotonically_increasing_id())
        classes = stored(each.withColumnRenamed("doc_id", "stands"), "classes")
        rows = stored(full.select("doc_id", "hash", "n", "class"), "rows")
    let_finished_go(spark)

    def texts(cids: DataFrame) -> Texts:
        return Texts(docs, classes.select("cid", "stands", "hash").join(cids.distinct(), "cid"), FILTER_BITS)

    short = classes.where("prefix IS NULL")
    if not short.isEmpty():
        reached = stored(from_texts(short, texts(short.select("cid")), size, percent, words, late), "reached")
        classes = classes.where("prefix IS NOT NULL").unionByName(reached)
    pairs, members = candidates(classes, percent, long_list)
    let_finished_go(spark)
    pairs = stored(agreed(pairs, classes), "agreed")
    ends = pairs.select(F.col("x").alias("cid")).unionByName(pairs.select(F.col("y").alias("cid")))
    links = stored(verified(pairs, texts(ends), size, percent, words), "links")
    let_finished_go(spark)
    roots = components(links)
    let_finished_go(spark)
    lists = stored(able(stored(unsettled(members, roots), "unsettled"), classes), "able")
    if not lists.isEmpty():
        more = stored(block_links(lists, texts(lists.select("cid")), size, percent, words, block_tokens), "more-links")
        let_finished_go(spark)
        roots = components(links.unionByName(more))
        let_finished_go(spark)
    least = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    own = classes.select("cid", "class").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    placed = own.select("class", F.coalesce("root", "cid").alias("root")).join(least, "class")
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = placed.select("class", "root").join(first, "root").select("class", "root", "component_id")
    out = rows.select("doc_id", "hash", "n", "class").join(of_class, "class", "left")
    return out.select("doc_id", "hash", "root", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One text of each group, that of the smallest id (any id before null), with all columns.

    Rows go by id and text: those that repeat both, of the row that stays, all stay.
    """
    out = stored(_grouped(docs, size, percent).where("root IS NOT NULL").select("doc_id", "hash", "root"), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    stays = out.groupBy("root").agg(F.min(order).alias("stays"))
    gone = out.join(stays, "root").where(~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("hash") == F.col("stays.hash"))))
    dropped, text_hash = fresh(docs, "dropped", "text_hash")
    gone = gone.select(F.col("doc_id").alias(dropped), F.col("hash").alias(text_hash)).distinct()
    same = column("doc_id").eqNullSafe(F.col(dropped)) & (F.xxhash64(column("text")) == F.col(text_hash))
    return docs.join(gone, same, "left_anti")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir), size=3, percent=90)
