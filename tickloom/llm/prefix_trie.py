"""Prefix trie of conversations, built by van Emde Boas recursion over depths.

Every conversation is a sequence of turns, and every distinct beginning of one is a node. The sequences
are not walked turn by turn. A range of depths is cut at its half: what a sequence holds of the upper half
is its cut prefix, and gets a name made of the name of the node above and of these turns. Equal cut
prefixes become one sequence of the upper trie, with their conversations added up; what follows below a
name is the lower forest of that name. All tries and forests are then cut in the same way, at once, until
ranges hold one depth, where sequences are single turns, so nodes. A depth is the cut of one round only,
so a node has one name, whichever sequence it is reached by.

Totals over subtrees are grafted upward, widest cut first: the total of a lower forest is added to the node
it hangs from. That node ends its upper trie, so the next round takes it into the total of its own forest.
After one round for each halving every node holds the total of all below it.

No group is held whole. Turns are numbered by ranges that split a long conversation, and lie in blocks of at
most ``BLOCK`` turns. Ranges wider than a block are cut over rows, one a block, by combined hashes; narrower
ones over the arrays of the blocks. Conversations that end at a node are listed by parts, and the digest takes
the parts in turn as they stream by. Names are 128-bit digests. Rounds are written tables in the shared folder.

Turns are ordered by number, null first; equal numbers go by a digest of role and text. Null role or text is
empty. Rows without ``conv_id`` belong to no conversation and are left out; repeated rows are turns of their
own. Without conversations there is no node. Only the four columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickloom.llm.common import column, stored

#: Depths that one row holds at most; a power of two.
BLOCK = 64
ROOT = ""
#: Turns of conversation c - c % 5 that c may begin with.
MOST_BORROWED = 8


def in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, at, turn_key``: turns in order of ``at``, those of a conversation without gaps within a part.

    A turn's key is a digest of role and text, and the bytes of the text. Texts themselves do not move.
    """
    role, text = F.coalesce(column("role"), F.lit("")), F.coalesce(column("text"), F.lit(""))
    key = F.concat_ws(":", F.md5(F.concat_ws(":", F.length(role), role, text)), F.octet_length(text))
    rows = conversations.where(column("conv_id").isNotNull())
    rows = rows.select(column("conv_id").cast("long").alias("conv_id"), column("turn").alias("turn"), key.alias("turn_key"))
    rows = rows.withColumn("copy", F.monotonically_increasing_id())  # so that ranges can split repeated rows
    order = ["conv_id", F.asc_nulls_first("turn"), "turn_key", "copy"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return stored(rows.select("conv_id", F.shiftright(at, 33).alias("part"), at.alias("at"), "turn_key"), "turns")


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, part, before, first`` of each part of a conversation, ``conv_id, n_own``) for turns as above."""
    spans = stored(turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n")), "spans")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # parts, not turns
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")))
    return spans.drop("n"), spans.groupBy("conv_id").agg(F.sum("n").alias("n_own"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, n, pos, turn_key``, ``conv_id, n``): conversations that begin as another one does.

    c takes the first h turns of c - c % 5, then its own after the first h; h = crc32(c) % 9. ``pos`` counts from 1.
    """
    turns = in_order(conversations)
    spans, sizes = numbered(turns)
    own = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_BORROWED + 1))
    bases = sizes.select(F.col("conv_id").alias("base"), F.least("n_own", F.lit(MOST_BORROWED)).alias("n_base"))
    own = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    n = F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    convs = stored(own.select("conv_id", "base", "h", "taken", n.alias("n")), "convs")
    placed = turns.join(spans, ["conv_id", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)
    placed = placed.select("conv_id", "pos", "turn_key")
    rest = placed.join(convs, "conv_id").where("pos > h")
    rest = rest.select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_key")
    heads = placed.where((F.col("conv_id") % 5 == 0) & (F.col("pos") <= MOST_BORROWED)).withColumnRenamed("conv_id", "base")
    taken = convs.join(heads, "base").where("pos <= h").select("conv_id", "n", "pos", "turn_key")
    return rest.unionByName(taken), convs.select("conv_id", "n")


def name_of(top: Column, turns: Column) -> Column:
    """The name of the node that ``turns`` lead to from ``top``."""
    return F.md5(F.concat_ws(",", top, turns))


def cut_rows(blocks: DataFrame, most: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Cuts at multiples of ``BLOCK``: (blocks with ``top`` and ``path``, ``conv_id, b, end`` of full blocks, widths).

    ``blocks`` are those of conversations with a full block; ``most`` is the largest number of full ones. The
    turns of a cut prefix are combined as hashes of its blocks and their places, so a long one is an aggregate too.
    """
    full = F.size("turns") == BLOCK
    rows = blocks.select("conv_id", "b", full.alias("full"), F.md5(F.array_join("turns", ",")).alias("digest"), F.lit(ROOT).alias("top"), no_path().alias("path"))
    ends, widths, width = [], [], 1 << most.bit_length()
    while width > 1:
        half = width // 2
        rows = rows.withColumn("r", F.floor(F.col("b") / width))
        upper = F.col("b") % width < half
        one, other = (F.bit_xor(F.when(F.col("full"), F.xxhash64(F.lit(i), "b", "digest"))) for i in (1, 2))
        cut = rows.where(upper).groupBy("conv_id", "r").agg(F.any_value("top").alias("above"), F.count_if("full").alias("c"), one.alias("x"), other.alias("y"))
        cut = stored(cut.where(F.col("c") == half).select("conv_id", "r", name_of(F.col("above"), F.concat_ws(",", "x", "y")).alias("name")), "cuts")
        ends.append(cut.select("conv_id", (F.col("r") * width + half - 1).alias("b"), F.col("name").alias("end")))
        lower = rows.where(~upper).join(cut, ["conv_id", "r"])
        lower = lower.withColumns({"top": F.col("name"), "path": below("path", BLOCK * width, "name")}).drop("name")
        rows = stored(rows.where(upper).unionByName(lower).drop("r"), "block-tops")
        widths.append(BLOCK * width)
        width = half
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return rows.select("conv_id", "b", "top", "path"), out, widths


def no_path() -> Column:
    return F.array().cast("array<struct<width:bigint,name:string>>")


def below(path: str, width: int, name: str) -> Column:
    """``path``, the cut prefixes below which something lies, with that of one more width."""
    return F.concat(path, F.array(F.struct(F.lit(width).cast("long").alias("width"), F.col(name).alias("name"))))


def cut_arrays(pieces: DataFrame, width: int) -> DataFrame:
    """One round: pieces ``top, lo, turns, end, path, conv_id, n_convs`` of a width cut in halves, equal ones joined."""
    half = width // 2
    named = pieces.withColumn("name", F.when(F.size("turns") >= half, name_of(F.col("top"), F.array_join(F.slice("turns", 1, half), ","))))
    upper = F.struct("top", "lo", F.slice("turns", 1, half).alias("turns"), F.col("name").alias("end"), "path")
    lower = F.struct(
        F.col("name").alias("top"), (F.col("lo") + half).alias("lo"), F.slice("turns", half + 1, half).alias("turns"), "end", below("path", width, "name").alias("path")
    )
    both = F.when(F.size("turns") > half, F.array(upper, lower)).otherwise(F.array(upper))
    cut = named.select("conv_id", "n_convs", F.inline(both))
    return cut.groupBy("top", "turns").agg(
        F.any_value("lo").alias("lo"),
        F.any_value("end").alias("end"),
        F.any_value("path").alias("path"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
    )


def last_name(width: int) -> Column:
    """The name of the node that ``turns``, fewer than ``width``, lead to from ``top``: the cuts that they reach."""
    halves = F.array(*(F.lit(width >> k) for k in range(1, width.bit_length())))

    def step(at: Column, half: Column) -> Column:
        there = name_of(at["top"], F.array_join(F.slice(at["rest"], F.lit(1), half), ","))
        rest = F.slice(at["rest"], half + 1, F.lit(width))
        return F.when(F.size(at["rest"]) >= half, F.struct(there.alias("top"), rest.alias("rest"))).otherwise(at)

    return F.aggregate(halves, F.struct(F.col("top").alias("top"), F.col("turns").alias("rest")), step)["top"]


def grafted(nodes: DataFrame, widths: list[int]) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved`` of each one's subtree; ``widths`` of the cuts, widest first."""
    done: DataFrame | None = None
    for width in widths:
        above = F.get(F.filter("path", lambda p: p["width"] == width), F.lit(0))["name"].alias("above")
        own = nodes.where(F.col("depth") % width != 0).select(above, "n_leaves", "saved")
        if done is not None:  # nodes that end a lower forest, with all that hangs from them
            own = own.unionByName(done.where(F.col("depth") % width == 0).select(above, "n_leaves", "saved"))
        sums = own.where("above IS NOT NULL").groupBy("above").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        cut = nodes.where(F.col("depth") % width == width // 2).join(sums, F.col("name") == F.col("above"), "left")
        add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        kept = [add(c, f"more_{c.removeprefix('n_')}") if c in ("n_leaves", "saved") else c for c in nodes.columns]
        cut = stored(cut.select(*kept), "grafts")
        done = cut if done is None else done.unionByName(cut)
    return done


def ends_digest(ends: DataFrame) -> DataFrame:
    """``name, ends_sha256`` of the conversations (``name, conv_id``) that end at each node, ids ascending, joined by commas."""

    def listed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            names, ids = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()
            out, start = [], 0
            for i in range(1, len(names) + 1):
                if i == len(names) or names[i] != names[start]:
                    out.append((names[start], ids[start], ",".join(map(str, ids[start:i]))))
                    start = i
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], type=t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["name", "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]):
        name, state = None, None
        for batch in batches:
            out = []
            for new, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if new == name:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((name, state.hexdigest()))
                name, state = new, sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], type=pa.string()) for k in (0, 1)], names=["name", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])

    parts = ends.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    parts = parts.mapInArrow(listed, "name string, first long, ids string")
    return parts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digested, "name string, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of ``turns`` (``conv_id, n, pos, turn_key``) of ``convs`` (``conv_id, n``), n turns each.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    least, many, most = convs.agg(F.min("conv_id"), F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    width = min(BLOCK, max(2, 1 << most.bit_length()))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "turn_key"))), lambda t: t["turn_key"])
    by_block = turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / BLOCK).alias("b"))
    blocks = stored(by_block.agg(F.any_value("n").alias("n"), ordered.alias("turns")), "blocks")
    whole = ["conv_id", "n", "b", "top", "path", "turns", "end"]
    pieces = blocks.where(F.col("n") < BLOCK).withColumns({"top": F.lit(ROOT), "path": no_path(), "end": F.lit(None).cast("string")}).select(*whole)
    widths = []
    if most >= BLOCK:
        long = blocks.where(F.col("n") >= BLOCK)
        tops, ends, widths = cut_rows(long, most // BLOCK)
        long = long.join(tops, ["conv_id", "b"]).join(ends, ["conv_id", "b"], "left")
        pieces = pieces.unionByName(long.select(*whole))
    pieces = stored(pieces.withColumn("lo", F.col("b") * BLOCK), "pieces")
    last = pieces.where(F.col("lo") + F.size("turns") == F.col("n"))
    last = last.select("conv_id", F.when(F.size("turns") == BLOCK, F.col("end")).otherwise(last_name(width)).alias("name"))
    ends = ends_digest(last.unionByName(convs.where("n = 0").select("conv_id", F.lit(ROOT).alias("name"))))
    pieces = pieces.withColumn("n_convs", F.lit(1).cast("long"))
    while width > 1:
        pieces = cut_arrays(pieces, width)
        widths.append(width)
        width //= 2
    nodes = stored(
        pieces.select(
            F.col("end").alias("name"),
            F.col("top").alias("parent"),
            (F.col("lo") + 1).alias("depth"),
            "path",
            "conv_id",
            "n_convs",
            ((F.col("n_convs") - 1) * F.substring_index(F.col("turns")[0], ":", -1).cast("long")).alias("saved"),
        ),
        "nodes",
    )
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children"))
    own = nodes.join(children.withColumnRenamed("parent", "name"), "name", "left")
    own = own.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = stored(own.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "own-totals")
    done = grafted(own, widths)
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    first = done.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long"))
    out = first.unionByName(done.where("depth > 1").join(parents, "parent").select(*first.columns))
    total = own.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    root = total.where(F.lit(many > 0)).withColumns(
        {"name": F.lit(ROOT), "conv_id": F.lit(least).cast("long"), "depth": F.lit(0).cast("long"), "parent_conv_id": F.lit(None).cast("long"), "n_convs": F.lit(many).cast("long")}
    )
    kept = ["name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    out = out.select(*kept).unionByName(root.select(*kept)).join(ends, "name", "left")
    return out.select(*kept[1:-1], F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: The checksum goes bit by bit over the digits; nodes are the distinct lists of first turns.
OP13_SQL = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, s, 0 AS k, CAST(4294967295 AS UBIGINT) AS v FROM ids
  UNION ALL
  SELECT c, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END
  FROM (SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(s, CAST(k // 8 + 1 AS BIGINT), 1)) AS UBIGINT)) ELSE v END AS x
        FROM crc WHERE k < 8 * length(s))
),
convs AS (SELECT c, c - c % 5 AS base, CAST(xor(v, CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h FROM crc WHERE k = 8 * length(s)),
keyed AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, ':', text))) AS pos FROM keyed
),
turns AS (
  SELECT v.c, 0 AS own, p.pos, p.role, p.text FROM convs v JOIN placed p ON p.c = v.base AND p.pos <= v.h
  UNION ALL
  SELECT v.c, 1, p.pos, p.role, p.text FROM convs v JOIN placed p ON p.c = v.c AND p.pos > v.h
),
chains AS (
  SELECT c, row_number() OVER w AS d, list(struct_pack(r := role, t := text)) OVER (w ROWS UNBOUNDED PRECEDING) AS chain, strlen(text) AS bytes
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY own, pos)
),
named AS (SELECT c, d, bytes, min(c) OVER (PARTITION BY chain) AS node, count(*) OVER (PARTITION BY chain) AS members FROM chains),
nodes AS (
  SELECT DISTINCT node, d, bytes, members FROM named
  UNION ALL
  SELECT (SELECT min(c) FROM convs), 0, 0, (SELECT count(*) FROM convs) WHERE EXISTS (FROM convs)
),
up AS (SELECT c, d, node FROM named UNION ALL SELECT c, 0, (SELECT min(c) FROM convs) FROM convs),
deepest AS (SELECT c, max(d) AS d FROM up GROUP BY c),
parents AS (SELECT n.node, n.d, n.bytes, n.members, u.node AS parent FROM nodes n LEFT JOIN up u ON u.c = n.node AND u.d = n.d - 1),
children AS (SELECT parent AS node, d - 1 AS d, count(*) AS n FROM parents WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT p.*, coalesce(k.n, 0) AS n_children, (p.members - 1) * p.bytes AS saved FROM parents p LEFT JOIN children k ON k.node = p.node AND k.d = p.d
),
totals AS (
  SELECT u.node, u.d, sum(o.saved) AS saved, count(*) FILTER (WHERE o.n_children = 0) AS n_leaves
  FROM own o JOIN up u ON u.c = o.node AND u.d <= o.d GROUP BY ALL
),
ends AS (
  SELECT u.node, u.d, sha256(string_agg(CAST(e.c AS VARCHAR), ',' ORDER BY e.c)) AS digest FROM deepest e JOIN up u ON u.c = e.c AND u.d = e.d GROUP BY ALL
)
SELECT o.node AS conv_id, CAST(o.d AS BIGINT) AS depth, o.parent AS parent_conv_id, CAST(o.members AS BIGINT) AS n_convs,
       CAST(o.n_children AS BIGINT) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens,
       coalesce(e.digest, sha256('')) AS ends_sha256
FROM own o JOIN totals t ON t.node = o.node AND t.d = o.d LEFT JOIN ends e ON e.node = o.node AND e.d = o.d
"""
