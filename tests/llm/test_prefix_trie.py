"""The trie against plain dictionaries, and against SQL."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from compare import connection, difference

from tickloom.llm import prefix_trie as p
from tickloom.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string, n long, name string, depth string"


@pytest.fixture(scope="module")
def conversations(spark):
    """A table of (conv_id, turn, role, text) with clashing extra columns, written and read back."""

    def make(rows):
        df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
        return stored(df.repartition(3) if rows else df, "conversations")

    return make


def sequences(rows):
    """What each conversation is rebuilt to."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in by.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(sequences):
    """A plain trie: children by turn, nodes in order of their making, totals from the last node to the first."""
    if not sequences:
        return Counter()
    nodes = [{"parent": None, "depth": 0, "bytes": 0, "members": [], "ends": [], "kids": {}}]
    for c, s in sorted(sequences.items()):
        at = 0
        nodes[at]["members"].append(c)
        for turn in s:
            if turn not in nodes[at]["kids"]:
                nodes[at]["kids"][turn] = len(nodes)
                nodes.append({"parent": at, "depth": nodes[at]["depth"] + 1, "bytes": len(turn[1].encode()), "members": [], "ends": [], "kids": {}})
            at = nodes[at]["kids"][turn]
            nodes[at]["members"].append(c)
        nodes[at]["ends"].append(c)
    for x in nodes:
        x["leaves"], x["saved"] = int(not x["kids"]), (len(x["members"]) - 1) * x["bytes"]
    for x in reversed(nodes[1:]):
        up = nodes[x["parent"]]
        up["leaves"] += x["leaves"]
        up["saved"] += x["saved"]
    first = lambda k: None if k is None else nodes[k]["members"][0]
    return Counter(
        (x["members"][0], x["depth"], first(x["parent"]), len(x["members"]), len(x["kids"]), x["leaves"], x["saved"], sha256(",".join(map(str, x["ends"])).encode()).hexdigest())
        for x in nodes
    )


def got(out):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert out.columns == names
    return Counter(tuple(r) for r in out.collect())


def drawn(rng, convs, longest):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice("ua"), rng.choice(["", "a", "bb", "né"])))
    return rows


@pytest.mark.parametrize("block", [2, 4, 64])
def test_against_dictionaries(conversations, monkeypatch, block):
    monkeypatch.setattr(p, "BLOCK", block)
    rows = drawn(random.Random(block), range(120), 12)
    assert got(p.trie(*p.rebuilt(conversations(rows)))) == brute(sequences(rows))


def test_long_conversations(conversations):
    rng = random.Random(9)
    rows = [(c, t, "u", "same" if t < 200 else rng.choice("ab")) for c in range(20) for t in range(rng.choice([3, 63, 64, 65, 128, 300, 700]))]
    assert got(p.trie(*p.rebuilt(conversations(rows)))) == brute(sequences(rows))


def test_nulls_repeats_and_turnless(conversations):
    rows = [
        (0, 1, "u", "a"), (0, None, None, None), (0, 1, "u", "a"), (0, 0, "u", None),
        (None, 1, "u", "lost"), (-7, 1, "u", "a"), (-5, 2, "u", "b"), (-5, 1, "a", "c"),
        (3, 2, "x", "é" * 9), (10**15, 5, "u", "far"),
    ]
    rows += [(c, 0, "u", "hello") for c in range(1000, 1400, 2)]  # copies, and some of one own turn and no base
    want = brute(sequences(rows))
    assert any(not s for s in sequences(rows).values())
    assert got(p.trie(*p.rebuilt(conversations(rows)))) == want


def test_nothing_and_only_turnless(conversations):
    assert p.trie(*p.rebuilt(conversations([]))).count() == 0
    c = next(c for c in range(1, 100, 5) if zlib.crc32(str(c).encode()) % 9)
    rows = [(c, 0, "u", "a")]
    assert got(p.trie(*p.rebuilt(conversations(rows)))) == brute({c: []})


def test_one_conversation_holds_a_third(conversations):
    rows = [(5, t, "u", f"turn {t % 7}") for t in range(4000)] + [(c, t, "u", f"turn {t}") for c in range(6, 900) for t in range(9)]
    out = got(p.trie(*p.rebuilt(conversations(rows))))
    assert out == brute(sequences(rows))


def test_query_and_sql(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert got(p.op13_prefix_trie(spark, sf_dir)) == brute(sequences(rows))
    assert difference(spark, connection(sf_dir), p.op13_prefix_trie, p.OP13_SQL, sf_dir) is None
