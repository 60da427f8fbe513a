"""op11: nodes against a plain trie, its SQL, deep conversations, odd rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle_check import compare
from touchline.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k int, parent string, pos string, steps int"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    """Nodes of the rebuilt conversations by brute force."""
    convs = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            convs[conv_id].append((turn is not None, turn or 0, turn_key(role, text), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = {}
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    for seq in sorted(members, key=len, reverse=True):
        kids = children[seq]
        ends = ",".join(map(str, sorted(c for c in members[seq] if len(built[c]) == len(seq))))
        out[seq] = (min(members[seq]), len(seq), min(members[seq[:-1]]) if seq else None, len(members[seq]), len(kids), sum(out[k][5] for k in kids) if kids else 1,
                    sum(out[k][6] for k in kids) + ((len(members[seq]) - 1) * len(seq[-1][1]) if seq else 0), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, *("x", 1, "y", "z", 2))[:9] for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(trie.with_shared_heads(trie.turns(df))).collect()), key=str)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for c in [0, 1, 2, 5, 99, 100, 101, 230, 231, 305, -4, -100]:
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é" * 3])))
    rows += [(None, 0, "user", "nobody"), (7, None, "user", "first"), (7, None, "user", "first"), (7, 0, None, None), (7, 0, "x", "tie"), rows[0], rows[0]]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 440) for t in range(6)]
    assert found(spark, rows) == plain(rows)


def test_deep_conversations(spark):
    """Bands: a lone deep conversation, copies of one, two that part late, one that ends within another's chain, a node that comes up into a band."""
    def talk(c, n, word):
        return [(c, t, "user", f"{word}{t}") for t in range(n)]

    rows = talk(1, 90, "a") + talk(2, 75, "b") + talk(3, 75, "b") + talk(4, 70, "c") + talk(5, 69, "c") + talk(6, 40, "c") + [(4, 69, "user", "other")] + talk(9, 3, "a") + talk(12, 20, "d")
    rows += [r for c in (701, 702, 703) for r in talk(c, 33, "e")] + [(703, 33, "user", "more"), (704, 0, "user", "z")]
    assert found(spark, rows) == plain(rows)


def test_no_conversations(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


def test_a_hot_sequence(spark):
    """Thousands of equal conversations: one record after the first merge; their ids span several chunks."""
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 10000) for t in range(2)] + [(c, 0, "user", f"u{c}") for c in range(20)]
    assert found(spark, rows, 8) == plain(rows)


def test_chunks_are_hashed_in_the_order_of_their_ids(spark):
    ids = [-5000, -4097, -4096, -1, 0, 4095, 4096, 12000]
    paths = spark.createDataFrame([(c, 0, [((1, 2), 0)]) for c in ids] + [(c, 1, [((1, 2), 0), ((c, 4), 3)]) for c in (1, 2)],
                                  "conv_id long, depth int, steps array<struct<k: struct<a: bigint, b: bigint>, chars: bigint>>").repartition(4)
    got = {(r.depth, r.k.a): r.ends_sha256 for r in trie.end_digests(paths).collect()}
    assert got[0, 1] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1, 2] == hashlib.sha256(b"2").hexdigest() and len(got) == 3


def test_last_turns(spark):
    rows = trie.turns(spark.createDataFrame([(1, 0, "u", "abc"), (2, 0, "u", "abc"), (2, 1, "u", "de")], "conv_id long, turn long, role string, text string"))
    rows = rows.unionByName(rows.select("conv_id").distinct().select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")))
    nodes = trie.last_turns(trie.prefix_trie(rows), rows)
    assert sorted((r.conv_id, r.depth, r.chars) for r in nodes.collect()) == [(1, 0, 0), (1, 1, 3), (2, 2, 2)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '/root/testdata/{sf}/conversations.parquet'")
    assert compare(queries.QUERIES["op11_prefix_trie"](spark, f"/root/testdata/{sf}"), con, queries.ORACLES["op11_prefix_trie"]) is None
