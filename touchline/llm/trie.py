"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of the first d turns. The trie is never built from the top: peeling starts at the greatest
depth. In a round the conversations that end at the depth meet the nodes that came up from below, equal ones are merged
by an aggregate with partial results, the merged nodes are final (`n_convs`, `n_children`, `n_leaves`, `saved_tokens`
have been added up on the way), and each loses its last turn and goes on to the next round. So nodes are found and
aggregated in the same pass, and a round moves one row per node.

Long conversations rarely share more than their first turns, and a round for each depth would be a job for each of their
turns. Above `LEVELS` turns a round therefore peels a band of depths at once, (lo, 2 * lo]: a record that is alone below
its node of depth lo is a chain of nodes with the same members, written down without further rounds; records that share
their node of depth lo with others are peeled depth by depth.

A turn is identified by the SHA-256 of its length-prefixed role and its text, a sequence by two 64-bit exclusive-ors of
position-salted hashes of its turns (128 bits), so that texts are hashed where they are read and never shuffled. A
conversation is one row with 28 bytes per turn; that row must fit into memory. The only thing that cannot be split is the
SHA-256 over the ids that end at one node: it is a chain by definition. Ids are joined in chunks of 4,096 values by many
tasks, and one task at a time streams the chunks of a node through the hash.

Null roles and texts count as empty. Rows without an id are no conversation and take no part. Of turns with the same
number, the one with the smaller SHA-256 comes first; repeated rows are turns of their own. A null turn number comes
first. No conversation: no node, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.tables import result_of
from touchline.sinks.shared import written

LEVELS = 16
CHUNK_IDS = 4096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "k", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and code points of each turn, in the order of the turns."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return said.select("conv_id", F.row_number().over(order).alias("pos"), "digest", "chars")


def with_shared_heads(own: DataFrame, block: int = 100, longest: int = 6) -> DataFrame:
    """Every conversation rebuilt: the first h turns of the first conversation of its block, then its own turns after its
    first h; h is the CRC-32 of the decimal id modulo `longest`. A remainder has the sign of its id, as in SQL. Position 0
    stands for the conversation itself."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(longest)).cast("int")
    ids = own.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    heads = own.where(F.col("pos") < longest).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lengths = heads.groupBy("base").agg(F.count("*").cast("int").alias("of_base"))
    head = ids.join(heads, "base").where("pos <= h").select("conv_id", "pos", "digest", "chars")
    known = ids.join(lengths, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("of_base", F.lit(0))).alias("taken"))
    tail = own.join(known, "conv_id").where("pos > h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "digest", "chars")
    root = ids.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return root.unionByName(head).unionByName(tail)


def paths(turn_rows: DataFrame) -> DataFrame:
    """conv_id, depth and steps: for each depth from 0 the key of the sequence so far and the code points so far.

    `turn_rows` has a row of position 0 for each conversation.
    """
    def salted(*parts: Column | str) -> Column:
        return F.when(F.col("pos") > 0, F.xxhash64(*parts)).otherwise(F.lit(0).cast("long"))

    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = turn_rows.select("conv_id", "pos", "chars", salted("digest", "pos").alias("a"), salted("pos", F.lit("second"), "digest").alias("b"))
    rows = rows.select("conv_id", "pos", F.struct("pos", F.struct(F.bit_xor("a").over(so_far).alias("a"), F.bit_xor("b").over(so_far).alias("b")).alias("k"),
                                                  F.sum("chars").over(so_far).alias("chars")).alias("s"))
    steps = F.transform(F.array_sort(F.collect_list("s")), lambda s: F.struct(s["k"].alias("k"), s["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(steps.alias("steps")).select("conv_id", (F.size("steps") - 1).alias("depth"), "steps")


def _at(depth: Column | str, field: str) -> Column:
    return F.element_at("steps", (F.col(depth) if isinstance(depth, str) else depth) + 1)[field]


def _merged(records: DataFrame) -> DataFrame:
    """Records of equal sequences become one. Partial results are merged before the shuffle: a very common sequence is no hot spot."""
    return (records.withColumn("k", _at("depth", "k")).groupBy("depth", "k")
            .agg(F.first("steps").alias("steps"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]))


def _stripped(nodes: DataFrame, to: Column) -> DataFrame:
    return nodes.select(to.alias("depth"), F.slice("steps", F.lit(1), to + 1).alias("steps"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")


def _round(records: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of one depth, and what goes on to the next smaller one."""
    last = _at("depth", "chars") - F.coalesce(F.try_element_at("steps", F.col("depth"))["chars"], F.lit(0)) if depth else F.lit(0)
    nodes = written(_merged(records).select(
        "depth", "k", "steps", "conv_id", "n_convs", "n_children", F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * last).alias("saved_tokens")), f"trie-{depth}")
    parent = _at(F.col("depth") - 1, "k") if depth else F.lit(None).cast("struct<a:bigint,b:bigint>")
    return nodes.withColumn("parent", parent).select(*NODE), _stripped(nodes, F.lit(depth - 1)) if depth else nodes.limit(0)


def _chains(alone: DataFrame, lo: int) -> DataFrame:
    """All nodes deeper than `lo` of records that share none of them with another."""
    spread = alone.select("*", F.explode(F.sequence(F.lit(lo + 1), F.col("depth"))).alias("d"))
    below = _at("depth", "chars") - _at(F.col("d") - 1, "chars")
    ended = F.col("n_children") == 0
    return spread.select(
        "conv_id", F.col("d").alias("depth"), _at("d", "k").alias("k"), _at(F.col("d") - 1, "k").alias("parent"), "n_convs",
        F.when(F.col("d") < F.col("depth"), F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        F.when(ended, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * below).alias("saved_tokens"))


def _band(records: DataFrame, lo: int, hi: int) -> tuple[list[DataFrame], DataFrame]:
    """Peels the depths lo + 1 to hi; returns their nodes and what is left at depth lo."""
    records = written(records.withColumn("top", _at(F.lit(lo), "k")), f"trie-band-{lo}")
    tops = written(records.groupBy("top").agg(F.count("*").alias("n"), F.first(F.struct(*[c for c in records.columns if c != "top"])).alias("r")), f"trie-tops-{lo}")
    alone = tops.where("n = 1").select("r.*")
    saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * (_at("depth", "chars") - _at(F.lit(lo), "chars"))
    leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves"))
    left = _stripped(alone.withColumn("saved_tokens", saved).withColumn("n_leaves", leaves), F.lit(lo))
    nodes = [_chains(alone, lo)]
    crowd = records.join(tops.where("n > 1").select("top"), "top", "left_semi").drop("top")
    deepest = crowd.agg(F.max("depth")).first()[0]
    if deepest is not None:
        crowd, live = written(crowd, f"trie-crowd-{lo}"), None
        for depth in range(deepest, lo, -1):
            here = crowd.where(F.col("depth") == depth)
            found, live = _round(here if live is None else here.unionByName(live), depth)
            nodes.append(found)
        left = left.unionByName(live)
    return nodes, left


def peel(conv_paths: DataFrame) -> DataFrame:
    """All nodes of written `paths`, with their keys and their parents' keys."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = _merged(conv_paths.select("depth", "steps", "conv_id", one.alias("n_convs"), none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens")))
    band = F.when(F.col("depth") <= LEVELS, F.col("depth")).otherwise(F.lit(LEVELS) + F.ceil(F.log2(F.col("depth") / LEVELS)).cast("int"))
    ends = written(ends.drop("k").withColumn("band", band), "trie-ends", "band")
    deepest = ends.agg(F.max("depth")).first()[0]
    nodes: list[DataFrame] = []
    live: DataFrame | None = None

    def records(band: int) -> DataFrame:
        ended = ends.where(F.col("band") == band).drop("band")
        return ended if live is None else ended.unionByName(live)

    if deepest is None:
        return _round(ends.drop("band"), 0)[0]
    if deepest > LEVELS:
        top = ends.agg(F.max("band")).first()[0]
        for b in range(top, LEVELS, -1):
            lo = LEVELS << (b - LEVELS - 1)
            found, live = _band(records(b), lo, 2 * lo)
            nodes += found
    for depth in range(min(deepest, LEVELS), -1, -1):
        found, live = _round(records(depth), depth)
        nodes.append(found)
    out = nodes[0]
    for more in nodes[1:]:
        out = out.unionByName(more)
    return out


def end_digests(conv_paths: DataFrame) -> DataFrame:
    """depth, k and ends_sha256 of each sequence at which a conversation ends: the hash of their ids, ascending, comma-joined.

    A chunk holds the ids of one range of 4,096 values. The few nodes with more than one chunk are hashed chunk after chunk.
    """
    ids = conv_paths.select("depth", _at("depth", "k").alias("k"), "conv_id", F.floor(F.col("conv_id") / F.lit(CHUNK_IDS)).cast("long").alias("chunk"))
    joined = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")))
    chunks = written(ids.groupBy("depth", "k", "chunk").agg(joined.alias("ids")), "trie-ends-chunks")
    counted = chunks.groupBy("depth", "k").agg(F.count("*").alias("n"), F.first("ids").alias("ids"))
    short = counted.where("n = 1").select("depth", "k", F.sha2("ids", 256).alias("ends_sha256"))

    def task(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for depth, a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "ids"))):
                if at != (depth, a, b):
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _digests(out)
        if at is not None:
            yield _digests([(*at, state.hexdigest())])

    def _digests(rows):
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=["depth", "a", "b", "ends_sha256"])

    many = chunks.join(counted.where("n > 1").select("depth", "k"), ["depth", "k"], "left_semi").select("depth", F.col("k.a").alias("a"), F.col("k.b").alias("b"), "chunk", "ids")
    streamed = many.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "chunk").drop("chunk").mapInArrow(task, "depth int, a long, b long, ends_sha256 string")
    return short.unionByName(streamed.select("depth", F.struct("a", "b").alias("k"), "ends_sha256"))


def prefix_trie(turn_rows: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node of
    conversations given as turns (conv_id, pos, digest, chars; one row of position 0 each). The smallest member and the depth name a node."""
    spark = turn_rows.sparkSession

    def work() -> DataFrame:
        conv_paths = written(paths(turn_rows), "trie-paths")
        nodes = written(peel(conv_paths), "trie-nodes")
        ends = end_digests(conv_paths)
        above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        return (nodes.join(above, ["depth", "parent"], "left").join(ends, ["depth", "k"], "left")
                .select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))

    return result_of(spark, work, "trie")


def last_turns(nodes: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """Nodes with the columns of their last turn; the root has none."""
    return nodes.join(turn_rows.withColumnRenamed("pos", "depth"), ["conv_id", "depth"], "left")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = """
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
      lambda a, x: list_reduce(range(8), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(a, x)), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM said) z),
built AS (
  SELECT i.conv_id, s.pos, s.role, s.text FROM ids i JOIN said s ON s.conv_id = i.base AND s.pos <= i.h
  UNION ALL SELECT i.conv_id, 1000000 + s.pos, s.role, s.text FROM ids i JOIN said s ON s.conv_id = i.conv_id AND s.pos > i.h),
convs AS (
  SELECT i.conv_id, coalesce(list({'role': b.role, 'text': b.text} ORDER BY b.pos) FILTER (b.pos IS NOT NULL), []) AS turns
  FROM ids i LEFT JOIN built b USING (conv_id) GROUP BY i.conv_id),
steps AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM convs),
prefixes AS (SELECT conv_id, depth, turns[1:depth] AS seq, depth = len(turns) AS ended FROM steps),
nodes AS (
  SELECT depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '') AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(seq[depth].text) END AS own FROM prefixes GROUP BY depth, seq),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.seq[1:n.depth] = n.seq) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.seq = n.seq[1:n.depth - 1]),
below AS (
  SELECT u.depth, u.seq, sum(d.own) AS saved_tokens, count(*) FILTER (d.n_children = 0) AS n_leaves
  FROM nodes u JOIN linked d ON d.depth >= u.depth AND d.seq[1:u.depth] = u.seq GROUP BY u.depth, u.seq)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN below b ON b.depth = l.depth AND b.seq = l.seq
"""
