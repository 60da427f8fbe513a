"""N-gram Jaccard join and its components.

A document's set are the hashes of its distinct shingles (`size` consecutive words, A-Z lower-cased; fewer words: the
whole sequence; no words: empty, linked with nothing). Two documents link when 100 * |a & b| >= pct * |a | b|.

1. Equal sets are one set from here on, named by its smallest document id.
2. Set elements are put in one global order: first those in few prefixes, by hash, then the frequent ones, by hash.
   Linked sets share an element of their prefixes, so only prefixes go into the inverted index, and only lists of two
   or more sets are kept.
3. A list is laid out in blocks by size class and position. A set probes the two size classes that can hold its
   partners, and skips every block whose position leaves too few elements for the overlap that a link needs.
   Prefixes of sets of `SHARE_EVERY` elements or more are so much longer that linked sets share up to `SHARE` elements of
   them; pairs that share fewer, like most that have one phrase in common by chance, go.
   The elements of each class of hashes are counted once a set; pairs whose counts leave too few in common go too, first
   those told by the parities of the counts, within the probe; by more of them where `MANY` sets meet in a list. Before
   sets are read, the pairs left are told by parities of as many classes as a set has elements.
4. Each set is first compared with one leader only, the set that most of its lists name first. Its links are derived from
   that answer: a set linked to its leader is in the leader's component and meets no other set of it. In `ROUNDS` further
   rounds each set of a list of `MANY` is compared with one of the list's largest component, unless it is in it. Between two
   components, d(x, y) >= d(leader x, leader y) - d(x, leader x) - d(y, leader y) (Jaccard distance is a metric) rules
   pairs out without reading their sets; only the pairs left are compared. Where links are counted, pairs within a
   component are compared like all others.
5. Links make components by label propagation over written tables.

So a large group of near copies gives about one comparison a member, and no two components that a link joins stay apart.
Counting links (`links`) takes a comparison for every pair of different sets that may link, which grows with the square of
such a group; equal sets are counted by their number, without pairs.
Frequent elements (`hot`) only steer the order: those in more than max(`HOT_LEAST`, postings / `HOT_MOST`) lists, hence at
most `HOT_MOST` hashes reach the driver and are broadcast. Shingles are compared by 64-bit hash.

A null text has an empty set. A row without an id links with nothing and has no component. Different texts of one id are
different documents, each in its own component, which is named by the smallest id in it. Columns besides id and text are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.tables import one_id_a_text, sized, small_batches
from touchline.llm.text import gram_hashes, text_batches, word_hashes
from touchline.sinks.shared import written

SIZE, PCT = 3, 90
CLASSES = 64
PARITIES, FINE = 2, 8
MANY, ROUNDS = 8, 2
SHARE, SHARE_EVERY = 4, 64
HOT_LEAST, HOT_MOST = 32, 1 << 17
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes."""
    said = text.encode().translate(_LOWER).split() if text else []
    hashes = word_hashes().of(said)
    return np.unique(gram_hashes(hashes, min(size, len(hashes)) or 1)).view(np.int64) if said else np.zeros(0, np.int64)


def need(n, pct: int):
    """Smallest size of a partner, and smallest overlap with it, of a set of size n."""
    return -(-pct * n // 100)


def shared(n: int) -> int:
    """Common elements that the prefixes of two linked sets hold at least, if n is the size of the smaller one and its overlap is not less."""
    return min(SHARE, 1 + n // SHARE_EVERY)


def ordered_prefix(sorted_set: np.ndarray, hot: np.ndarray, length: int) -> np.ndarray:
    """The first elements in the global order. `sorted_set` is in unsigned order; only the part that is needed is looked up in `hot`."""

    def is_hot(part):
        if not len(hot):
            return np.zeros(len(part), bool)
        at = np.minimum(np.searchsorted(hot, part), len(hot) - 1)
        return hot[at] == part

    take = length
    while True:
        part = sorted_set[:take]
        mask = is_hot(part)
        cold = part[~mask]
        if len(cold) >= length:
            return cold[:length]
        if take >= len(sorted_set):
            return np.concatenate([cold, part[mask]])[:length]
        take *= 2


def class_counts(s: np.ndarray) -> bytes:
    """How many elements of a set fall into each of `CLASSES` classes of hashes, a byte each; empty if a byte cannot hold one."""
    counts = np.bincount(s & (CLASSES - 1), minlength=CLASSES)
    return counts.astype(np.uint8).tobytes() if len(s) and counts.max() < 256 else b""


def parities(s: np.ndarray) -> list[int]:
    """Whether a class of hashes holds an odd number of the set's elements: of `PARITIES` times 64 classes, then of `FINE` times 64."""
    odd = [np.bincount(s >> 6 & (64 * k - 1), minlength=64 * k) & 1 for k in (PARITIES, FINE)]
    return np.packbits(np.concatenate(odd).astype(np.uint8)).view(np.int64).tolist()


def sketch(s: np.ndarray) -> bytes:
    """Whether a class of hashes holds an odd number of the set's elements, a bit each; classes: its size or up to twice as many, a power of two."""
    classes = 1 << max(6, (len(s) - 1).bit_length())
    return np.packbits((np.bincount(s >> 6 & (classes - 1), minlength=classes) & 1).astype(np.uint8), bitorder="little").tobytes()


def unlike(a: bytes, b: bytes) -> int:
    """Elements that at least are in one of two sets alone, by their sketches."""
    p, q = (np.frombuffer(x, np.uint8) for x in (a, b))
    while len(p) > len(q):
        p = p[:len(p) // 2] ^ p[len(p) // 2:]
    while len(q) > len(p):
        q = q[:len(q) // 2] ^ q[len(q) // 2:]
    return int(np.bitwise_count(p ^ q).sum())


def _prints(rows: DataFrame, size: int, pct: int) -> DataFrame:
    """Size, digest, class counts, parities and sketch of each row's set, and the prefix it has in the order by hash alone."""

    def task(batches):
        for batch, texts in text_batches(batches):
            sets = [shingles(t, size) for t in texts]
            digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            prefix = [s[:len(s) - need(len(s), pct) + 1] if len(s) else s for s in sets]
            ends = pa.array(np.cumsum([0, *map(len, prefix)]).astype("i4"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                                              pa.array(map(class_counts, sets), pa.binary()), pa.array(map(parities, sets), pa.list_(pa.int64())), pa.array(map(sketch, sets), pa.binary()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefix)))],
                                             names=["doc_id", "th", "n", "digest", "classes", "odd", "sketch", "prefix"])

    return rows.mapInArrow(task, "doc_id long, th long, n long, digest binary, classes binary, odd array<long>, sketch binary, prefix array<long>")


def _postings(rows: DataFrame, size: int, pct: int, hot: np.ndarray) -> DataFrame:
    """(token, doc_id, n, pos) of each set's prefix in the global order."""
    known = rows.sparkSession.sparkContext.broadcast(np.sort(hot))

    def task(batches):
        for batch, texts in text_batches(batches):
            parts, sizes = [], []
            for t in texts:
                s = shingles(t, size)
                sizes.append(len(s))
                parts.append(ordered_prefix(s, known.value, len(s) - need(len(s), pct) + shared(len(s))) if len(s) else s)
            n = np.array([len(p) for p in parts])
            at = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts)), batch.column("doc_id").take(pa.array(at)), pa.array(np.array(sizes)[at].astype("i4")),
                                              pa.array(pos.astype("i4"))], names=["token", "doc_id", "n", "pos"])

    return rows.mapInArrow(task, "token long, doc_id long, n int, pos int")


def _ids(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct(), "wanted")


def _of_both(pairs: DataFrame, traits: DataFrame, name: str, row_bytes: Column | int) -> DataFrame:
    """The (x, y, ...) pairs, a written table, with `_a` and `_b`, the second column of `traits` (doc_id, ...) for x and y."""
    known = sized(written(traits.join(sized(_ids(pairs), 16), F.col("doc_id") == F.col("id"), "left_semi"), name), row_bytes)
    both = pairs.join(known.toDF("x", "_a"), "x").join(known.toDF("y", "_b"), "y")
    return both.select(*pairs.columns, "_a", "_b")


def _possible(pairs: DataFrame, traits: DataFrame, pct: int) -> DataFrame:
    """The rows of (x, y, ...) pairs, a written table, that may link: two sets have no more than min(a, b) common elements of a class of hashes,
    and no fewer different ones than classes that are odd in one set alone."""
    names = pairs.columns

    def table(column):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CLASSES)

    def task(batches):
        for batch in batches:
            told = [c is not None and d is not None and len(c) == len(d) == CLASSES for c, d in zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist())]
            stays = ~np.array(told)
            both = batch.filter(pa.array(told))
            if both.num_rows:
                a, b = table(both.column("_a")), table(both.column("_b"))
                most = np.minimum(a, b).sum(1, dtype=np.int64)
                stays[told] = 100 * most >= pct * (a.sum(1, dtype=np.int64) + b.sum(1, dtype=np.int64) - most)
            yield batch.filter(pa.array(stays)).select(names)

    def told_by_sketches(batches):
        for batch in batches:
            stays = []
            for a, b in zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist()):
                both = a["n"] + b["n"]
                stays.append(unlike(a["sketch"], b["sketch"]) <= both - 2 * -(-pct * both // (100 + pct)))
            yield batch.filter(pa.array(stays, pa.bool_())).select(names)

    left = written(_of_both(pairs, traits.select("doc_id", "classes"), "wanted-counts", 128).mapInArrow(task, pairs.schema), "counted-pairs")
    sketches = traits.select("doc_id", F.struct("n", "sketch").alias("_s"))
    return _of_both(left, sketches, "wanted-sketches", 64 + F.octet_length("_s.sketch")).mapInArrow(told_by_sketches, pairs.schema)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds `inter`, the number of common elements, to (x, y) pairs."""

    def task(batches):
        for batch in batches:
            x, y, a, b = (batch.column(c).to_pylist() for c in ("x", "y", "a", "b"))
            inter = [len(np.intersect1d(np.frombuffer(p, "<i8"), np.frombuffer(q, "<i8"), assume_unique=True)) for p, q in zip(a, b)]
            sizes = [[len(v) // 8 for v in s] for s in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (x, y, *sizes, inter)], names=["x", "y", "nx", "ny", "inter"])

    both = pairs.select("x", "y").join(sets.toDF("x", "a"), "x").join(sets.toDF("y", "b"), "y")
    return both.select("x", "y", "a", "b").mapInArrow(task, "x long, y long, nx long, ny long, inter long")


def _sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    def task(batches):
        for batch, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([shingles(t, size).tobytes() for t in texts], pa.binary())], names=["doc_id", "s"])

    return rows.join(sized(wanted, 16).withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(task, "doc_id long, s binary").dropDuplicates(["doc_id"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for the nodes of (x, y) links: the smallest node that can be reached."""
    edges = written(links.select("x", "y").union(links.select("y", "x")).distinct(), "edges")
    labels = written(edges.groupBy(F.col("x").alias("id")).agg(F.least(F.min("y"), F.col("x")).alias("component")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("id", "y"), "y").groupBy(F.col("x").alias("id")).agg(F.min("component").alias("_near"))
        nearer = labels.join(seen, "id").select("id", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        jumped = nearer.join(labels.toDF("_new", "_far"), "_new", "left").select("id", "_old", F.least("_new", F.coalesce("_far", "_new")).alias("component"))
        jumped = written(jumped, "labels")
        labels = jumped.select("id", "component")
        if jumped.where("component <> _old").isEmpty():
            return labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, pct: int = PCT, links: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_shingles, n_links, component_id.

    `n_links` is the number of other documents that link with the row's; without `links` the column and its work are left out."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named, repeated = one_id_a_text(rows, "doc_id", "text", "uid", False)
    found = _components_of(named.select(F.col("uid").alias("doc_id"), "text"), size, pct, links)
    if not repeated:
        return found
    ids = written(named.where("uid is not null").select(F.col("uid").alias("_uid"), F.col("doc_id").alias("_id")).distinct(), "ids")
    found = written(found.join(ids, F.col("doc_id") == F.col("_uid"), "left").select(F.col("_id").alias("doc_id"), *found.columns[1:]), "components")
    least = found.where("component_id is not null").groupBy(F.col("component_id").alias("_component")).agg(F.min("doc_id").alias("_least"))
    return found.join(least, F.col("component_id") == F.col("_component"), "left").select(*found.columns[:-1], F.col("_least").alias("component_id"))


def _components_of(docs: DataFrame, size: int, pct: int, count: bool) -> DataFrame:
    """`jaccard_components` of (doc_id, text) rows of which those with one id have one text."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    prints = written(_prints(rows, size, pct), "set-prints")
    known = prints.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("th", "n", "digest")).alias("s")).select("doc_id", "s.*")
    equal = known.groupBy("digest", "n").agg(F.min("doc_id").alias("rep"))
    member = written(known.join(equal, ["digest", "n"]).select("doc_id", "th", "rep"), "set-members")
    others = prints.where("doc_id is not null").select("doc_id", "th").join(member.where("doc_id = rep"), ["doc_id", "th"], "left_anti").distinct()
    rows = rows.where("doc_id is not null").join(sized(written(others, "set-others"), 24), ["doc_id", "th"], "left_anti").select("doc_id", "text")

    # the sets that stand for all equal ones, once each
    chosen = prints.join(sized(member.where("doc_id = rep").select("doc_id", "th"), 24), ["doc_id", "th"], "left_semi")
    traits = written(chosen.select("doc_id", "n", "classes", "sketch", *(F.col("odd")[i].alias(f"odd{i}") for i in range(PARITIES + FINE))).dropDuplicates(["doc_id"]), "set-traits")
    plain = chosen.select(F.explode("prefix").alias("token")).groupBy("token").count()
    plain = written(plain.where(F.col("count") > HOT_LEAST), "frequent")
    total = prints.agg(F.sum(F.col("n") - F.ceil(F.col("n") * pct / 100) + 1)).first()[0] or 0
    hot = np.array([r.token for r in plain.where(F.col("count") > max(HOT_LEAST, total // HOT_MOST)).select("token").collect()], np.int64)

    # a row of a list stays if another set of its size class or a neighbouring one is in the list
    near = Window.partitionBy("token").orderBy("class").rangeBetween(-1, 1)
    size_class = F.floor(F.log("n") / -np.log(pct / 100)).cast("int")
    lists = (_postings(rows, size, pct, hot).withColumn("class", size_class)
             .withColumns({"lo": F.min("doc_id").over(near), "hi": F.max("doc_id").over(near), "many": F.count("*").over(near) >= MANY})
             .where("lo <> hi").drop("lo", "hi"))
    lists = written(lists, "lists")
    # of two sets the larger (ties: the one with the larger id) probes, the other is indexed by its shorter index prefix
    least_shared = lambda n: F.least(F.lit(SHARE), 1 + F.floor(F.col(n) / SHARE_EVERY))
    index_length = F.col("n") - F.ceil(2 * pct * F.col("n") / (100 + pct)) + least_shared("n")

    def indexed(lists: DataFrame, *more: Column) -> DataFrame:
        return lists.where(F.col("pos") < index_length).select("token", "class", F.col("doc_id").alias("y"), F.col("n").alias("m"), F.col("pos").alias("j"), *more)

    def probing(lists: DataFrame, *more: Column) -> DataFrame:
        return lists.select("token", F.explode(F.array("class", F.col("class") - 1)).alias("class"), F.col("doc_id").alias("x"), "n", F.col("pos").alias("i"), *more)

    index, probes = indexed(lists), probing(lists)
    overlap = F.ceil(pct * (F.col("n") + F.col("m")) / (100 + pct))
    hits = F.least(least_shared("m"), overlap)
    fits = ((F.struct("m", "y") < F.struct("n", "x")) & (100 * F.col("m") >= pct * F.col("n")) & (F.col("x") != F.col("y"))
            & (F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) > overlap - hits))

    linked = 100 * F.col("inter") >= pct * (F.col("nx") + F.col("ny") - F.col("inter"))
    distance = (1 - F.col("inter") / (F.col("nx") + F.col("ny") - F.col("inter")))

    def asked(named: DataFrame) -> DataFrame:
        """Each set's answer from the set that most of its lists name."""
        best = named.groupBy("x", "y").count().groupBy("x").agg(F.max(F.struct("count", (-F.col("y")).alias("y"))).alias("b")).select("x", (-F.col("b.y")).alias("y"))
        best = written(_possible(written(best, "named-pairs"), traits, pct), "leader-pairs")
        return written(_overlaps(best, _sets(rows, _ids(best), size)).withColumn("linked", linked).withColumn("d", distance), "leader-answers")

    first = index.groupBy("token", "class").agg(F.min(F.struct("y", "m", "j")).alias("b")).select("token", "class", "b.*")
    answers = asked(probes.join(first, ["token", "class"]).where(fits))
    for turn in range(ROUNDS):
        found = components(answers.where("linked").select("x", "y"))
        place = found.join(found.groupBy("component").agg(F.count("*").alias("members")), "component")
        place = sized(written(place.select("id", "component", "members"), "placed"), 40)
        crowd = probing(lists.where("many")).join(place.toDF("x", "x_component", "_n"), "x", "left").withColumn("x_component", F.coalesce("x_component", "x")).drop("_n")
        large = indexed(lists.where("many")).join(place.toDF("y", "y_component", "members"), "y", "left").withColumn("y_component", F.coalesce("y_component", "y"))
        chance = [F.xxhash64(c, F.lit(turn)) for c in ("y_component", "y")]
        large = (large.groupBy("token", "class").agg(F.max(F.struct(F.coalesce("members", F.lit(1)), *chance, "y_component", "y", "m", "j")).alias("b"))
                 .select("token", "class", "b.y_component", "b.y", "b.m", "b.j"))
        more = asked(crowd.join(large, ["token", "class"]).where(fits & (F.col("x_component") != F.col("y_component"))).join(answers.select("x", "y"), ["x", "y"], "left_anti"))
        if more.where("linked").isEmpty():
            break
        answers = answers.union(more)

    links = answers.where("linked").select("x", "y")
    found = components(links)
    nearest = answers.where("linked").groupBy("x").agg(F.min(F.struct("d", "y")).alias("b")).select(F.col("x").alias("id"), F.col("b.y").alias("leader"), "b.d")
    led = written(nearest.join(found, "id", "outer").select("id", F.coalesce("leader", "id").alias("leader"), F.coalesce("d", F.lit(0.0)).alias("d"), "component"), "led")
    place = sized(led.select("id", "component"), 32)
    bits = range(PARITIES + FINE)
    odd = sized(traits.drop("n", "classes", "sketch"), 16 + 8 * len(bits))

    laid = lists.join(place.withColumnRenamed("id", "doc_id"), "doc_id", "left").join(odd, "doc_id", "left")
    laid = laid.withColumns({f"odd{i}": F.when(F.col("many"), F.col(f"odd{i}")) for i in bits[PARITIES:]})

    def put(key: str) -> list[Column]:
        return [F.col(c).alias(f"{key}_{c}") for c in ("component", *(f"odd{i}" for i in bits))]

    # two sets known to be in one component need no comparison, unless their links are counted
    apart = F.lit(True) if count else F.coalesce("x_component", "x") != F.coalesce("y_component", "y")
    # a class that is odd in one set alone has an element of the difference, whose size a link bounds
    unlike = [F.bit_count(F.col(f"x_odd{i}").bitwiseXOR(F.col(f"y_odd{i}"))) for i in bits]
    differ = F.greatest(sum(unlike[:PARITIES], F.lit(0)), sum(unlike[PARITIES:], F.lit(0)))  # nulls, of short lists, are skipped
    open_ = (probing(laid, *put("x")).join(indexed(laid, *put("y")), ["token", "class"]).where(fits & apart & (differ <= F.col("n") + F.col("m") - 2 * overlap))
             .groupBy("x", "y").agg(F.count("*").alias("found"), F.min(hits).alias("hits")).where("found >= hits").select("x", "y").join(answers.select("x", "y"), ["x", "y"], "left_anti"))
    for s in ("x", "y"):
        named = sized(led.drop("component"), 40).toDF(s, f"_l{s}", f"_d{s}")
        open_ = open_.join(named, s, "left").withColumns({f"l{s}": F.coalesce(f"_l{s}", s), f"d{s}": F.coalesce(f"_d{s}", F.lit(0.0))}).drop(f"_l{s}", f"_d{s}")
    open_ = written(_possible(written(open_.select("x", "y", "lx", "ly", "dx", "dy"), "likely-pairs"), traits, pct), "open-pairs")
    leaders = written(open_.where("dx + dy > 0").select(F.least("lx", "ly").alias("x"), F.greatest("lx", "ly").alias("y")).where("x <> y").distinct(), "leader-pairs")
    between = _overlaps(leaders, _sets(rows, _ids(leaders), size)).select(F.col("x").alias("a"), F.col("y").alias("b"), distance.alias("between"))
    left = (open_.join(between, (F.least("lx", "ly") == F.col("a")) & (F.greatest("lx", "ly") == F.col("b")), "left")
            .where(F.col("between").isNull() | (F.col("between") - F.col("dx") - F.col("dy") <= 1 - pct / 100 + 1e-9)).select("x", "y"))
    left = written(left, "pairs-left")
    more = written(_overlaps(left, _sets(rows, _ids(left), size)).where(linked).select("x", "y"), "links")
    links = links.union(more)

    node = (member.join(components(links).toDF("rep", "component"), "rep", "left")
            .select(F.col("doc_id").alias("_id"), "rep", F.coalesce("component", "rep").alias("_component")))
    out = [F.col("n").alias("n_shingles")]
    if count:
        equal = member.groupBy("rep").agg(F.count("*").alias("equal"))
        ways = links.select("x", "y").union(links.select("y", "x")).toDF("rep", "_other")
        near = ways.join(equal.toDF("_other", "_n"), "_other").groupBy("rep").agg(F.sum("_n").alias("near"))
        node = node.join(equal, "rep").join(near, "rep", "left").withColumn("_links", F.col("equal") - 1 + F.coalesce("near", F.lit(0))).drop("equal", "near")
        out.append(F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))
    return prints.join(node, F.col("doc_id") == F.col("_id"), "left").select("doc_id", *out, F.coalesce("_component", "doc_id").alias("component_id"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), links=False).select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:least(p + 2, len(ws))], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
