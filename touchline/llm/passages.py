"""Removal of passages that repeat across documents, by sharded Aho-Corasick automata.

A window is `window` consecutive words of one document. A word is removed if a window that covers it also starts in a
document with a smaller id; windows are judged on the input.

1. Exact copies of a whole text are told by its hash: everything in a later copy is removed if it has a window, and
   it is no source of further windows, as the first copy has the same ones.
2. Each window has an anchor, the gram of `gram` words in it with the smallest hash, so equal windows have equal
   anchors. Anchors found in two documents or more say which windows can recur at all.
3. Recurring windows are confirmed: per window hash the smallest document id, if there is a larger one.
4. Source documents are dealt to shards by hash. A shard's recurring windows, read from the sources' words, become the
   patterns of an Aho-Corasick automaton over word numbers, and the stretches of later documents that may hold them are
   streamed through it. A shard with many stretches is salted: its automaton is built once per salt. Only what the
   automaton finds word for word is removed.

A null or empty text has no words. An id that is null counts as smaller than any other. Rows with one id are one
document as far as smaller ids go; if their texts differ, the one with the smallest text hash is searched and lends its
windows, the others keep their words unless they copy a text of a smaller id. Columns besides id and text are not read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.tables import sized, small_batches
from touchline.llm.text import gram_hashes, ragged, text_batches, word_hashes, words
from touchline.sinks.shared import written

WINDOW, GRAM = 13, 6
SHARD_PATTERNS, SALT_WORDS = 20_000, 400_000
NO_ID = -(1 << 63)


def sliding_min(a: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while 2 * width <= span:
        a = np.minimum(a[:-width], a[width:])
        width *= 2
    return np.minimum(a[:len(a) - (span - width)], a[span - width:]) if len(a) > span - width else a[:0]


def windows(texts: list[str | None], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of a piece of texts: text number, position in the text, anchor; the words' hashes and each window's place in them."""
    said = [words(t) for t in texts]
    n = np.array([len(ws) for ws in said], np.int64)
    hashes = word_hashes().of([w for ws in said for w in ws])
    owner = np.repeat(np.arange(len(n)), n)
    anchor = sliding_min(gram_hashes(hashes, gram), window - gram + 1)
    at = np.flatnonzero(owner[:len(anchor)] == owner[window - 1:]) if len(anchor) else np.zeros(0, np.int64)
    return owner[at], at - (np.cumsum(n) - n)[owner[at]], anchor[at], hashes, at


def _anchors(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def task(batches):
        for batch, texts in text_batches(batches):
            owner, _, anchor, _, _ = windows(texts, window, gram)
            new = np.ones(len(owner), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), batch.column("doc_id").take(pa.array(owner[new]))], names=["anchor", "doc_id"])

    return rows.mapInArrow(task, "anchor long, doc_id long")


def _candidates(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(window hash, doc_id, pos) of the windows whose anchor is among the row's `hits`."""

    def task(batches):
        for batch, texts in text_batches(batches):
            owner, pos, anchor, hashes, at = windows(texts, window, gram)
            own = lambda values, of: values ^ (of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            hits = batch.column("hits")
            of = np.repeat(np.arange(len(texts)), np.diff(hits.offsets.to_numpy()))
            values = hits.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            kept = np.isin(own(anchor, owner), own(values, of))
            whole = gram_hashes(hashes, window)[at[kept]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(whole), batch.column("doc_id").take(pa.array(owner[kept])), pa.array(pos[kept].astype("i4"))], names=["w", "doc_id", "pos"])

    return rows.mapInArrow(task, "w long, doc_id long, pos int")


def _runs(found: DataFrame) -> DataFrame:
    """Per document the runs of consecutive recurring windows with one source: (lo, hi, first), from and to which window."""

    def task(batches):
        for batch in batches:
            lists = batch.column("found")
            flat = lists.flatten()
            pos, first = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            order = np.lexsort((pos, owner))
            pos, first, owner = pos[order], first[order], owner[order]
            new = np.ones(len(pos), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (first[1:] != first[:-1]) | (pos[1:] != pos[:-1] + 1)
            lo = np.flatnonzero(new)
            hi = np.append(lo[1:], len(pos)) - 1
            per_doc = np.bincount(owner[lo], minlength=len(lists))
            runs = pa.StructArray.from_arrays([pa.array(pos[lo].astype("i4")), pa.array(pos[hi].astype("i4")), pa.array(first[lo])], names=["lo", "hi", "first"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_doc)).astype("i4")), runs)], names=["doc_id", "runs"])

    lists = found.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "first")).alias("found"))
    return lists.mapInArrow(task, "doc_id long, runs array<struct<lo: int, hi: int, first: long>>")


def _pieces(rows: DataFrame, window: int, shards: int) -> DataFrame:
    """Words of the runs of which this document is the source (`pattern`), and of stretches that are to be searched."""

    def task(batches):
        for batch, texts in text_batches(batches):
            out = []
            for t, runs, doc in zip(texts, batch.column("runs").to_pylist(), batch.column("doc_id").to_pylist()):
                ws = words(t)
                by_shard: dict[tuple[int, bool], list[tuple[int, int]]] = {}
                for r in runs:
                    shard = r["first"] * 0x9E3779B97F4A7C15 % (1 << 64) % shards
                    held = by_shard.setdefault((shard, r["first"] == doc), [])
                    if held and r["lo"] <= held[-1][1] + 1:
                        held[-1] = (held[-1][0], r["hi"])
                    else:
                        held.append((r["lo"], r["hi"]))
                out += [(shard, own, doc, lo, b" ".join(ws[lo:hi + window])) for (shard, own), held in by_shard.items() for lo, hi in held]
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "pattern", "doc_id", "pos", "said"])

    return rows.mapInArrow(task, "shard long, pattern boolean, doc_id long, pos int, said binary")


def _search(patterns: pa.Table, stretches: pa.Table, window: int) -> pa.Table:
    """(doc_id, lo, hi): the stretches' words that windows of a smaller document cover, as ranges."""
    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for said, source in zip(patterns.column("said").to_pylist(), patterns.column("doc_id").to_pylist()):
        ids = tuple([numbers.setdefault(w, len(numbers) + 1) for w in said.split(b" ")])
        for i in range(len(ids) - window + 1):
            automaton.add_word(ids[i:i + window], source)  # equal windows have the same source
    out = []
    if len(automaton) and stretches.num_rows:
        automaton.make_automaton()
        known = numbers.get
        for doc, pos, said in zip(*(stretches.column(c).to_pylist() for c in ("_doc_id", "_pos", "_said"))):
            lo = hi = -1
            for end, source in automaton.iter(tuple([known(w, 0) for w in said.split(b" ")])):
                if source < doc:
                    if end - window + 1 > hi:
                        if hi > lo:
                            out.append((doc, pos + lo, pos + hi))
                        lo = end - window + 1
                    hi = end + 1
            if hi > lo:
                out.append((doc, pos + lo, pos + hi))
    columns = list(zip(*out)) if out else [[]] * 3
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "lo", "hi"])


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (doc_id, ranges of removed words); (th, first), texts that come more than once with their first id; (doc_id, lo), the
    text hash that is searched for an id that has several."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    copies = written(rows.groupBy("th").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("th", "first"), "text-copies")
    several = written(rows.groupBy("doc_id").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo <> hi").select("doc_id", "lo"), "ids-with-several-texts")
    rows = rows.join(sized(several, 24), "doc_id", "left").where("lo is null or lo = th")
    rows = (rows.join(sized(copies, 24).withColumnRenamed("th", "_th"), F.col("th") == F.col("_th"), "left")
            .where("first is null or first = doc_id").select("doc_id", "text"))
    anchors = written(_anchors(rows, window, gram).select("anchor", "doc_id"), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("anchor")
    hits = written(anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("hits")), "anchor-hits")
    hits = sized(hits.withColumnRenamed("doc_id", "_id"), F.lit(64) + 8 * F.size("hits"))
    candidates = written(_candidates(rows.join(hits, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "hits"), window, gram), "window-candidates")
    recurring = candidates.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("w", "first")
    found = written(candidates.join(recurring, "w").select("doc_id", "pos", "first"), "windows")
    shards = max(1, -(-found.where("doc_id = first").count() // SHARD_PATTERNS))
    runs = written(_runs(found), "window-runs")
    runs = sized(runs.withColumnRenamed("doc_id", "_id"), F.lit(64) + 24 * F.size("runs"))
    pieces = written(_pieces(rows.join(runs, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "runs"), window, shards), "pieces")
    loads = written(pieces.where("not pattern").groupBy("shard").agg(F.ceil(F.sum(F.length("said")) / (8 * SALT_WORDS)).cast("int").alias("salts")), "shard-loads")
    pieces = pieces.join(sized(loads, 16), "shard")
    patterns = pieces.where("pattern").select("shard", "doc_id", "said", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    stretches = pieces.where("not pattern").select("shard", "doc_id", "pos", "said", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt"))
    stretches = stretches.toDF("_shard", "_doc_id", "_pos", "_said", "_salt")
    ranges = patterns.groupBy("shard", "salt").cogroup(stretches.groupBy("_shard", "_salt")).applyInArrow(lambda p, t: _search(p, t, window), "doc_id long, lo int, hi int")
    return written(ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "removed-words"), copies, several


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed and `kept`, the remaining words joined by blanks."""
    ranges, copies, several = repeated_ranges(docs, id_col, text_col, window, gram)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    order = F.coalesce("doc_id", F.lit(NO_ID))
    rows = rows.join(sized(copies, 24).toDF("_th", "_first"), F.col("th") == F.col("_th"), "left")
    rows = rows.join(sized(ranges, F.lit(64) + 24 * F.size("ranges")).withColumnRenamed("doc_id", "_id"), order == F.col("_id"), "left")
    rows = rows.join(sized(several, 24).toDF("_several", "_lo"), order == F.col("_several"), "left")
    searched = F.col("_lo").isNull() | (F.col("_lo") == F.col("th"))
    rows = rows.select("doc_id", "text", (order > F.coalesce(F.col("_first"), order)).alias("copy"), F.when(searched, F.col("ranges")).alias("ranges"))

    def task(batches):
        for batch, texts in text_batches(batches):
            counts, gone, kept = [], [], []
            for t, copy, ranges in zip(texts, batch.column("copy").to_pylist(), batch.column("ranges").to_pylist()):
                ws = words(t)
                away = np.zeros(len(ws), bool)
                if copy and len(ws) >= window:
                    away[:] = True
                elif ranges:
                    lo, hi = np.array([(r["lo"], r["hi"]) for r in ranges]).T
                    away[ragged(lo, hi - lo)] = True
                n = int(away.sum())
                counts.append(len(ws))
                gone.append(n)
                kept.append(b" ".join(ws if not n else [w for w, x in zip(ws, away.tolist()) if not x]).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(task, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
windows AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
first AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM windows JOIN first USING (k), range(13) AS r(o) WHERE first < doc_id),
said AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT s.doc_id, string_agg(w, ' ' ORDER BY s.p) AS text, count(*) AS n FROM said s
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = s.doc_id AND g.p = s.p) GROUP BY s.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
