"""Near-duplicate lines by a segment-partition edit join.

A line (between `\\n`, white space at its ends cut and runs of it made one blank) of `min_chars` characters or more is
removed if an equal line, or one within `max_edits` edits (insert, delete, replace a code point), comes earlier in the
corpus by (doc_id, hash of the text, line number). Shorter lines stay. That rule is exact: no class is closed over.

1. Each line gives (hash, place); per hash the first place is kept. Copies of a line are the same line from here on.
2. A line of length l is cut into `max_edits` + 1 segments, which are indexed by (l, segment number, content). A line
   within `max_edits` edits of it and not shorter has one of them as a substring near the same place, so it probes
   those substrings for l = its length down to its length - `max_edits`. Only keys that different lines share go on.
3. Pairs must agree in a 64-bit parity of their characters but for two bits an edit. First each line meets only the
   earliest line of each key; a line that is found a near copy there is settled, only the others meet all lines of
   their keys. So groups of near copies are not multiplied out. Pairs are verified by banded bit-parallel edit distance.
4. The removed line numbers of each document go back to its text.

Null and empty texts have no lines. Rows with the same id and text are treated alike. Rows without an id come first.
Columns of the input are kept; `n_lines` and `n_removed` are added and replace input columns of that name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.llm.tables import sized, small_batches
from touchline.llm.text import text_batches
from touchline.sinks.shared import written

MAX_EDITS, MIN_CHARS = 2, 40
_SIGNED = 1 << 63


def normalised(line: str) -> str:
    return " ".join(line.split())


def long_lines(text: str | None, min_chars: int) -> list[tuple[int, str]]:
    return [(i, s) for i, x in enumerate(text.split("\n")) if len(x) >= min_chars and len(s := normalised(x)) >= min_chars] if text else []


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - _SIGNED


def parities(said: list[str]) -> np.ndarray:
    """Bit k tells whether a line's characters of class k (code point modulo 64) are odd in number; an edit changes two bits at most."""
    n = np.array([len(s) for s in said], np.int64)
    codes = np.frombuffer("".join(said).encode("utf-32-le"), "<u4")
    bits = np.uint64(1) << (codes & 63).astype(np.uint64)
    return np.bitwise_xor.reduceat(bits, np.cumsum(n) - n).view(np.int64) if len(bits) else np.zeros(len(n), np.int64)


def within(a: str, b: str, k: int) -> bool:
    """Whether at most k edits turn a into b. Bit d of level e: prefix of b of length j - k + d is reached from a's first j characters with e edits."""
    if abs(len(a) - len(b)) > k:
        return False
    if a == b:
        return True
    places: dict[str, int] = {}
    for i, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << i
    band = (1 << (2 * k + 1)) - 1
    levels = [(((1 << (e + 1)) - 1) << k) & band for e in range(k + 1)]
    for j, c in enumerate(a):
        at = places.get(c, 0)
        equal = (at >> (j - k) if j >= k else at << (k - j)) & band
        new = []
        for e in range(k + 1):
            bits = levels[e] & equal
            if e:
                bits |= levels[e - 1] | levels[e - 1] >> 1 | new[e - 1] << 1
            new.append(bits & band)
        if not new[k]:
            return False
        levels = new
    return bool(levels[k] >> (len(b) - len(a) + k) & 1)


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of even segments of a line of length n, the longer ones last."""
    short = n // parts
    lengths = [short + (i >= parts - n % parts) for i in range(parts)]
    return [(sum(lengths[:i]), x) for i, x in enumerate(lengths)]


@functools.lru_cache(maxsize=20_000)
def key_places(n: int, max_edits: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, end, seed) of the index keys and of the probe keys of a line of length n."""
    parts = max_edits + 1
    index = [(s, s + k, n * parts + i) for i, (s, k) in enumerate(segments(n, parts))]
    probes = []
    for l in range(max(parts, n - max_edits), n + 1):
        more = n - l
        for i, (s, k) in enumerate(segments(l, parts)):
            lo = max(0, s - i, s + more - (max_edits - i))
            hi = min(n - k, s + i, s + more + (max_edits - i))
            probes += [(p, p + k, l * parts + i) for p in range(lo, hi + 1)]
    return index, probes


def keys(line: str, max_edits: int) -> tuple[list[int], list[int]]:
    """Hashes under which the line is indexed, and those which it probes."""
    hashed = xxhash.xxh3_64_intdigest
    index, probes = key_places(len(line), max_edits)
    return [hashed(line[a:b], seed) for a, b, seed in index], [hashed(line[a:b], seed) for a, b, seed in probes]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _occurrences(rows: DataFrame, min_chars: int) -> DataFrame:
    def task(batches):
        for batch, texts in text_batches(batches):
            found = [long_lines(t, min_chars) for t in texts]
            n = np.array([len(x) for x in found])
            at = pa.array(np.repeat(np.arange(len(n)), n))
            said = [s for x in found for _, s in x]
            yield pa.RecordBatch.from_arrays([pa.array(map(line_hash, said), pa.int64()), batch.column("doc_id").take(at), batch.column("th").take(at),
                                              pa.array([i for x in found for i, _ in x], pa.int32()), pa.array(parities(said))],
                                             names=["h", "doc_id", "th", "no", "sig"])

    return rows.mapInArrow(task, "h long, doc_id long, th long, no int, sig long")


def _keyed(rows: DataFrame, max_edits: int, min_chars: int) -> DataFrame:
    """(key, h, probe): a line that occurs again in one piece of a task is keyed once."""

    def task(batches):
        for batch, texts in text_batches(batches):
            said = dict.fromkeys(s for t in texts for _, s in long_lines(t, min_chars))
            both = [keys(line, max_edits) for line in said]
            n = np.array([(len(i), len(p)) for i, p in both], np.int64).reshape(-1, 2)
            key = np.array([k for pair in both for side in pair for k in side], np.uint64).view(np.int64)
            h = np.repeat(np.array([line_hash(line) for line in said], np.int64), n.sum(1))
            probe = np.repeat(np.tile([False, True], len(said)), n.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(h), pa.array(probe)], names=["key", "h", "probe"])

    return rows.mapInArrow(task, "key long, h long, probe boolean")


def _line_texts(rows: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """(h, line) of the wanted lines (h, first), once each, read from the documents in which they come first."""

    def task(batches):
        for batch, texts in text_batches(batches):
            said = list(dict.fromkeys(s for t in texts for _, s in long_lines(t, min_chars)))
            yield pa.RecordBatch.from_arrays([pa.array(map(line_hash, said), pa.int64()), pa.array(said, pa.string())], names=["h", "line"])

    holders = written(wanted.select(F.col("first.doc_id").alias("_id"), F.col("first.th").alias("_th")).distinct(), "line-holders")
    rows = rows.join(sized(holders, 24), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi")
    return rows.select("text").mapInArrow(task, "h long, line string").join(sized(wanted.select("h"), 16), "h", "left_semi").dropDuplicates(["h"])


def _verified(pairs: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    """The later lines of those pairs (late, early) that are within the edits."""

    def task(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("late", "a", "b")]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, a, b in zip(*columns) if within(a, b, max_edits)], pa.int64())], names=["h"])

    both = (pairs.join(texts.toDF("late", "a"), "late").join(texts.toDF("early", "b"), "early"))
    return both.select("late", "a", "b").mapInArrow(task, "h long").distinct()


def removable_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, gone): per document, told by id and text hash, the numbers of the lines that are removed."""
    small_batches(docs.sparkSession)
    min_chars = max(min_chars, max_edits + 1)
    rows = _rows(docs, id_col, text_col)
    places = written(_occurrences(rows, min_chars), "line-places")
    lines = written(places.groupBy("h").agg(F.min(F.struct("doc_id", "th", "no")).alias("first"), F.min("sig").alias("sig")), "lines")
    by_key = Window.partitionBy("key")
    shared = (_keyed(rows, max_edits, min_chars).withColumn("lo", F.min("h").over(by_key)).withColumn("hi", F.max("h").over(by_key))
              .where("lo <> hi").select("key", "h", "probe").distinct())
    shared = written(shared.join(lines, "h"), "line-keys")
    index, probe = (shared.where(F.col("probe") == p).select("key", F.col("h").alias(f"{s}h"), F.col("first").alias(f"{s}first"), F.col("sig").alias(f"{s}sig"))
                    for p, s in ((False, "i"), (True, "p")))
    close = (F.col("ih") != F.col("ph")) & (F.bit_count(F.col("isig").bitwiseXOR(F.col("psig"))) <= 2 * max_edits)
    pair = [F.when(F.col("pfirst") > F.col("ifirst"), F.col("ph")).otherwise(F.col("ih")).alias("late"),
            F.when(F.col("pfirst") > F.col("ifirst"), F.col("ih")).otherwise(F.col("ph")).alias("early")]
    star = index.groupBy("key").agg(F.min(F.struct("ifirst", "ih", "isig")).alias("s")).select("key", "s.*")
    pairs = written(probe.join(star, "key").where(close).select(*pair).distinct(), "line-pairs")
    both = lambda p: p.select(F.col("late").alias("h")).union(p.select("early")).distinct().join(lines.select("h", "first"), "h")
    texts = written(_line_texts(rows, written(both(pairs), "line-wanted"), min_chars), "line-texts")
    settled = written(_verified(pairs, texts, max_edits), "line-settled")
    open_ = lambda rows, h: rows.join(settled.select(F.col("h").alias(h), F.lit(True).alias(f"{h}_done")), h, "left")
    done = F.when(F.col("pfirst") > F.col("ifirst"), F.col("ph_done")).otherwise(F.col("ih_done"))
    more = open_(probe, "ph").join(open_(index, "ih"), (probe["key"] == index["key"]) & close & done.isNull()).select(*pair).distinct()
    more = written(more.join(pairs, ["late", "early"], "left_anti"), "line-pairs")
    texts = written(_line_texts(rows, written(both(more), "line-wanted"), min_chars), "line-texts")
    near = settled.union(_verified(more, texts, max_edits)).distinct().select("h", F.lit(True).alias("near"))
    verdict = lines.select("h", "first").join(near, "h", "left")
    gone = places.join(verdict, "h").where(F.col("near").isNotNull() | ~F.struct("doc_id", "th", "no").eqNullSafe(F.col("first")))
    return written(gone.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("no")).alias("gone")), "lines-gone")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of `docs` with the remaining lines as text, and n_lines (before) and n_removed."""
    gone = removable_lines(docs, id_col, text_col, max_edits, min_chars).toDF("__line_id", "__line_th", "__line_gone")
    gone = sized(gone, F.lit(64) + 8 * F.size("__line_gone"))
    base = docs.select(*(c for c in docs.columns if c not in ("n_lines", "n_removed")))
    joined = base.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__line_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__line_th")), "left").drop("__line_id", "__line_th")
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    # The text is split once a row; inside the lambda it would be split for every line.
    left = F.filter(lines, lambda line, i: ~F.array_contains("__line_gone", i))
    kept = F.when(F.col("__line_gone").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    ends = F.octet_length(F.col(text_col).cast("string")) - F.octet_length(F.replace(F.col(text_col).cast("string"), F.lit("\n"), F.lit("")))
    counted = joined.withColumn("n_lines", F.coalesce(ends + 1, F.lit(0)).cast("long"))
    return counted.withColumn("n_removed", F.when(F.col("__line_gone").isNull(), F.lit(0)).otherwise(F.size("__line_gone")).cast("long")).withColumn(text_col, kept).drop("__line_gone")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 of the remaining text (null text: of the empty one)."""
    done = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))
