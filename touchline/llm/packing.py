"""Packing by lexical retrieval.

Documents are dealt to shards of about `shard_chars` characters by a hash of their id. Each shard encodes its texts
once, builds an inverted BM25 index over their token ids, and fills windows of `window` ids: the document at the window's
start, its seed, ranks all its neighbours once, and those not yet used go in, best first, until the window is full. The
document that crosses the end is cut; its rest seeds the next window. So only the last window of a shard is padded.

A query consists of the document's `query_terms` rarest ids that at most half of the shard's documents hold; documents
that share none of them follow in order of id. A shard's size does not grow with the table; a longer document stands in
one shard as a whole. A null or empty text is the end id alone; repeated rows are packed each on its own, rows without
an id are dealt by their text. Columns besides id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.orc_tokens import encoder
from touchline.llm.text import chunks, ragged

WINDOW, END_ID, SHARD_CHARS, QUERY_TERMS = 2048, 1, 3_000_000, 64
K1, B = 1.2, 0.75
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Bm25:
    """Inverted index over the token ids of a shard's documents."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, query_terms: int = QUERY_TERMS):
        n = self.n = len(lengths)
        doc = np.repeat(np.arange(n), lengths)
        vocab = int(ids.max()) + 1 if len(ids) else 1
        key, tf = np.unique(doc * vocab + ids, return_counts=True)
        doc, term = key // vocab, key % vocab
        df = self.df = np.bincount(term, minlength=vocab)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / max(1.0, lengths.mean())))
        by_term = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[by_term], weight[by_term]
        self.first = np.cumsum(df) - df
        asked = (df[term] * 2 <= n) & (df[term] > 1)
        doc, term = doc[asked], term[asked]
        rare = np.lexsort((term, df[term], doc))
        self.term, self.at = term[rare], np.searchsorted(doc, np.arange(n + 1))
        self.query_terms = query_terms

    def ranked(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """The unused documents that share a term with the seed, best first, ties by number."""
        scores = np.where(unused, self.scores(seed), 0.0)
        found = np.flatnonzero(scores > 0)
        return found[np.argsort(-scores[found], kind="stable")]

    def scores(self, seed: int) -> np.ndarray:
        terms = self.term[self.at[seed]:min(self.at[seed] + self.query_terms, self.at[seed + 1])]
        hits = ragged(self.first[terms], self.df[terms])
        return np.bincount(self.doc[hits], self.weight[hits], self.n)


def fill(lengths: np.ndarray, index: Bm25, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    unused = np.ones(len(lengths), bool)
    pieces, sequence, offset, fresh = [], 0, 0, 0
    near = iter(())
    while True:
        doc = next((d for d in near if unused[d]), -1)
        if doc < 0:
            while fresh < len(lengths) and not unused[fresh]:
                fresh += 1
            if fresh == len(lengths):
                return pieces
            doc = fresh
        unused[doc] = False
        start, left, window_of = 0, int(lengths[doc]), sequence if offset else -1
        while left:
            n = min(left, window - offset)
            pieces.append((doc, start, n, sequence, offset))
            start, left, offset = start + n, left - n, offset + n
            if offset == window:
                sequence, offset = sequence + 1, 0
        if sequence != window_of:  # the document stands at the start of a window
            near = iter(index.ranked(doc, unused).tolist() if offset else ())


def packed(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           shard_chars: int = SHARD_CHARS, query_terms: int = QUERY_TERMS, with_ids: bool = True) -> DataFrame:
    """One row per piece; with `with_ids` also its token ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rows = rows.withColumn("shard", F.pmod(key, F.lit(shards)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        shard, texts = table.column("shard")[0].as_py(), table.column("text").to_pylist()
        words, parts = encoder(vocabulary), []
        for lo, hi in chunks(len(t or "") for t in texts):
            parts.append(words.encode(texts[lo:hi], end_id))
        ids, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        found = np.array(fill(n, Bm25(ids, n, query_terms), window), np.int64)
        doc, start, length, sequence, offset = found.T
        at = (np.cumsum(n) - n)[doc] + start
        ids = ids.astype("<u4")
        crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(at, length)]
        columns = {"doc_id": table.column("doc_id").combine_chunks().take(pa.array(doc)), "start": start, "length": length, "ids_crc32": pa.array(crc, pa.int64()),
                   "doc_tokens": n[doc].astype("i8"), "sequence_id": (shard << 32) + sequence, "offset": offset}
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(length)]).astype("i4")
            columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[ragged(at, length)].astype("i4")))
        return pa.table(columns)

    return rows.groupBy("shard").applyInArrow(pack, PIECE + (", ids array<int>" if with_ids else ""))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
