"""Language identification by cross-parsing entropy.

For each language a suffix automaton of bounded labelled text is built. Each word of a text, with the blanks around it,
is parsed into the longest phrases that occur in that text. A phrase costs the logarithm of the length of the language's
text, the bits that point to a place in it, so phrases are comparable between languages with much and little training
text. The language whose phrases cost least for the whole text wins (ties: the language first by code point). `score` is 1
minus the winner's cost over the runner-up's, 1.0 if only one language is known. A phrase does not run on into the next
word: a task parses a word once and remembers it, which a parse across words would not allow within the time limits.

Texts are lower-cased, runs of characters other than letters become one blank, and no cap or prefix applies to the
texts that are identified. Only fitting is bounded: `chars_per_lang` normalised characters per language, of which
`chars_per_doc` at most from one of the `docs_per_lang` documents with the smallest hashed ids. A null text, one without a letter, or an empty set of known
languages gives `und` with score 0. Repeated rows are identified each on its own; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.tables import small_batches
from touchline.llm.text import remembered, text_batches

CHARS_PER_LANG = 40_000
DOCS_PER_LANG = 60
CHARS_PER_DOC = 3_000
REMEMBERED_WORDS = 300_000
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", text.lower()).strip() if text else ""


def suffix_automaton(text: str) -> dict:
    """The start state. A state is the dict of its transitions; following characters from the start spells exactly the substrings of `text`."""
    nxt: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    for state in nxt:
        for c, to in state.items():
            state[c] = nxt[to]
    return nxt[0]


def phrases(start: dict, text: str) -> int:
    """Number of longest-match phrases; an unseen character is a phrase of its own."""
    n, state, rest = 0, {}, iter(text)
    while True:
        try:
            for c in rest:
                state = state[c]
            return n
        except KeyError:
            n += 1
            state = start.get(c, {})


class Identifier:
    """Parses each word, with the blanks around it, once per worker and remembers its phrase counts in all languages."""

    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        self.starts = [suffix_automaton(f" {training[k]} ") for k in self.langs]
        #: A phrase of a text costs the logarithm of the places it can point to, so languages with less training text are not at a disadvantage.
        self.cost = np.array([np.log2(2 + len(training[k])) for k in self.langs])
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.empty((1024, len(self.langs)), np.int32)

    def _add(self, word: str) -> int:
        at = self.index[word] = len(self.index)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        spaced = f" {word} "
        self.table[at] = [phrases(s, spaced) for s in self.starts]
        return at

    def identify(self, text: str | None) -> tuple[str, float]:
        said = normalised(text).split()
        if not said or not self.langs:
            return UNKNOWN, 0.0
        if len(self.index) > REMEMBERED_WORDS:
            self._clear()
        seen, add = self.index.get, self._add
        ids = [i if (i := seen(w)) is not None else add(w) for w in said]
        counts = self.table[ids].sum(0, dtype=np.int64) * self.cost
        order = np.argsort(counts, kind="stable")
        return self.langs[order[0]], 1.0 if len(order) == 1 else float(1 - counts[order[0]] / counts[order[1]])


def training_text(labelled: DataFrame, chars_per_lang: int = CHARS_PER_LANG, docs_per_lang: int = DOCS_PER_LANG,
                  chars_per_doc: int = CHARS_PER_DOC) -> dict[str, str]:
    """Normalised text per language from (doc_id, text, lang) rows, bounded by the parameters."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (labelled.where("lang is not null and doc_id is not null").select("doc_id", "lang").withColumn("_rank", F.row_number().over(order))
              .where(F.col("_rank") <= docs_per_lang).drop("_rank"))
    ids = {r.doc_id: r.lang for r in picked.collect()}
    if not ids:
        return {}
    texts = labelled.where(F.col("doc_id").isin(list(ids))).select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"), F.substring("text", 1, chars_per_lang).alias("text"))
    parts: dict[str, list[str]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r._h, r.doc_id, r.text or "")):
        if r.lang == ids[r.doc_id]:
            parts.setdefault(r.lang, []).append(normalised(r.text)[:chars_per_doc])
    return {lang: t for lang, x in sorted(parts.items()) if (t := " ".join(filter(None, x))[:chars_per_lang])}


def identified(docs: DataFrame, training: dict[str, str], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row (all by default; a clashing `lang_pred` or `score` is replaced) and lang_pred, score."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(training)  # bounded by chars_per_lang times the number of languages
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    rows = docs.select(*names, F.col(text_col).cast("string").alias("__lang_said"))

    def task(batches):
        model = remembered(("languages", *shared.value.items()), lambda: Identifier(shared.value))
        for batch, texts in text_batches(batches, "__lang_said"):
            found = [model.identify(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                                             names=[*names, "lang_pred", "score"])

    return rows.mapInArrow(task, ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names), "lang_pred string", "score double"]))


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 4 == 2


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    training = training_text(docs.where(~held_out()))
    found = identified(docs, training, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
