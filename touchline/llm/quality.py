r"""Quality rules by line labelling: a linear-chain conditional random field marks each line as content or boilerplate.

The two weight tables (line features and label transitions) are fitted by maximum likelihood on a bounded sample
of labelled documents, `fit_docs` per class and `FIT_LINES` lines of each. Labels are known per document only, so a line
gets a weak one (`weak_labels`): lines of a good document are content but for those that look like a menu entry, a repeat
or symbols, lines of a bad one are boilerplate but for those that look like a sentence. `label_lines` returns Viterbi's labels per line; `quality_digest` decides per document: it is
kept if at least `min_share` of its words stand in content lines and the fixed rules hold.

A null, empty or blank text has no line and fails the rules (fewer than 20 words). Repeated rows are decided each
on its own, documents without a label row only do not take part in fitting. Without labels of both classes
every line counts as content and the fixed rules alone decide. Columns besides id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.text import SPACE, per_text, text_batches

FIT_DOCS, FIT_LINES = 1500, 2000
MIN_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PCT, REPEAT_WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?"
FEATURES = 11
SEGMENT = 64


@dataclass(frozen=True)
class Crf:
    emit: np.ndarray      # (2, FEATURES)
    move: np.ndarray      # (2, 2)


def repeated_words(word_ids: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Marks the words that lie in a window of 8 words found twice or more. Ranks of 2, 4 and 8 words are exact, no hashing."""
    n = len(word_ids)
    marked = np.zeros(n, bool)
    if n <= window:
        return marked
    rank, width = word_ids.astype(np.int64), 1
    while width < window:
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        _, rank, count = np.unique(pair, return_inverse=True, return_counts=True)
        width *= 2
        if len(count) == len(rank):
            return marked
    twice = count[rank] > 1
    step = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:-1]) > 0


def describe(text: str | None) -> tuple[dict[str, int], np.ndarray, np.ndarray, list[bytes]]:
    """Counts of the fixed rules, features and word counts of each line that has a word, and those lines."""
    raw = (text or "").encode()
    lines = [(x, w) for x in raw.split(b"\n") if (w := x.split())]
    seen: set[bytes] = set()
    ids: dict[bytes, int] = {}
    n_dup = 0
    flat: list[int] = []
    dup = []
    for line, ws in lines:
        dup.append(line in seen)
        seen.add(line)
        flat += [ids.setdefault(w, len(ids)) for w in ws]
    n_dup = sum(dup)
    mask = repeated_words(np.array(flat, np.int64)) if len(ids) < len(flat) else np.zeros(len(flat), bool)
    n_words = np.array([len(w) for _, w in lines], np.int64)
    feats = np.zeros((len(lines), FEATURES))
    at = 0
    for i, (line, ws) in enumerate(lines):
        k, n = len(ws), len(line)
        dense = n - (k - 1)
        cut = lambda chars: n - len(line.translate(None, chars))
        end = line.rstrip()[-1:]
        feats[i] = (1.0, min(k, 60) / 60, min(dense / k, 20) / 20, min(1.0, 4 * cut(SYMBOLS) / n), cut(UPPER) / n, min(1.0, 4 * cut(DIGITS) / n),
                    min(1.0, 8 * cut(b"!") / n), end in (b".", b"!", b"?"), dup[i], mask[at:at + k].mean(), k <= 3)
        at += k
    whites = len(raw) - len(raw.translate(None, SPACE))
    counts = {"n_words": len(flat), "word_chars": len(text or "") - whites, "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
              "n_dup_lines": n_dup, "n_repeat_words": int(mask.sum())}
    return counts, feats, n_words, [x for x, _ in lines]


def viterbi(crf: Crf, feats: np.ndarray) -> np.ndarray:
    """The most probable labels; 1 is content. Ties go to content."""
    score = feats @ crf.emit.T
    n = len(score)
    if n < 2:
        return (score[:, 1] >= score[:, 0]).astype(np.int8)
    (m00, m01), (m10, m11) = crf.move.tolist()
    back = []
    a, b = score[0].tolist()
    for s0, s1 in score[1:].tolist():
        to0, to1 = b + m10 >= a + m00, b + m11 >= a + m01
        back.append((to0, to1))
        a, b = (b + m10 if to0 else a + m00) + s0, (b + m11 if to1 else a + m01) + s1
    labels = np.empty(n, np.int8)
    labels[-1] = y = int(b >= a)
    for t in range(n - 2, -1, -1):
        labels[t] = y = int(back[t][y])
    return labels


def weak_labels(feats: np.ndarray, good: int) -> np.ndarray:
    """1 for content: what the lines of a good or bad document most likely are, told by its label and their looks."""
    words, symbols, ends, again, repeated, short = feats[:, 1] * 60, feats[:, 3] / 4, feats[:, 7] > 0, feats[:, 8] > 0, feats[:, 9], feats[:, 10] > 0
    waste = again | (repeated > 0.5) | (symbols > 0.1) | (short & ~ends)
    sentence = ends & (words >= 8) & ~again & (repeated < 0.1) & (symbols < 0.02)
    return (~waste if good else sentence).astype(np.int64)


def fit(sequences: list[np.ndarray], labels: list[int], rounds: int = 200, rate: float = 0.1, l2: float = 1e-3) -> Crf:
    """Maximum likelihood by gradient steps; forward and backward passes run over all sequences at once. `labels` are the documents'."""
    said = [weak_labels(s, y) for s, y in zip(sequences, labels)]
    parts = [(s[i:i + SEGMENT], y) for s, y in zip(sequences, labels) for i in range(0, len(s), SEGMENT)]
    weak = [z[i:i + SEGMENT] for z in said for i in range(0, len(z), SEGMENT)]
    if len({y for _, y in parts}) < 2:
        return Crf(np.vstack([np.zeros(FEATURES), np.ones(FEATURES) * 1e-9]), np.zeros((2, 2)))
    width = max(len(s) for s, _ in parts)
    x, there, line = np.zeros((len(parts), width, FEATURES)), np.zeros((len(parts), width)), np.zeros((len(parts), width), np.int64)
    for i, ((s, _), z) in enumerate(zip(parts, weak)):
        x[i, :len(s)], there[i, :len(s)], line[i, :len(s)] = s, 1, z
    y = np.array([y for _, y in parts])
    weight = np.where(y == 1, 0.5 / there[y == 1].sum(), 0.5 / there[y == 0].sum())  # both classes count alike
    params = np.zeros(2 * FEATURES + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        emit, move = params[:2 * FEATURES].reshape(2, FEATURES), params[2 * FEATURES:].reshape(2, 2)
        score = x @ emit.T
        fwd, bwd = np.zeros_like(score), np.zeros_like(score)
        fwd[:, 0] = score[:, 0]
        for t in range(1, width):
            new = np.logaddexp(fwd[:, t - 1, :1] + move[0], fwd[:, t - 1, 1:] + move[1]) + score[:, t]
            fwd[:, t] = np.where(there[:, t, None] > 0, new, fwd[:, t - 1])
        total = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        for t in range(width - 2, -1, -1):
            nxt = score[:, t + 1] + bwd[:, t + 1]
            new = np.logaddexp(move[:, 0] + nxt[:, :1], move[:, 1] + nxt[:, 1:])
            bwd[:, t] = np.where(there[:, t + 1, None] > 0, new, bwd[:, t + 1])
        node = np.exp(fwd + bwd - total[:, None, None]) * there[:, :, None]
        wanted = np.eye(2)[line] * there[:, :, None]
        grad_emit = np.einsum("ntk,ntf,n->kf", wanted - node, x, weight)
        grad_move = np.zeros((2, 2))
        for a in range(2):
            for b in range(2):
                edge = np.exp(fwd[:, :-1, a] + move[a, b] + score[:, 1:, b] + bwd[:, 1:, b] - total[:, None]) * there[:, 1:]
                seen = (line[:, :-1] == a) & (line[:, 1:] == b)
                grad_move[a, b] = ((seen * there[:, 1:] - edge).sum(1) * weight).sum()
        grad = np.concatenate([grad_emit.ravel(), grad_move.ravel()]) - l2 * params
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params = params + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Crf(params[:2 * FEATURES].reshape(2, FEATURES), params[2 * FEATURES:].reshape(2, 2))


def fit_on(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Crf:
    """Fits on at most `fit_docs` labelled documents of each class, those with the smallest hashed ids."""
    known = labels.select("doc_id", F.col("quality").alias("_y")).where("doc_id is not null and _y in (0, 1)").groupBy("doc_id").agg(F.min("_y").alias("_y"))
    picked = [known.where(f"_y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs) for y in (0, 1)]
    chosen = {r.doc_id: r._y for p in picked for r in p.collect()}
    if not chosen:
        return fit([], [])
    rows = docs.where(F.col("doc_id").isin(list(chosen))).select("doc_id", F.col("text").cast("string").alias("text"))

    def task(batches):
        for batch, texts in text_batches(batches):
            found = [(i, f[:FIT_LINES]) for i, t in zip(batch.column("doc_id").to_pylist(), texts) if len(f := describe(t)[1])]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([f.astype("f4").tobytes() for _, f in found], pa.binary())],
                                             names=["doc_id", "f"])

    got = sorted((r.doc_id, bytes(r.f)) for r in rows.mapInArrow(task, "doc_id long, f binary").collect())
    return fit([np.frombuffer(f, "f4").reshape(-1, FEATURES).astype(float) for _, f in got], [chosen[i] for i, _ in got])


def label_lines(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that has a word: doc_id, line (from 0 among those), content, text."""

    def work(texts):
        out = []
        for t in texts:
            _, feats, _, lines = describe(t)
            out.append([{"line": i, "content": bool(y), "text": x.decode()} for i, (x, y) in enumerate(zip(lines, viterbi(crf, feats)))])
        return {"lines": pa.array(out, pa.list_(pa.struct([("line", pa.int64()), ("content", pa.bool_()), ("text", pa.string())])))}

    return per_text(docs, id_col, text_col, work, "lines array<struct<line: long, content: boolean, text: string>>").selectExpr("doc_id", "inline(lines)")


def quality_digest(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: the counts, the fixed rules' verdict, the share of words in content lines, kept."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def work(texts):
        out = {k: [] for k in (*names, "base_failed", "content_share", "kept")}
        for t in texts:
            counts, feats, per_line, _ = describe(t)
            n = counts["n_words"]
            failed = n < MIN_WORDS or 100 * counts["n_repeat_words"] > MAX_REPEAT_PCT * n
            share = float(per_line[viterbi(crf, feats) == 1].sum() / n) if n else 0.0
            for k, v in (*counts.items(), ("base_failed", failed), ("content_share", share), ("kept", not failed and share >= min_share)):
                out[k].append(v)
        kinds = {"base_failed": pa.bool_(), "content_share": pa.float64(), "kept": pa.bool_()}
        return {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}

    return per_text(docs, id_col, text_col, work, ", ".join(f"{n} long" for n in names) + ", base_failed boolean, content_share double, kept boolean")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_digest(docs, fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
