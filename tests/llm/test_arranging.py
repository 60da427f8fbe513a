"""Mixing, packing, token files, top-k: SQL, round trips, odd rows."""

import math
import random
import zlib

import cases
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import SF, docs, duck, no_docs, odd_docs  # noqa: F401
from oracle_check import compare, connect
from touchline.llm import mixing, orc_tokens, packing, topk
from touchline.llm.queries import ORACLES, QUERIES
from touchline.llm.tokens import WordEncoder
from touchline.sinks.shared import shared_dir


@pytest.fixture(scope="module")
def tokenizer():
    return WordEncoder().tokenizer


def plain_ids(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_words_encode_like_whole_texts(tokenizer):
    rng = random.Random(1)
    alphabet = [*"aA.,'sStTé́ßςΣ \n\t\x0b\x0c\x1c\x85\xa0İI1٣-中𝔘ﬁ", "<|endoftext|>", "<|STARTOFTEXT|>", "the, ", "don't "]
    encoder = WordEncoder()
    for _ in range(1500):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(2)] + [None]
        ids, n = encoder.encode(texts, 1)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [plain_ids(tokenizer, t, 1) for t in texts]
    encoder._clear()
    assert encoder.encode(["again", None])[1].tolist() == [1, 0]


def test_closing_marks_do_not_make_new_words(tokenizer):
    """One word under many closing marks is learned once; its ids are those of the whole text."""
    rng, encoder = random.Random(2), WordEncoder()
    marks = [*".,;:!?#$%&*+=@~()[]{}\"/-", "...", "!?", ".###", "-'", "'s", "'ll.", "`", "<", "|>", "…", "é.", "1,", "x̸", "≠"]
    texts = [" ".join("word" + "".join(rng.choices(marks, k=rng.randint(0, 4))) for _ in range(20)) for _ in range(300)]
    ids, n = encoder.encode(texts, 1)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [plain_ids(tokenizer, t, 1) for t in texts]
    encoder._clear()
    encoder.encode([f"word{m}" for m in "$#%&*"])
    assert len(encoder.index) == 6


@pytest.mark.parametrize("name", ["op2_mixing", "op3_top_k"])
def test_registered_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_targets_share_the_excess():
    for sizes in ([10, 20, 30], [0, 5], [1], [], [1000, 1, 1, 1], [3, 900, 4]):
        t = mixing.targets(sizes)
        assert math.isclose(sum(t), 1.5 * sum(sizes), rel_tol=1e-9) and all(x <= 2 * s for x, s in zip(t, sizes))
        open_ = [x / (3, 1, 2)[i % 3] for i, (x, s) in enumerate(zip(t, sizes)) if x < 2 * s]
        assert not open_ or math.isclose(min(open_), max(open_), rel_tol=1e-9)


def test_quotas_are_exact():
    q = mixing.split_quotas([100, 7, 0, 53], 8)
    assert q.sum(1).tolist() == [100, 7, 0, 53] and q.sum(0).max() - q.sum(0).min() <= 1
    assert (q == mixing.split_quotas([100, 7, 0, 53], 8)).all()


def test_mixing_cases(docs, odd_docs, no_docs, duck):
    mixed = mixing.mix(docs)
    assert compare(mixed.drop("source", "th", "draws"), duck, ORACLES["op2_mixing"]) is None
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(d.words for d in r.draws)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture(no_docs, mixing.mix(no_docs)).count() == 0
    assert mixing.mixture(docs, mixed).columns == docs.columns
    for table in (docs, odd_docs):
        drawn = mixing.mix(table)
        words = mixing.mixture(table, drawn).groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n"))
        taken = drawn.groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0")
        assert {r.doc_id: r.n for r in words.collect()} == {r.doc_id: r.n for r in taken.collect()}


def test_texts_of_one_id_are_drawn_each_on_its_own(spark):
    rows = [(1, "a b c d", "s"), (1, "x y", "s"), (1, "x y", "s"), (2, "p q r", "t"), (None, "n m", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = mixing.mix(docs)
    per_text = {r.th: r.n for r in drawn.groupBy("th").agg(F.sum("taken").alias("n")).where("n > 0").collect()}
    made = mixing.mixture(docs, drawn)
    total = sum(len(r.text.split()) for r in made.collect())
    assert total == sum(per_text.values())
    first = {t: {r.th for r in docs.select(F.xxhash64("text").alias("th"), "text").where(F.col("text") == t).collect()} for t in ("a b c d", "x y")}
    words = {t: sum(len(r.text.split()) for r in made.collect() if r.text.split()[0] == t.split()[0]) for t in first}
    assert all(words[t] == per_text.get(next(iter(h)), 0) for t, h in first.items())


def test_only_cut_and_repeated_rows_are_joined_with_their_draws(spark, odd_docs, monkeypatch):
    """The mixture in one shuffle of its texts is the mixture of `mix`, places included."""
    rows = [(i, f"w{i} " * (1 + i % 7), "stu"[i % 3]) for i in range(3000)] + [(5, "w5 " * 6, "s"), (5, "w5 " * 6, None), (7, "another", "t"), (None, "n m", "t"), (None, None, "u")]
    some = spark.createDataFrame(rows, "doc_id long, text string, source string")
    joined, real = [], mixing._taken
    for docs in (some, odd_docs, some.limit(0)):
        whole = mixing.mixture(docs, mixing.mix(docs))
        monkeypatch.setattr(mixing, "_taken", lambda docs, *more: (joined.append(docs), real(docs, *more))[1])
        direct = mixing.mixed_documents(docs)
        monkeypatch.setattr(mixing, "_taken", real)
        assert direct.columns == docs.columns
        assert sorted(map(repr, direct.collect())) == sorted(map(repr, whole.collect()))
    assert {(r.doc_id, r.text) for r in joined[0].collect()} >= {(5, "w5 " * 6)}
    assert joined[0].count() < 30


def check_pieces(pieces, texts, tokenizer, window):
    """Every id of every document in exactly one piece, sequences gapless and within the window."""
    want = {i: plain_ids(tokenizer, t, 1) for i, t in texts.items()}
    got, sequences = {}, {}
    for p in pieces:
        ids = want[p.doc_id][p.start:p.start + p.length]
        assert p.length > 0 and len(ids) == p.length and p.doc_tokens == len(want[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        got.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(got) == set(want)
    for spans, total in [(x, len(want[i])) for i, x in got.items()] + [(x, None) for x in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total is not None else at <= window
    return sum(len(x) for x in want.values()), len(sequences)


def test_packing_cases(docs, odd_docs, no_docs, tokenizer):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for window, shard_chars in ((2048, packing.SHARD_CHARS), (64, 20_000)):
        tokens, sequences = check_pieces(packing.packed(docs, window=window, shard_chars=shard_chars).collect(), texts, tokenizer, window)
        assert sequences <= tokens // window + 12
    assert packing.packed(no_docs).count() == 0
    pieces = packing.packed(odd_docs).collect()
    per_row = sum(len(plain_ids(tokenizer, r.text, 1)) for r in odd_docs.collect())
    assert sum(p.length for p in pieces) == per_row == sum(len(p.ids) for p in pieces)


def test_packing_prefers_lexical_neighbours():
    about = [["river", "boat", "water"], ["stock", "bond", "market"]]
    rng = random.Random(9)
    texts = [" ".join(rng.choice(about[i % 2]) for _ in range(20)) for i in range(40)]
    ids, n = WordEncoder().encode(texts, 1)
    pieces = packing.fill(n, packing.Bm25(ids, n), 64)
    same = [a[0] % 2 == b[0] % 2 for a, b in zip(pieces, pieces[1:]) if a[3] == b[3]]
    assert sum(same) >= 0.9 * len(same)


def test_packing_registered(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens, sequences = check_pieces(QUERIES["op4_packing"](spark, SF).collect(), texts, tokenizer, 2048)
    assert sequences <= tokens // 2048 + 2


def check_starts(rows, docs, tokenizer):
    at = 0
    want = []
    for r in sorted(docs, key=lambda r: r.doc_id):
        ids = plain_ids(tokenizer, r.text, 2)
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_orc_round_trip(spark, docs, odd_docs, no_docs, tokenizer):
    home = f"{shared_dir(spark)}/test-orc-{random.random()}"
    orc_tokens.write_tokens(docs, f"{home}/a", 2)
    rows = orc_tokens.read_tokens(spark, f"{home}/a")
    check_starts(orc_tokens.token_starts(rows).collect(), docs.collect(), tokenizer)
    one = orc_tokens.read_tokens(spark, f"{home}/a", [18])
    assert [r.ids for r in one.collect()] == [plain_ids(tokenizer, docs.where("doc_id = 18").first().text, 2)]
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in one._jdf.queryExecution().toString()
    orc_tokens.write_tokens(odd_docs, f"{home}/b", 2)
    starts = orc_tokens.token_starts(orc_tokens.read_tokens(spark, f"{home}/b")).orderBy("start").collect()
    ids = [r.doc_id for r in starts]
    assert len(ids) == odd_docs.count() and ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in starts] == [sum(r.n_tokens for r in starts[:k]) for k in range(len(starts))]
    orc_tokens.write_tokens(no_docs, f"{home}/c", 2)
    assert orc_tokens.token_starts(orc_tokens.read_tokens(spark, f"{home}/c")).count() == 0


def test_orc_registered(spark, tokenizer):
    check_starts(QUERIES["op10_orc_tokens"](spark, SF).collect(), spark.read.parquet(f"{SF}/documents.parquet").collect(), tokenizer)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int, block string")


def top(spark, frame, **kw):
    v = topk.integers(frame).cache()
    home = f"{shared_dir(spark)}/test-topk-{random.random()}"
    pivots = topk.pick_pivots([(r.dim, bytes(r.v)) for r in v.limit(50).collect()], 5)
    return topk.search(v.where("vec_id % 100 = 0"), topk.build_index(v, home, pivots, 16), pivots, query_rows=3, **kw)


def test_top_k_cases_against_sql(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * (1 + i % 3)).astype("f4").tolist(), 1, 2, "x") for i in range(400)]
    rows += [(1000 + i, rows[7][1], None, None, None) for i in range(60)]  # ties
    rows += [(2000, None, 1, 1, "x"), (2100, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 1, "x"), (2200, [float("nan")] * 6, 1, 1, "x"), (2300, [float("inf")] * 6, 1, 1, "x"),
             (2400, [1.0, 2.0], 1, 1, "x"), (2401, [0.5, 2.0], 1, 1, "x"), (2500, [], 1, 1, "x"), (None, rows[0][1], 1, 1, "x")]
    frame = vectors(spark, rows)
    con = duckdb.connect()
    con.register("embeddings", frame.toArrow())
    assert compare(top(spark, frame), con, ORACLES["op3_top_k"]) is None


def test_top_k_odd_tables(spark):
    assert top(spark, vectors(spark, [])).count() == 0
    rows = [(0, [1.0, 1.0], 1, 1, "x")] * 5 + [(5, [2.0, 2.0], 1, 1, "x"), (100, [1.0, 0.0], 1, 1, "x")]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top(spark, vectors(spark, rows)).collect())
    k = 1024 * 1024
    assert found == [(0, 1, 5, 4 * k), (0, 2, 100, k), (100, 1, 5, 2 * k), (100, 2, 0, k)]
    big = topk._products(np.array([[1 << 40, 1]]), np.array([[3, 5]]))
    assert big.tolist() == [[(3 << 40) + 5]]
