"""Jaccard join, repeated passages, near-copy lines: SQL or brute force, odd rows."""

import hashlib
import random

import cases
import numpy as np
import pytest

from cases import SF, docs, duck, no_docs, odd_docs  # noqa: F401
from oracle_check import compare, connect
from touchline.llm import jaccard, lines, passages
from touchline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op1_jaccard_join", "op6_substring_dedup"])
def test_registered_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_jaccard_cases_against_sql(docs, duck):
    found = jaccard.jaccard_components(docs).drop("n_links")
    assert compare(found, duck, ORACLES["op1_jaccard_join"]) is None


def test_jaccard_other_parameters(spark):
    """Chains of near copies at 5 words and 80 percent, against all pairs."""
    rng = random.Random(6)
    rows = []
    for g in range(6):
        ws = [cases.word() for _ in range(60)]
        for _ in range(12):
            rows.append(" ".join(ws))
            ws = list(ws)
            ws[rng.randrange(60)] = f"w{rng.randrange(9)}"
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(cases.documents(spark, rows=rows), size=5, pct=80).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert found == {3 * i: 3 * find(i) for i in range(len(rows))}


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for n, m, k in ((1, 1, 0), (1, 1, 1), (70, 60, 30), (500, 450, 0), (500, 450, 449), (5000, 4100, 10), (5000, 4100, 3500)):
        own = rng.integers(-(1 << 63), (1 << 63) - 1, n + m - k)
        a, b = own[:n], own[n - k:]
        found = jaccard.unlike(jaccard.sketch(a), jaccard.sketch(b))
        assert found == jaccard.unlike(jaccard.sketch(b), jaccard.sketch(a)) <= n + m - 2 * k
        assert found > 0 or n + m == 2 * k or n + m < 3
        assert n < 500 or k > 10 or found > 0.2 * (n + m)  # a link at 80 percent has 0.112 at most


def test_long_texts_with_one_phrase_in_common_are_not_read(spark, monkeypatch):
    """Each two of 40 texts share one phrase of their own; the pairs are told before sets are read, links are found."""
    rng = random.Random(8)
    said = [[f"a{g}x{rng.randrange(10 ** 9)}" for _ in range(4000)] for g in range(40)]
    for g in range(40):
        for h in range(g):
            phrase = [f"p{g}x{h}x{i}" for i in range(5)]
            for ws, at in ((said[g], h), (said[h], g)):
                ws[20 * at:20 * at + 5] = phrase
    near = list(said[7])
    near[3900] = "changed"
    read, real = [], jaccard._overlaps
    monkeypatch.setattr(jaccard, "_overlaps", lambda pairs, sets: (read.append(pairs), real(pairs, sets))[1])
    found = jaccard.jaccard_components(cases.documents(spark, rows=[*map(" ".join, said), " ".join(near)]), size=5, pct=80)
    assert {r.doc_id: r.component_id for r in found.collect()} == {**{3 * i: 3 * i for i in range(40)}, 120: 21}
    assert {(r.x, r.y) for pairs in read for r in pairs.select("x", "y").collect()} <= {(21, 120), (120, 21)}


@pytest.mark.parametrize("words, size, pct", [(90, 1, 3), (230, 3, 90)])
def test_links_of_sets_at_the_border(spark, words, size, pct):
    """Texts that share more and more words from their start or end, against all pairs."""
    rng = random.Random(words + pct)
    base = [f"b{i}" for i in range(words)]
    rows = [base]
    for k in range(0, words + 1, 4):
        new = [f"n{k}x{i}x{rng.randrange(10 ** 9)}" for i in range(words - k)]
        rows += [base[:k] + new, new[:len(new) // 2] + base[words - k:]]
    sets = [{tuple(r[i:i + size]) for i in range(len(r) - size + 1)} or {tuple(r)} for r in rows]
    links = [[j for j in range(len(rows)) if j != i and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j])] for i in range(len(rows))]
    found = jaccard.jaccard_components(cases.documents(spark, rows=[" ".join(r) for r in rows]), size=size, pct=pct).collect()
    assert {r.doc_id: r.n_links for r in found} == {3 * i: len(links[i]) for i in range(len(rows))}
    seen: dict[int, int] = {}
    for i in range(len(rows)):
        todo = [i] if i not in seen else []
        while todo:
            at = todo.pop()
            if at not in seen:
                seen[at] = i
                todo += links[at]
    assert {r.doc_id: r.component_id for r in found} == {3 * i: 3 * c for i, c in seen.items()}


def test_jaccard_odd_rows(odd_docs, no_docs):
    rows = jaccard.jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_passages_cases_against_sql(docs, duck):
    found = passages.without_repeats(docs)
    found = found.select("doc_id", "n_words", "n_removed", passages.F.sha2("kept", 256).alias("kept_sha256"))
    assert compare(found, duck, ORACLES["op6_substring_dedup"]) is None


def test_texts_of_one_id_link_each_on_its_own(spark):
    """Components of rows, named by their smallest id, against plain sets."""
    base = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [(7, base), (7, other), (3, [*other, "x"]), (9, [*base, "y"]), (9, base), (9, base), (12, ["alone"]), (None, base), (7, None), (20, [*other, "z"])]
    docs = spark.createDataFrame([(i, None if t is None else " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()), key=str)
    expected = [(7, 58, 7), (7, 58, 3), (3, 59, 3), (9, 59, 7), (9, 58, 7), (9, 58, 7), (12, 1, 12), (None, 58, None), (7, 0, 7), (20, 59, 3)]
    assert got == sorted(expected, key=str)


def test_passages_odd_rows(odd_docs, no_docs):
    rows = passages.without_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.n_removed <= r.n_words for r in rows)
    assert passages.without_repeats(no_docs).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_keys_and_parity():
    rng = random.Random(3)
    for _ in range(5000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(4, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(b))
            b[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "c", "b"])
        b = "".join(b) or "a"
        d = edits(a, b)
        bits = lines.parities([a, b])
        assert bin(int(bits[0] ^ bits[1]) & (1 << 64) - 1).count("1") <= 2 * d
        for k in range(4):
            assert lines.within(a, b, k) == (d <= k)
            short, long = sorted((a, b), key=len)
            if d <= k < len(short):
                assert set(lines.keys(short, k)[0]) & set(lines.keys(long, k)[1])


def plain_lines(rows, max_edits, min_chars):
    """{(doc_id, text): removed line numbers} by comparing all pairs of lines."""
    first, at = {}, {}
    for i, th, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0)):
        at[i, t] = [(n, s) for n, x in enumerate((t or "").split("\n")) if len(s := " ".join(x.split())) >= min_chars]
        for n, s in at[i, t]:
            first.setdefault(s, (i, t, n))
    order = {s: k for k, s in enumerate(first)}
    near = {s for s in first if any(order[u] < order[s] and abs(len(u) - len(s)) <= max_edits and edits(u, s) <= max_edits for u in first)}
    return {key: [n for n, s in x if first[s] != (*key, n) or s in near] for key, x in at.items()}


def test_lines_against_all_pairs(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdef ") for _ in range(40)).strip() + "xyz" for _ in range(8)]
    rows = []
    for _ in range(40):
        out = []
        for _ in range(rng.randint(0, 5)):
            s = list(rng.choice(base))
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(s))
                s[i:i + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
            out.append("".join(s))
        rows.append("\n".join(out))
    docs = cases.documents(spark, rows=[*rows, None, "", rows[0]])
    want = plain_lines([(r.doc_id, r.th, r.text) for r in docs.select("doc_id", "text", lines.F.xxhash64("text").alias("th")).collect()], 2, 20)
    done = lines.dedup_lines(docs, min_chars=20).collect()
    for r, t in zip(sorted(done, key=lambda r: r.doc_id), [*rows, None, "", rows[0]]):
        gone = want[r.doc_id, t]
        assert r.n_removed == len(gone) and r.n_lines == (t.count("\n") + 1 if t is not None else 0)
        assert r.text == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone))
    assert sum(r.n_removed for r in done) > 20


def test_lines_odd_rows(odd_docs, no_docs):
    done = lines.dedup_lines(odd_docs)
    assert done.count() == odd_docs.count() and set(done.columns) == {*odd_docs.columns, "n_lines"}
    assert lines.dedup_lines(no_docs).count() == 0


def test_op7_registered_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in QUERIES["op7_line_dedup"](spark, SF).collect()}
    occ = {}
    said = {r.doc_id: lines.long_lines(r.text, lines.MIN_CHARS) for r in docs}
    for i in sorted(said):
        for n, s in said[i]:
            occ.setdefault(s, (i, n))
    by_length = {}
    for s in occ:
        by_length.setdefault(len(s), []).append(s)
    near = {s for s in occ if any(occ[u] < occ[s] and lines.within(s, u, 2) for k in range(-2, 3) for u in by_length.get(len(s) + k, ()) if u[:9] == s[:9] or u[-9:] == s[-9:])}
    for r in docs:
        gone = {n for n, s in said[r.doc_id] if occ[s] != (r.doc_id, n) or s in near}
        kept = "\n".join(x for n, x in enumerate((r.text or "").split("\n")) if n not in gone)
        assert got[r.doc_id] == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
