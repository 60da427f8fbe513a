"""Counts of links."""

import random

import cases
from touchline.llm import jaccard


def test_every_link_of_a_document_is_counted(spark):
    """Groups of near copies with equal sets among them, against all pairs."""
    rng, rows = random.Random(11), []
    for g in range(5):
        base = [f"g{g}w{i}" for i in range(80)]
        for _ in range(10):
            ws = list(base)
            ws[rng.randrange(80)] = f"x{rng.randrange(30)}"
            rows.append(" ".join(ws))
        rows += [" ".join(base), " ".join(base).upper(), None, ""]
    sets = [{tuple(ws[i:i + 3]) for i in range(len(ws) - 2)} for ws in ((t or "").lower().split() for t in rows)]
    expected = {3 * i: sum(i != j and bool(a) and 100 * len(a & b) >= 90 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    docs = cases.documents(spark, rows=rows)
    got = jaccard.jaccard_components(docs).collect()
    assert {r.doc_id: r.n_links for r in got} == expected and max(expected.values()) >= 11
    plain = jaccard.jaccard_components(docs, links=False)
    assert plain.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, plain.collect())) == sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


def test_a_crowd_of_near_copies_is_not_paired_in_full(spark, monkeypatch):
    """Sets with other edits of one text meet in the same lists: few pairs are compared, components are those of all pairs."""
    rng, rows, compared = random.Random(12), [], []
    base = [f"w{i}" for i in range(400)]
    for _ in range(120):
        ws = list(base)
        for at in rng.sample(range(400), rng.choice([2, 4, 6, 8, 16])):
            ws[at] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(ws))
    sets = [{tuple(ws[i:i + 3]) for i in range(len(ws) - 2)} for ws in map(str.split, rows)]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 90 * len(a | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    plain = jaccard._overlaps
    monkeypatch.setattr(jaccard, "_overlaps", lambda pairs, sets: compared.append(pairs.count()) or plain(pairs, sets))
    got = jaccard.jaccard_components(cases.documents(spark, rows=rows), links=False).collect()
    assert {r.doc_id: r.component_id for r in got} == {3 * i: 3 * r for i, r in enumerate(root)}
    assert len(set(root)) < 80 and sum(compared) < 1000
