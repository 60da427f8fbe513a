"""The pipeline's stages against what they promise, on the documents and on odd rows."""

import corpus_pipeline as P
import pytest

from cases import SF, docs, duck, no_docs, odd_docs  # noqa: F401
from touchline.llm import orc_tokens, text
from touchline.sinks.shared import written


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES[:-1]:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns_and_stages(steps):
    assert [n for n, _ in P.STAGES] == ["language", "line_dedup", "near_duplicates", "mixing", "packing"]
    for df in steps:
        assert df.columns == P.COLUMNS


def test_language_rejects_only_what_has_none(steps):
    kept = {r.doc_id for r in steps[1].collect()}
    for r in steps[0].collect():
        if r.doc_id not in kept:
            assert sum(c.isalpha() for c in r.text or "") < 40


def test_lines_change_texts_and_keep_first_copies(steps):
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[1:3])
    assert set(after) <= set(before)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(before[i].text.split("\n"))


def test_one_document_of_each_group_stays(steps):
    before, after = ({r.doc_id: set(zip(*(r.text.split()[k:] for k in range(5)))) or {r.text} for r in df.collect()} for df in steps[2:4])
    close = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    kept = list(after)
    assert not any(close(after[a], after[b]) for n, a in enumerate(kept) for b in kept[:n])
    links = {i: [j for j in before if j != i and close(before[i], before[j])] for i in before}
    for i in set(before) - set(after):
        assert links[i]
    assert {i for i in before if not links[i]} <= set(after)


def test_mixing_draws_each_source_to_its_target(steps):
    n = sum(len(r.text.split()) for r in steps[3].collect())
    drawn = sum(len(r.text.split()) for r in steps[4].collect())
    assert abs(drawn - 1.5 * n) <= 0.02 * n


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert P.run(spark, SF).count() > 0
    for table in (odd_docs, no_docs):
        docs = table
        for name, stage in P.STAGES:
            docs = written(stage(spark, docs, SF), f"test-odd-{name}")
        assert (docs.count() > 0) == (no_docs is not table)


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """Only copies go: of near and exact ones one stays, whatever their ids; different texts of one id all stay."""
    base = " ".join(f"w{i}" for i in range(200))
    near = base.replace("w77 ", "changed ")
    rows = [(1, base), (1, "another text of the same id altogether, in some eight words"), (1, "another text of the same id altogether, in some eight words"), (2, near), (3, "nothing like the others in any way at all"),
            (None, "no id here but quite a text of its own"), (None, base), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = sorted((r.text or str(r.text) for r in P.near_duplicates(spark, docs, SF).collect()))
    assert sum(t in (base, near) for t in left) == 1 and len(left) == 6
    assert {t for t in left if t not in (base, near)} == {rows[1][1], rows[4][1], rows[5][1], "None", ""}


def test_working_tables_of_a_stage_go_with_the_next(spark, docs):
    out = written(P.STAGES[1][1](spark, docs.select(*P.COLUMNS), SF), "test-stage")
    paths = list(P._WORKING)
    assert paths and all(spark.read.parquet(p).schema for p in paths)
    written(P.STAGES[3][1](spark, out, SF), "test-stage")
    assert not set(paths) & set(P._WORKING)
    for p in paths:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(p)


def test_registered():
    import __spark_entry__ as entry

    queries = entry.queries()
    assert "pipeline" in queries and sum(k.startswith("op") and k[2].isdigit() for k in queries) == 13
    assert {k for k in entry.oracle_sql() if k[:2] == "op" and k[2].isdigit()} == {"op1_jaccard_join", "op2_mixing", "op3_top_k", "op6_substring_dedup", "op11_prefix_trie", "op12_vector_codes"}


def test_a_worker_keeps_the_memory_of_one_operator():
    """Words learned by one stage go when a task of another stage begins in the same worker."""
    said = text.word_hashes()
    assert text.word_hashes() is said
    words = orc_tokens.encoder(None)
    assert orc_tokens.encoder(None) is words and list(text._MEMORY.values()) == [words]
    assert text.word_hashes() is not said and len(text._MEMORY) == 1
