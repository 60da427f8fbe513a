"""Language, quality rules and personal data: brute force, held-out accuracy, odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cases import SF, docs, duck, no_docs, odd_docs  # noqa: F401
from touchline.llm import langid, pii, quality

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(digits) <= 19 and total % 10 == 0,
                    "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_fixed_kinds_against_plain_patterns():
    rng = random.Random(1)
    parts = ["a@b.cc", "x.y@z-1.org.", "@", "a@b", "%w@q.r", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112",
             "+1 (988) 555-2485", "+12", "+1", " ", " ", "\n", "é", "7", "-", ".", "00.00.000.0255", "4041894974608795"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert [(k, a, b) for k, a, b, _ in pii.spans(text) if k in pii.BASE] == plain_base(text), text


def test_further_kinds_need_checksum_or_context():
    found = lambda t: [(k, t[a:b]) for k, a, b, _ in pii.spans(t) if k not in pii.BASE]
    assert found("pay to GB82 WEST 1234 5698 7654 32 now") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert found("pay to GB82 WEST 1234 5698 7654 33 now") == []
    assert found("my SSN is 219-09-9999") == [("national_id", "219-09-9999")]
    assert found("part 219-09-9999 of it") == [] and found("ssn 000-09-9999") == []
    assert found("phone: 988 555 2485") == [("local_phone", "988 555 2485")]
    assert found("988 555 2485") == []


def test_long_runs_stay_linear():
    assert pii.spans("1" * 200_000 + "." * 10 + "a" * 200_000 + "@") == []


def test_pii_rows(odd_docs, no_docs):
    rows = pii.pii_digest(odd_docs).collect()
    assert len(rows) == odd_docs.count() and pii.pii_digest(no_docs).count() == 0 and pii.find_pii(no_docs).count() == 0
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if not r.spans)


def plain_repeats(ws):
    at = {}
    for i in range(len(ws) - 7):
        at.setdefault(tuple(ws[i:i + 8]), []).append(i)
    return len({j for x in at.values() if len(x) > 1 for i in x for j in range(i, i + 8)})


def test_quality_counts_against_brute_force(odd_docs, no_docs, spark):
    crf = quality.fit([], [])
    texts = sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality_digest(odd_docs, crf).collect())
    want = []
    for i, t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n = plain_repeats(ws)
        failed = len(ws) < 20 or 100 * n > 30 * len(ws)
        want.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), n, failed, not failed))
    assert got == sorted(want)
    assert quality.quality_digest(no_docs, crf).count() == 0
    assert quality.label_lines(odd_docs, crf).where("content is null or text = ''").count() == 0


def test_repeated_words_random():
    rng = np.random.default_rng(2)
    for _ in range(300):
        ws = rng.integers(0, 2, rng.integers(0, 60))
        assert quality.repeated_words(ws).sum() == plain_repeats(ws.tolist())


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(3)
    for _ in range(100):
        crf = quality.Crf(rng.normal(size=(2, quality.FEATURES)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(rng.integers(0, 7), quality.FEATURES))
        best = max((sum(x[t] @ crf.emit[y[t]] for t in range(len(x))) + sum(crf.move[a, b] for a, b in zip(y, y[1:])), y)
                   for y in ([k >> t & 1 for t in range(len(x))] for k in range(1 << len(x))))
        assert quality.viterbi(crf, x).tolist() == best[1]


def test_quality_verdicts_follow_the_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    crf = quality.fit_on(docs, labels, fit_docs=40)
    chosen = quality.quality_digest(docs, crf).join(labels, "doc_id").where("not base_failed").groupBy("quality").avg("content_share").collect()
    share = {r.quality: r[1] for r in chosen}
    assert share[1] > 0.95 and share[0] < 0.2
    assert quality.fit_on(docs, labels.limit(0)) is not None


def test_automaton_knows_exactly_the_substrings():
    text = "abracadabra banana"
    start = langid.suffix_automaton(text)
    subs = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    rng = random.Random(4)
    for s in [*subs, *("".join(rng.choice("abnrd c") for _ in range(rng.randint(1, 6))) for _ in range(500))]:
        state = start
        for c in s:
            state = state.get(c) if state is not None else None
        assert (state is not None) == (s in subs)

    def greedy(s):
        n, i = 0, 0
        while i < len(s):
            k = 1
            while i + k < len(s) and s[i:i + k + 1] in subs:
                k += 1
            n, i = n + 1, i + k
        return n

    for _ in range(300):
        s = "".join(rng.choice("abnrd cz") for _ in range(rng.randint(1, 20)))
        assert langid.phrases(start, s) == greedy(s)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = langid.training_text(docs.where(~langid.held_out()))
    found = langid.identified(docs, training).where(langid.held_out() & (langid.F.length("text") > 60)).collect()
    assert len(found) > 100 and sum(r.lang_pred == r.lang for r in found) >= 0.98 * len(found)
    assert {r.doc_id for r in found} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}


def test_language_odd_rows(odd_docs, no_docs):
    model = {"en": "the house that we saw", "de": "das haus das wir sahen"}
    found = langid.identified(odd_docs, model)
    assert found.columns == [*(c for c in odd_docs.columns if c != "score"), "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter) and 0 <= r.score <= 1
    assert langid.identified(no_docs, model).count() == 0
    assert {r.lang_pred for r in langid.identified(odd_docs, {}).collect()} == {"und"}
    assert langid.training_text(no_docs) == {}


@pytest.mark.parametrize("name", ["op5_language_id", "op8_quality_rules", "op9_pii"])
def test_registered(spark, name):
    from touchline.llm.queries import QUERIES

    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
