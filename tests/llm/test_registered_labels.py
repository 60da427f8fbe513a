"""op5, op8 and op9 as registered, against plain versions of the same rules."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from cases import SF
from touchline.llm import langid, pii, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def collected(spark, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}


# -- op5 ---------------------------------------------------------------------------

def plain_phrases(spaced, known):
    """Greedy longest phrases by plain substring search; an unseen character is a phrase of its own."""
    n, at = 0, 0
    while True:
        k = at
        while k < len(spaced) and spaced[at:k + 1] in known:
            k += 1
        n += 1
        if k == len(spaced):
            return n
        at = max(k, at + 1)


def test_op5_against_substring_search(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    training = langid.training_text(docs.where(~langid.held_out()))
    got, memory = collected(spark, "op5_language_id"), {}
    for i, text in texts.items():
        said = langid.normalised(text).split()
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not said:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        elif len(said) < 150:
            cost = {}
            for lang, t in training.items():
                known = f" {t} "
                for w in said:
                    if (lang, w) not in memory:
                        memory[lang, w] = plain_phrases(f" {w} ", known)
                cost[lang] = sum(memory[lang, w] for w in said) * np.log2(2 + len(t))
            best = sorted(cost, key=lambda k: (cost[k], k))
            assert got[i].lang_pred == best[0] and got[i].score == pytest.approx(1 - cost[best[0]] / cost[best[1]])


def test_little_training_text_is_no_disadvantage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = langid.training_text(docs.where(~langid.held_out()))
    training["de"] = training["de"][:600]
    found = langid.identified(docs, training).where(langid.held_out() & (langid.F.length("text") > 60) & langid.F.col("lang").isNotNull()).collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    german = [r for r in found if r.lang == "de"]
    assert sum(r.lang_pred == "de" for r in german) >= 0.9 * len(german)


# -- op8 ---------------------------------------------------------------------------

def plain_labels(crf, feats):
    """The best of all label paths by plain dynamic programming over (score, path) pairs."""
    best = {y: (float(feats[0] @ crf.emit[y]), [y]) for y in (0, 1)}
    for f in feats[1:]:
        best = {y: max(((best[z][0] + crf.move[z, y] + float(f @ crf.emit[y]), best[z][1] + [y]) for z in (0, 1)), key=lambda x: x[0]) for y in (0, 1)}
    return max(best.values(), key=lambda x: x[0])


def test_op8_against_plain_counts_and_paths(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    crf = quality.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for i, r in collected(spark, "op8_quality_rules").items():
        text = texts[i] or ""
        ws = WORD.findall(text)
        seen, dup = set(), 0
        lines = [x for x in text.split("\n") if WORD.search(x)]
        for x in lines:
            dup += x in seen
            seen.add(x)
        where = {}
        for k in range(len(ws) - 7):
            where.setdefault(tuple(ws[k:k + 8]), []).append(k)
        marked = {k + j for at in where.values() if len(at) > 1 for k in at for j in range(8)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))
        assert r.base_failed == (len(ws) < 20 or 100 * len(marked) > 30 * len(ws))
        if lines and len(ws) < 2000:
            _, feats, per_line, _ = quality.describe(text)
            score, path = plain_labels(crf, feats)
            mine = quality.viterbi(crf, feats)
            assert sum(float(f @ crf.emit[y]) for f, y in zip(feats, mine)) + sum(crf.move[a, b] for a, b in zip(mine, mine[1:])) == pytest.approx(score)
            share = per_line[mine == 1].sum() / len(ws)
            assert r.content_share == pytest.approx(share) and r.kept == (not r.base_failed and share >= quality.MIN_SHARE)


def test_a_page_with_menu_and_text_gets_both_labels(spark):
    crf = quality.fit_on(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    menu = ["$$$ %%% Home ***", "||| Menu |||", "*** Login ***", "### Cart ###", "<<< Back"] * 3
    text = ["Here is a sentence of an article that goes on for quite a number of words.", "The next one ends in a full stop as well, which is what sentences do.",
            "A third line of the same kind follows, with other words than those before.", "It would be a short article indeed if it ended after only three of them.",
            "So there is a fifth line, and after it the foot of the page comes into view.", "Nobody reads on from here, but the labels have to change once more."]
    labels = quality.viterbi(crf, quality.describe("\n".join([*menu, *text, *menu]))[1])
    assert labels[:len(menu)].sum() == 0 and labels[len(menu):len(menu) + len(text)].sum() >= len(text) - 1 and labels[-len(menu):].sum() == 0


# -- op9 ---------------------------------------------------------------------------

def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(d := re.sub(r"\D", "", s)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub(r"\D", "", s)) <= 15),
}


def test_op9_against_the_plain_patterns(spark, texts):
    for i, r in collected(spark, "op9_pii").items():
        found = [(kind, m.start(), m.end()) for kind, (pattern, good) in RULES.items() for m in re.finditer(pattern, texts[i] or "") if good(m.group())]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in found) for kind in RULES)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
        listed = [x.split(":") for x in r.spans.split(",")] if r.spans else []
        assert [(k, int(a), int(b)) for k, a, b in listed if k in RULES] == found
        more = [(int(a), int(b)) for k, a, b in listed if k not in RULES]
        assert all(b <= c or d <= a for a, b in more for _, c, d in found)


@pytest.mark.parametrize("text, expected", [
    ("phone +1 (555) 123-4567", ["phone:6:23"]), ("phone (555) 123-4567", ["local_phone:6:20"]), ('token = "24be64aa99ff0011223344"', ["secret:9:31"]),
    ("24be64aa99ff0011223344", []), ("at 2001:db8::1 and 12:30:45", ["ipv6:3:14"]), ("host ::1, not ::", ["ipv6:5:8"]), ("password abcdefghijklmnopqrstuvwxyz", []),
    ("iban GB82 WEST 1234 5698 7654 32", ["iban:5:32"]),
])
def test_further_kinds(text, expected):
    assert [f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(text)] == expected
