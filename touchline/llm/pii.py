r"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

`find_pii` returns one row per span of a document; `op9` reduces the same spans to one row per document.
Kinds with a fixed rule (email, ip, card, phone) are always reported when they are valid. Further kinds
are reported from `min_score` on: `iban` (mod 97), `ipv6` (as the address parser takes it), `national_id` (`ddd-dd-dddd`,
no reserved group), `local_phone` (no country prefix) and `secret` (20 or more key characters with letters and digits), of
which the last three need a word such as "ssn", "phone" or "token" close before them. A further span that overlaps one of
a fixed rule, or a further one that starts before it, is dropped: `+1 (555) 123-4567` is a phone and no local phone.

Null and empty texts have no span, a repeated row is treated like any other, columns besides the id and the
text are not read. Every scan is linear in the text: a run of digits or address characters is matched once.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.text import per_text, text_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ipv6", "national_id", "local_phone", "secret")
MIN_SCORE = 0.6
CONTEXT_CHARS = 48

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/=-]{20,}(?![A-Za-z0-9_+/=-])")
_DIGIT = re.compile(r"[0-9]")
_SEPARATORS = str.maketrans("", "", " -().+")
CONTEXT = {
    "card": re.compile(r"(?i)\b(?:card|credit|visa|mastercard|karte|tarjeta|carte)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|telefon|telefono|teléfono|téléphone)\b"),
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|address|server)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b"),
    "national_id": re.compile(r"(?i)\b(?:ssn|social security|national id)\b"),
    "ipv6": re.compile(r"(?i)\b(?:ip|ipv6|host|address|server)\b"),
    "secret": re.compile(r"(?i)(?:token|secret|password|passwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|bearer)"),
}
CONTEXT["local_phone"] = CONTEXT["phone"]
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ipv6": 0.6, "national_id": 0.4, "local_phone": 0.4, "secret": 0.4}
BOOST = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ipv6(address: str) -> bool:
    try:
        return len(address) > 2 and bool(ipaddress.IPv6Address(address))
    except ValueError:
        return False


def _emails(text: str):
    """Leftmost matches: each holds exactly one @, so the @ signs are visited in order."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    """A run of numbers joined by points gives its first four numbers, then the next four, and so on."""
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) >= 4:
            at = m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i:i + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                    yield at, end
                at = end + 1


def _proposed(text: str):
    if "@" in text:
        for span in _emails(text):
            yield "email", *span
    if _DIGIT.search(text):
        for span in _ips(text):
            yield "ip", *span
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().translate(_SEPARATORS)
                if 16 <= len(digits) <= 19 and luhn(digits):
                    yield "card", m.start(), m.end()
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(m.group().translate(_SEPARATORS)) <= 15:
                    yield "phone", m.start(), m.end()
        for m in _IBAN.finditer(text):
            if mod97(m.group()):
                yield "iban", m.start(), m.end()
        for m in _NATIONAL.finditer(text):
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                yield "national_id", m.start(), m.end()
        for m in _LOCAL_PHONE.finditer(text):
            yield "local_phone", m.start(), m.end()
        for m in _SECRET.finditer(text):
            if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group()):
                yield "secret", m.start(), m.end()
    if ":" in text:
        for m in _IPV6.finditer(text):
            if ipv6(m.group()):
                yield "ipv6", m.start(), m.end()


def spans(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind and start; offsets count code points."""
    found = []
    for kind, start, end in _proposed(text or ""):
        near = CONTEXT[kind].search(text, max(0, start - CONTEXT_CHARS), start)
        score = min(1.0, PRIOR[kind] + (BOOST if near else 0.0))
        if kind in BASE or score >= min_score:
            found.append((kind, start, end, score))
    kept = [x for x in found if x[0] in BASE]
    taken = sorted((a, b) for _, a, b, _ in kept)
    for x in sorted((x for x in found if x[0] not in BASE), key=lambda x: (x[1], KINDS.index(x[0]))):
        at = bisect.bisect_left(taken, (x[2],))  # spans from here on start at its end or later
        if not any(b > x[1] for _, b in taken[max(0, at - len(BASE) - 1):at]):
            kept.append(x)
            bisect.insort(taken, x[1:3])
    return sorted(kept, key=lambda x: (KINDS.index(x[0]), x[1]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per span: doc_id, kind, start, end, score, value."""

    def task(batches):
        for batch, texts in text_batches(batches):
            rows = [(i, *s, t[s[1]:s[2]]) for i, t in zip(batch.column("doc_id").to_pylist(), texts) for s in spans(t, min_score)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "kind", "start", "end", "score", "value"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, kind string, start long, end long, score double, value string")


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per input row: counts of the fixed kinds, digest of their spans, all spans as text."""

    def work(texts):
        found = [spans(t, min_score) for t in texts]
        counts = {f"n_{k}": pa.array([sum(s[0] == k for s in x) for x in found], pa.int64()) for k in BASE}
        joined = [",".join(f"{k}:{a}:{b}" for k, a, b, _ in x if k in BASE) for x in found]
        return counts | {"base_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()),
                         "spans": pa.array([",".join(f"{k}:{a}:{b}" for k, a, b, _ in x) for x in found], pa.string())}

    return per_text(docs, id_col, text_col, work, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
