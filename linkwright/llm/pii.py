"""Personal data and secrets: patterns propose spans, validators confirm them, context adjusts the score.

A span's score is its pattern's prior, plus a gain if its validator passes, plus a gain if a context word of its kind stands
within WINDOW code points of it. Base kinds (email, ip, card, phone) stay whatever their score, once their check passes; their
context only tells how sure they are. The method adds kinds whose score must reach ACCEPT: IBANs (mod-97), US social security numbers
(which need context), and secrets (well-known key formats, or random-looking values assigned to a name that says so). The end
of an IBAN is looked for at its country's length first, then at every end of a word, the longest one first.

Defined cases: a null or empty text has no span; a text may be of any length (every pattern runs in linear time); repeated
rows each give a row; an empty table gives an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import map_arrow, text_input

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]
ACCEPT = 0.6
#: Code points before and after a span in which context words count.
WINDOW = 48
#: kind: prior of the pattern, gain by a passed validator, gain by context.
SCORES = {
    "email": (0.6, 0.2, 0.2),
    "ip": (0.3, 0.3, 0.4),
    "card": (0.2, 0.5, 0.3),
    "phone": (0.3, 0.3, 0.4),
    "iban": (0.3, 0.4, 0.3),
    "ssn": (0.3, 0.0, 0.4),
    "secret": (0.4, 0.3, 0.3),
}
_WORDS = {
    "email": "e-?mail|mail|contact|correo|courriel|write to",
    "ip": "ip|address|server|host|login|logged",
    "card": "card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|t[eé]l[eé]fono|t[eé]l[eé]phone|handy",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "ssn": "ssn|social security|social",
    "secret": "token|secret|password|passwd|api|key|auth|bearer|credential",
}
CONTEXT = {kind: re.compile(rf"\b(?:{words})\b", re.I) for kind, words in _WORDS.items()}
#: Shannon entropy in bits a character from which an assigned value looks random.
RANDOM_BITS = 3.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
# a match can only begin where a run of digits does: from inside the run the same dots would have to follow
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ASSIGNED = re.compile(r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_/+.=-]{16,256}+)")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{20,72})(?![A-Za-z0-9])|-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----")
#: Lengths of IBANs by country, as the standard fixes them.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """All matches end their local part at an @, so each @ is tried once with the longest local part
    that the match before leaves free."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((a, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return found


def _iban_end(match: str) -> int | None:
    """Where the IBAN that a match begins with ends, or None."""
    ends, n = {}, 0
    for i, c in enumerate(match):
        n += c != " "
        if c != " ":
            ends[n] = i + 1
    word_ends = [n for n in ends if n == len(ends) or match[ends[n]] == " "]
    own = IBAN_LENGTHS.get(match[:2])
    for n in ([own] if own in word_ends else []) + sorted(word_ends, reverse=True):
        if mod97(match[: ends[n]]):
            return ends[n]
    return None


def _ibans(text: str, at: int) -> list[tuple[int, int, bool]]:
    """start, end and whether the checksum holds of the candidates from at on."""
    found = []
    while m := _IBAN.search(text, at):
        whole = m[0]
        if m.end() < len(text) and text[m.end()].isascii() and text[m.end()].isalnum():  # the last word goes on
            whole = whole[: max(whole.rfind(" "), 0)]
        end = _iban_end(whole) if whole else None
        found.append((m.start(), m.start() + (end or len(whole)), end is not None))
        at = m.start() + (end or 2)
    return found


def _looks_random(value: str) -> bool:
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return bits >= RANDOM_BITS and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def spans_of(text: str) -> list[tuple[int, int, str, float]]:
    """start, end (code points), kind and score of every accepted span."""
    found: list[tuple[int, int, str, float]] = []

    def propose(a: int, b: int, kind: str, valid: bool) -> None:
        prior, sure, near = SCORES[kind]
        around = text[max(0, a - WINDOW) : a] + " " + text[b : b + WINDOW]
        score = prior + (sure if valid else 0) + (near if CONTEXT[kind].search(around) else 0)
        if kind in BASE or score >= ACCEPT:
            found.append((a, b, kind, round(score, 6)))

    if "@" in text:
        for a, b in _emails(text):
            propose(a, b, "email", True)
    if "PRIVATE KEY-----" in text:
        for m in _KEY.finditer(text):
            propose(m.start(), m.end(), "secret", True)
    first = _DIGIT.search(text)
    if first is not None:
        lo = first.start()
        if text.count(".", lo) >= 3:
            for m in _IP.finditer(text, lo):
                if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
                    propose(m.start(), m.end(), "ip", True)
        for m in _CARD.finditer(text, lo):
            if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                propose(m.start(), m.end(), "card", True)
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    propose(m.start(), m.end(), "phone", True)
        for a, b, valid in _ibans(text, max(0, lo - 2)):
            if valid:
                propose(a, b, "iban", True)
        for m in _SSN.finditer(text, lo):
            propose(m.start(), m.end(), "ssn", False)
        if "PRIVATE KEY-----" not in text:
            for m in _KEY.finditer(text):
                propose(m.start(), m.end(), "secret", True)
        if "=" in text or ":" in text:
            taken = {(a, b) for a, b, kind, _ in found if kind == "secret"}
            for m in _ASSIGNED.finditer(text):
                if m.span(1) not in taken and _looks_random(m[1]):
                    propose(*m.span(1), "secret", True)
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda x: (x[0], order[x[2]], x[1]))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of start, end, kind, score, in code points, end exclusive) per row."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())])))])

    def make(batch):
        rows = [[dict(zip(("start", "end", "kind", "score"), s)) for s in spans_of(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, schema.field("spans").type)], schema=schema)

    return map_arrow(text_input(docs), make, "doc_id long, spans array<struct<start:long,end:long,kind:string,score:double>>")


def pii_digest(docs: DataFrame) -> DataFrame:
    """The counts and digests of the spans, one row per input row; n_spans counts all of them, n_added those of the method."""
    fields = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64()), ("n_added", pa.int64())]
    schema = pa.schema(fields)
    joined = lambda spans: ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in spans)

    def make(batch):
        cols = [[] for _ in fields[1:]]
        for text in batch.column("text").to_pylist():
            spans = spans_of(text)
            base = [s for s in spans if s[2] in BASE]
            row = [sum(s[2] == k for s in base) for k in BASE]
            row += [hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans), len(spans) - len(base)]
            for c, v in zip(cols, row):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f[1]) for c, f in zip(cols, fields[1:]))], schema=schema)

    kinds = {pa.int64(): "long", pa.string(): "string"}
    return map_arrow(text_input(docs), make, ", ".join(f"{name} {kinds[t]}" for name, t in fields))
