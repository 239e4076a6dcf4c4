"""Personal data by anchor expansion.

One Aho-Corasick pass over a text yields anchors: at-signs, schemes, plus signs before a
digit, digit pairs, digits before a dot, and words that announce an identifier. At each
anchor a local, deterministic parser expands to the item's boundaries and validates it
(a card's Luhn sum, an address's octets, an IBAN's remainder). A parser never looks
behind what its own kind has consumed, so each kind is leftmost and does not overlap
itself, as a left-to-right regular expression would be, in time linear in the text.

Kinds: email, ip, card, phone (the base), and url (by scheme), address and account (by cue).

Defined cases: a null text is empty; an empty text has no spans; repeated rows and null
ids stay rows; an empty table gives an empty result; other columns are ignored. Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm.common import read, small_batches, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "address", "account")
#: Words that announce an account or document number.
CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "customer id", "routing", "tax id")

#: Words that end a street's name.
STREETS = ("Street", "Avenue", "Road", "Lane", "Drive", "Boulevard", "Square", "Terrace", "Crescent")

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_REST = re.compile(r"[A-Za-z0-9\[][^\s<>\"'`|{}\\^]*")
#: House number and up to four capitalised words before a street's kind; town and postal code after it.
_HOUSE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]?(?:\x20[A-Z][A-Za-z'.-]{0,30}){1,4}\x20\Z")
_TOWN = re.compile(r"(?:,\x20[A-Z][A-Za-z'-]{1,30}(?:\x20[A-Z][A-Za-z'-]{1,30})?(?:,?\x20[A-Z]{2})?(?:,?\x20[0-9]{4,5})?)?(?![0-9A-Za-z])")
#: What may stand between a cue and its number.
_GAP = re.compile(r"(?:\x20?(?:number|num|no|nr|code))?\.?\x20?[:=#]?\x20?", re.I)
_NUMBER = re.compile(r"[A-Z]{0,2}[0-9](?:[\x20-]?[A-Z0-9])*")
_WORDS_AFTER = re.compile(r"(?:[\x20-][A-Z]+)+$")


@cache
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for text, kind in [("@", "email"), ("://", "url")]:
        found.add_word(text, (kind, len(text)))
    for d in "0123456789":
        found.add_word(f"{d}.", ("ip", 2))
        found.add_word(f"+{d}", ("phone", 2))
        for e in "0123456789":
            for between in ("", " ", "-"):
                found.add_word(d + between + e, ("card", 2 + len(between)))
    for street in STREETS:
        found.add_word(" " + street, ("address", len(street) + 1))
    for cue in CUES:
        for form in {cue, cue.title(), cue.upper(), cue.capitalize()}:
            found.add_word(form, ("account", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _email(text: str, at: int, done: int) -> tuple[int, int, bool] | None:
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end(), True) if m else None


def _ip(text: str, at: int, done: int) -> tuple[int, int, bool] | None:
    start = at
    while start > done and text[start - 1] in "0123456789":
        start -= 1
    m = _QUAD.match(text, start)
    return (start, m.end(), all(map(_octet, m[0].split(".")))) if m else None


def _card(text: str, at: int, done: int) -> tuple[int, int, bool] | None:
    m = _CARD.match(text, at)
    digits = re.sub("[^0-9]", "", m[0])
    return at, m.end(), 12 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, done: int) -> tuple[int, int, bool] | None:
    m = _PHONE.match(text, at)
    return (at, m.end(), 9 <= sum(c in "0123456789" for c in m[0]) <= 15) if m else None


def _url(text: str, at: int, done: int) -> tuple[int, int, bool] | None:
    start = at
    while start > done and at - start < 32 and text[start - 1] in _SCHEME:
        start -= 1
    while start < at and not text[start].isalpha():
        start += 1
    m = _REST.match(text, at + 3) if start < at else None
    return (start, at + 3 + len(m[0].rstrip(".,;:!?)]")), True) if m else None


def _address(text: str, at: int, done: int, size: int) -> tuple[int, int, bool] | None:
    left = max(done, at - 160)
    house, town = _HOUSE.search(text[left : at + 1]), _TOWN.match(text, at + size)
    return (left + house.start(), town.end(), True) if house and town else None


def iban(text: str) -> bool:
    """Whether country, check digits and account leave remainder 1."""
    text = re.sub("[ -]", "", text).upper()
    if not re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{8,30}", text):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _account(text: str, at: int, done: int, size: int) -> tuple[int, int, bool] | None:
    if at and text[at - 1].isalnum():
        return None
    gap = _GAP.match(text, at + size)
    m = _NUMBER.match(text, gap.end()) if gap.end() > at + size else None
    if not m:
        return None
    number = _WORDS_AFTER.sub("", m[0])
    good = iban(number) if text[at : at + size].lower() == "iban" else 5 <= sum(c.isdigit() for c in number) <= 20
    return m.start(), m.start() + len(number), good


_CUED = {"address": _address, "account": _account}
_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url}


def find(text: str) -> list[Span]:
    """All spans by start, then kind as listed."""
    done = dict.fromkeys(KINDS, 0)
    out = []
    for last, (kind, size) in _anchors().iter(text):
        at = last - size + 1
        if at < done[kind]:
            continue
        got = _CUED[kind](text, at, done[kind], size) if kind in _CUED else _PARSERS[kind](text, at, done[kind])
        if got:
            start, done[kind], good = got
            if good:
                out.append((kind, start, done[kind]))
    if len(out) > 1:
        out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span's kind in its place; spans that overlap an earlier one go with it."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(x.as_py()) for x in batch.column(0)]
        counts = [pa.array([sum(k == kind for k, _, _ in s) for s in found], pa.int64()) for kind in BASE]
        digest = [hashlib.sha256(written([x for x in s if x[0] in BASE]).encode()).hexdigest() for s in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), *counts, pa.array(digest, pa.string()), pa.array([written(s) for s in found], pa.string())],
            names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
        )


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pa.array([redact(x.as_py(), find(x.as_py())) for x in batch.column(0)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(1), text], names=["doc_id", "text"])


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans of each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    spec = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return docs.select(text_of().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(_run, spec)


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and the text without personal data."""
    small_batches(docs.sparkSession)
    return docs.select(text_of().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(_redacted, "doc_id bigint, text string")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    return spans(read(spark, sf_dir, "documents"))
