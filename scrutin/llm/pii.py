"""Operator 6: personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, scheme marks, plus signs,
digits, identifier and street cues) in one pass over a text.  From each anchor
a local parser expands to the bounds of the candidate and validates it.  The
base kinds (email, ip, card, phone) are leftmost and non-overlapping within
their kind; url, account and address are added by their own anchors.

Defined cases: a null text is the empty text and has no spans; offsets are
code points, the end exclusive; repeated rows are kept; columns beside doc_id
and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm.textbytes import text_column

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "address")

# FIXED VALUES: cue words of the added kinds
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "cuenta", "compte")
STREET_CUES = ("Street", "Avenue", "Road", "Lane", "Boulevard", "Drive")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"']+")
_IDENTIFIER = re.compile(r"[ \t]*(?:no\.?|number|nr\.?|#)?[ \t]*[:=#]?[ \t]*([A-Za-z]{0,4}[0-9][A-Za-z0-9]*(?:[ -][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)",
                         re.IGNORECASE)
_HOUSE = re.compile(r"(?<![0-9])[0-9]{1,5}(?: [A-Z][a-z]+){1,4} $")

_automaton: ahocorasick.Automaton | None = None


def automaton() -> ahocorasick.Automaton:
    """The anchors; the value is the parser's name."""
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        a.add_word("@", "@")
        a.add_word("://", "url")
        a.add_word("+", "+")
        for d in "0123456789":
            a.add_word(d, "digit")
        for cue in ACCOUNT_CUES:
            for form in (cue, cue.capitalize(), cue.upper()):
                a.add_word(form, "account")
        for cue in STREET_CUES:
            a.add_word(cue, "street")
        a.make_automaton()
        _automaton = a
    return _automaton


#: Letters before a street cue in which its house number and name are looked for.
LOOK_BACK = 100


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind that has any, by start."""
    out: dict[str, list[tuple[int, int]]] = {}
    end = dict.fromkeys(KINDS, 0)

    def add(kind: str, a: int, b: int) -> None:
        out.setdefault(kind, []).append((a, b))

    for at, what in automaton().iter(text):
        if what == "digit":
            # a run's first digit, unless a match of the kind holds it
            run = at == 0 or not "0" <= text[at - 1] <= "9"
            if run and at >= end["ip"] and (m := _IP.match(text, at)):
                end["ip"] = m.end()
                if all(int(x) <= 255 for x in m[0].split(".") if len(x.lstrip("0")) <= 3) and all(len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
                    add("ip", at, m.end())
            if at >= end["card"] and (m := _CARD.match(text, at)):
                end["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    add("card", at, m.end())
        elif what == "@":
            a = at
            while a > end["email"] and text[a - 1] in _LOCAL:
                a -= 1
            if a < at and (m := _DOMAIN.match(text, at + 1)):
                end["email"] = m.end()
                add("email", a, m.end())
        elif what == "+":
            if at >= end["phone"] and (m := _PHONE.match(text, at)):
                end["phone"] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    add("phone", at, m.end())
        elif what == "url":
            a = at - 2
            while a > end["url"] and text[a - 1] in _SCHEME:
                a -= 1
            while a < at - 2 and not text[a].isalpha():
                a += 1
            if a < at - 2 and (m := _URL.match(text, at + 1)):
                b = at + 1 + len(m[0].rstrip(".,;:!?)]}"))
                end["url"] = max(b, end["url"])
                if b > at + 1:
                    add("url", a, b)
        elif what == "account":
            if at + 1 >= end["account"] and (m := _IDENTIFIER.match(text, at + 1)):
                if sum(c.isdigit() for c in m[1]) >= 6 and len(m[1]) <= 42:
                    end["account"] = m.end(1)
                    add("account", m.start(1), m.end(1))
        elif not text[at + 1: at + 2].isalnum():  # a street cue at a word's end
            cue = at + 1
            # a word of more than LOOK_BACK letters is no street's name
            least = max(0, cue - LOOK_BACK)
            start = max(text.rfind(" ", least, cue), text.rfind("\n", least, cue)) + 1
            if (start or not least) and (m := _HOUSE.search(text, max(end["address"], start - LOOK_BACK), start)):
                end["address"] = cue
                add("address", m.start(), cue)
    return out


def written(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found.get(k, ()))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(t) for t in text_column(batch.column(1)).to_pylist()]
        counts = [pa.array([len(x.get(k, ())) for x in found], pa.int64()) for k in KINDS]
        yield pa.record_batch(
            [batch.column(0), *counts,
             pa.array([hashlib.sha256(written(x, BASE_KINDS).encode()).hexdigest() for x in found], pa.string()),
             pa.array([written(x, KINDS) for x in found], pa.string())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def personal_data(documents: DataFrame) -> DataFrame:
    """Counts by kind, the base spans' digest and all spans of each document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_rows, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def mask(text: str) -> str:
    """The text with each span replaced by its kind; spans that overlap are one."""
    spans = sorted((a, b, k) for k, x in find(text).items() for a, b in x)
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        i = batch.schema.get_field_index("text")
        texts = batch.column(i).to_pylist()
        new = [None if t is None else mask(t) for t in texts]
        yield batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))


def masked(documents: DataFrame) -> DataFrame:
    """The documents with the personal data of their texts replaced (a null
    text stays null); n_chars, where there is one, is counted anew."""
    out = documents.mapInArrow(_masked, documents.schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out
