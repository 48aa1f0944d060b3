"""Personal data by anchor expansion.

An Aho-Corasick machine runs once over each text and stops at anchors: at-signs, plus signs, digits,
``://`` and cues such as ``password`` or ``IBAN``.  At an anchor a small parser expands to both sides
and validates what it finds.  Email, ip, card and phone are the base kinds; they are taken from left
to right without overlap inside a kind, and a match that fails its validation is dropped, not
retried.  The added kinds are ``iban`` (after its cue, checksum 97), ``secret`` (the value given to a
cue) and ``url`` (an address that carries user information).

Edge cases: null is the empty text without spans; digits and letters are ASCII ones; a text of any
length is read once, because a parser that has failed on a run does not read that run again; spans that
begin together are listed by kind; repeated rows get equal spans; an empty table gives an empty result;
columns with the names of results give way to them, others stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from ledgerloom.llm.text_maps import map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "url")

# Cues before which an assigned value is a secret.
SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "access_key")
IBAN_CUES = ("iban",)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}").match
_DIGITS = re.compile(r"[0-9]+").match
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_ASSIGNED = re.compile(r"""["']?\s{0,3}[=:]\s{0,3}["']?([A-Za-z0-9_+/.-]{8,})""").match
_IBAN = re.compile(r"[\s:=]{1,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])").match
_USER = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/@]+@[A-Za-z0-9.-]+(?::[0-9]+)?").match

Span = tuple[int, int, int]


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for anchor, parser in (("@", "at"), ("+", "plus"), ("://", "scheme"), *((d, "digit") for d in "0123456789")):
        machine.add_word(anchor, parser)
    for cues, parser in ((SECRET_CUES, "secret"), (IBAN_CUES, "iban")):
        for cue in cues:
            for spelled in (cue, cue.upper(), cue.capitalize()):
                machine.add_word(spelled, parser)
    machine.make_automaton()
    return machine


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


def _checked_iban(iban: str) -> bool:
    compact = iban.replace(" ", "")
    turned = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def find_spans(text: str) -> list[Span]:
    """All spans as (start, number of the kind, end), ascending."""
    spans: list[Span] = []
    email_end = ip_from = card_from = 0
    for last, parser in _anchors().iter(text):
        if parser == "digit":
            if last >= ip_from:
                if found := _DOTTED(text, last):
                    ip_from = found.end()
                    if all(map(_octet, found[0].split("."))):
                        spans.append((last, 1, ip_from))
                else:  # no start inside this run of digits can do better
                    ip_from = _DIGITS(text, last).end()
            if last >= card_from and (found := _SPACED(text, last)):
                card_from = found.end()
                digits = found[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    spans.append((last, 2, card_from))
        elif parser == "at":
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (found := _DOMAIN(text, last + 1)):
                email_end = found.end()
                spans.append((start, 0, email_end))
        elif parser == "plus":
            if (found := _DIALLED(text, last)) and 10 <= sum(map(str.isdigit, found[0])) <= 15:
                spans.append((last, 3, found.end()))
        elif parser == "secret":
            if (found := _ASSIGNED(text, last + 1)) and any(map(str.isdigit, found[1])):
                spans.append((found.start(1), 5, found.end(1)))
        elif parser == "iban":
            if (found := _IBAN(text, last + 1)) and _checked_iban(found[1]):
                spans.append((found.start(1), 4, found.end(1)))
        else:
            start = last - 2
            while start > 0 and last - start < 18 and text[start - 1] in _SCHEME:
                start -= 1
            if start < last - 2 and (found := _USER(text, last + 1)):
                spans.append((start, 6, found.end()))
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or stretch of overlapping spans, replaced by the kind of its first one."""
    parts, done, label = [], 0, ""
    for start, kind, end in spans:
        if start < done:
            parts[-1], done = label, max(done, end)
            continue
        label = f"[{KINDS[kind].upper()}]"
        parts += [text[done:start], label]
        done = end
    return "".join([*parts, text[done:]])


FIELDS = [
    *(StructField(f"n_{kind}", LongType()) for kind in BASE_KINDS),
    StructField("base_sha256", StringType()), StructField("spans", StringType()),
]


def _reporting() -> Callable[[list[str | None]], list[pa.Array]]:
    def report(texts: list[str | None]) -> list[pa.Array]:
        found = [find_spans(t) if t else [] for t in texts]
        base = [[s for s in spans if s[1] < len(BASE_KINDS)] for spans in found]
        counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(len(BASE_KINDS))]
        digests = pa.array([hashlib.sha256(written(spans).encode()).hexdigest() for spans in base], pa.string())
        return [*counts, digests, pa.array([written(spans) for spans in found], pa.string())]

    return report


def _redacting() -> Callable[[list[str | None]], list[pa.Array]]:
    def hide(text: str | None) -> str | None:
        while text and (spans := find_spans(text)):  # what is left around a span may form another
            text = redacted(text, spans)
        return text

    return lambda texts: [pa.array(map(hide, texts), pa.string())]


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the number of spans per base kind, the digest of the base spans and all spans."""
    return map_texts(docs, text, FIELDS, _reporting)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; ``n_chars`` follows if there is one."""
    hidden = map_texts(docs, text, [StructField(text, StringType())], _redacting)
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return hidden.select(*docs.columns)
