"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
scheme separators and words that announce an identifier. Around each anchor a
small parser finds the boundaries of the value and checks it: mail addresses
and dotted addresses by their form, card numbers by their check digit, IBANs by
theirs, the rest by what the announcing word asks for. Per kind, spans are
leftmost and do not overlap; a value that fails its check is passed over whole.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``. Further kinds need an
announcing word or a scheme: ``url`` (an address that carries credentials),
``iban``, ``ssn``, ``account`` and ``secret``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import once_per_worker, to_python, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn", "account", "secret")
SPANS = "array<struct<kind: string, start: int, end: int>>"

#: Announcing words, in lower case, and the kind of value that follows. A text
#: may have them in any mixture of upper and lower case.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security number": "ssn",
    "account": "account",
    "acct": "account",
    "konto": "account",
    "compte": "account",
    "cuenta": "account",
    "password": "secret",
    "passwd": "secret",
    "token": "secret",
    "secret": "secret",
    "api key": "secret",
    "api_key": "secret",
    "apikey": "secret",
}

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CREDENTIALS = re.compile(r"[^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+@[^\s\"'<>]*[^\s\"'<>.,;:!?)\]}]")
_LEAD = {
    "iban": re.compile(r"[ \t]*[:=#]?[ \t]*"),
    "ssn": re.compile(r"(?:[ \t]*(?:no\.?|number))?[ \t]*[:=#]?[ \t]*", re.I),
    "account": re.compile(r"(?:[ \t]*(?:no\.?|nr\.?|number|num|id))?[ \t]*[:=#][ \t]*", re.I),
    "secret": re.compile(r"[ \t]*[:=][ \t]*[\"']?"),
}
_VALUE = {
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "ssn": re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])"),
    "account": re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])"),
    "secret": re.compile(r"[^\s\"']{8,}"),
}


#: The length of an IBAN, by country.
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28,
    "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def _lower(text: str) -> str:
    """ASCII letters in lower case, all else and all places as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for sign in ("@", "+", "://"):
        found.add_word(sign, (sign, len(sign)))
    for cue, kind in CUES.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _iban(value: str) -> bool:
    value = value.replace(" ", "")
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban_end(text: str, match: re.Match) -> int:
    """Where the IBAN ends that the match begins with, which may run on into
    words in capitals and numbers: at its country's length, for other countries
    at the last end of a group that the check digits agree with; without one,
    the end of the match."""
    start, end = match.span()
    ends, size, want = [], 0, _IBAN_LENGTHS.get(text[start : start + 2])
    for at in range(start, end):
        size += text[at] != " "
        if text[at] != " " and not text[at + 1 : at + 2].isalnum():
            if size == want:
                return at + 1 if _iban(text[start : at + 1]) else end
            if size >= 15:
                ends.append(at + 1)
    if want is None:
        return next((e for e in reversed(ends) if _iban(text[start:e])), end)
    return end


_VALID = {
    "ip": lambda v: all(map(_small, v.split("."))),
    "card": lambda v: 14 <= len(d := _digits(v)) <= 19 and _luhn(d),
    "phone": lambda v: 10 <= len(_digits(v)) <= 15,
    "iban": _iban,
    "secret": lambda v: any(c in "0123456789" for c in v),
}


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` by start, then kind as in ``KINDS``."""
    spans: list[tuple[str, int, int]] = []
    free = dict.fromkeys(KINDS, 0)  # per kind, where the next span may begin

    def take(kind: str, match: re.Match | None, start: int | None = None) -> None:
        if match:
            start = match.start() if start is None else start
            end = _iban_end(text, match) if kind == "iban" else match.end()
            free[kind] = end
            if kind not in _VALID or _VALID[kind](text[start:end]):
                spans.append((kind, start, end))

    for last, (what, width) in automaton.iter(_lower(text)):
        at = last + 1 - width
        if what == "digit":
            if at and text[at - 1] in "0123456789":
                continue  # a run of digits has one anchor
            if at >= free["ip"]:
                take("ip", _IP.match(text, at))
            if at >= free["card"]:
                take("card", _CARD.match(text, at))
        elif what == "+":
            if at >= free["phone"]:
                take("phone", _PHONE.match(text, at))
        elif what == "@":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                take("email", _DOMAIN.match(text, at + 1), start)
        elif what == "://":
            start = at
            while start > free["url"] and text[start - 1] in _SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            if start < at:
                take("url", _CREDENTIALS.match(text, last + 1), start)
        elif not (at and text[at - 1].isalnum()):  # the announcing word begins a word
            lead = _LEAD[what].match(text, last + 1)
            if lead and lead.end() > last + 1 and lead.end() >= free[what]:
                take(what, _VALUE[what].match(text, lead.end()))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return spans


def masked_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans replaced by their kind; of overlapping ones, the first names the union."""
    parts, at, name = [], 0, ""
    for kind, start, end in spans:
        if name and start < at:
            at = max(at, end)
            continue
        parts += [name, text[at:start]]
        name, at = f"[{kind.upper()}]", end
    return "".join([*parts, name, text[at:]])


def with_spans(docs: DataFrame, text: str = "text", to: str = "spans") -> DataFrame:
    """The table with one more column, last: the spans of each text in code
    points; a null or empty text has none. Other columns stay as they are: if
    one has that name, the new one has underscores after it."""

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = once_per_worker(("pii",), _automaton)
        for texts in batches:
            yield pd.Series([
                [{"kind": k, "start": s, "end": e} for k, s, e in find(t, automaton)] if t else []
                for t in texts
            ], dtype=object)

    return to_python(docs).select("*", spans(F.col(text)).alias(unused(docs, to)))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with every span of the text replaced by its kind in brackets;
    null stays null. Other columns stay as they are."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = once_per_worker(("pii",), _automaton)
        for texts in batches:
            yield pd.Series(
                [masked_text(t, found) if t and (found := find(t, automaton)) else t for t in texts],
                dtype=object,
            )

    return to_python(docs).withColumn(text, mask(F.col(text)))


def digests(found: DataFrame) -> DataFrame:
    """One row per document, whose spans are the last column: ``doc_id``, counts,
    digest and list."""
    found = found.select("doc_id", F.col(f"`{found.columns[-1]}`").alias("spans"))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
    )
    of = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(written(of(*BASE)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
