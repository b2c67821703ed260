"""Personal data in texts: regular expressions propose spans, validators confirm them, context words move the score.

Base kinds are ``email``, ``ip`` (parts at most 255), ``card`` (12 to 19 digits that pass the Luhn check) and ``phone`` (a plus and
9 to 15 digits). A match is the leftmost one that does not overlap an earlier one of its kind; one that its validator
refuses is dropped and nothing shorter is tried. They are reported whatever their score.

Further kinds are reported from a score of ``LEAST_SCORE`` on, and only beside base spans, never across them: ``iban`` (length of its
country, mod-97 check) and ``ssn`` (three, two and four digits, no unused area, which need a context word nearby).

Positions are code points, ends are exclusive. Null and empty texts have no spans. Repeated rows and null ids are
judged row by row; the ids are passed through. Other columns do not matter, whatever their names. The work on a text grows with its length
alone: every expression repeats a single class of characters, so none of them backtracks over what it has read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of ties.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
LEAST_SCORE = 0.7
#: What a pattern, its validator and a context word within ``NEAR`` code points count for.
PROPOSED = {"email": 0.9, "ip": 0.5, "card": 0.3, "phone": 0.6, "iban": 0.4, "ssn": 0.3}
CONFIRMED = {"email": 0.0, "ip": 0.1, "card": 0.4, "phone": 0.1, "iban": 0.4, "ssn": 0.1}
IN_CONTEXT, NEAR = 0.3, 40
CONTEXT = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "client", "login"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "amex", "payment", "cvv"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "contact"},
    "iban": {"iban", "account", "bank", "bic", "swift", "transfer"},
    "ssn": {"ssn", "social", "security"},
}
# The length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile("@([A-Za-z0-9-][A-Za-z0-9.-]*)")
#: A stretch that starts with a digit; every ip, card, phone (but for its plus) and ssn lies within one.
_STRETCH = re.compile("[0-9][0-9 ().-]*")
_DOTTED = re.compile("[0-9][0-9.]*")
_GROUPED = re.compile("[0-9][0-9 -]*")
_GAP = re.compile("[ -][ -]+")
_IBAN = re.compile("[A-Z][A-Z][0-9][0-9]")
_SSN = re.compile("([0-9]{3})-([0-9]{2})-([0-9]{4})")
_WORD = re.compile("[a-z]+")
#: Longest IBAN with a separator after each sign.
_IBAN_REACH = 68


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an IBAN without separators has the right check digits."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        domain = m[1].split("..", 1)[0].rstrip(".")
        if "." in domain:
            at = m.start()
            # an earlier at sign ends the local part, so no character is looked at twice
            left = text[max(done, text.rfind("@", done, at) + 1) : at]
            length = len(left) - len(left.rstrip(_LOCAL))
            if length:
                done = at + 1 + len(domain)
                yield at - length, done


def _addresses(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text, start, end):
        place, group = m.start(), []
        for part in m[0].split("."):
            if not part:
                group = []
            else:
                group.append((place, part))
            place += len(part) + 1
            if len(group) == 4:
                if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for _, p in group):
                    yield group[0][0], place - 1
                group = []


def _cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    for m in _GROUPED.finditer(text, start, end):
        run, at = m[0], 0
        for gap in [*(g.span() for g in _GAP.finditer(run)), (len(run.rstrip(" -")), len(run))]:
            found = run[at : gap[0]]
            if 12 <= len(found) <= 37:
                digits = found.replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    yield m.start() + at, m.start() + gap[0]
            at = gap[1]


def _phones(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    if start and text[start - 1] == "+":
        found = text[start:end].rstrip(" ().-")
        if len(found) > 2 and 9 <= sum(c.isdigit() for c in found) <= 15:
            yield start - 1, start + len(found)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _IBAN.finditer(text):
        length = IBAN_LENGTHS.get(m[0][:2], 0)
        if not length or m.start() < done or m.start() and text[m.start() - 1].isalnum():
            continue
        account, place = "", m.start()
        for c in text[m.start() : m.start() + _IBAN_REACH]:
            if len(account) == length:
                break
            if c.isascii() and (c.isdigit() or c.isupper()):
                account += c
            elif c not in " -" or text[place - 1] in " -":
                break
            place += 1
        if len(account) == length and not text[place : place + 1].isalnum() and mod_97(account):
            done = place
            yield m.start(), place


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text, start, end):
        area, group, serial = m.groups()
        near = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            if not any(c.isalnum() or c == "-" for c in near):
                yield m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()
    near = not CONTEXT[kind].isdisjoint(_WORD.findall(around))
    return round(min(1.0, PROPOSED[kind] + CONFIRMED[kind] + IN_CONTEXT * near), 2)


def find_spans(text: str | None) -> list[Span]:
    """All spans of one text, by start and then kind."""
    if not text:
        return []
    places = [("email", *p) for p in _emails(text)] if "@" in text else []
    further = [("iban", *p) for p in _ibans(text)]
    for m in _STRETCH.finditer(text):
        start, end = m.span()
        if end - start > 2:
            for kind, find in (("ip", _addresses), ("card", _cards), ("phone", _phones)):
                places += [(kind, *p) for p in find(text, start, end)]
            further += [("ssn", *p) for p in _numbers(text, start, end)]
    found = [Span(kind, s, e, _score(text, kind, s, e), True) for kind, s, e in places]
    if further:
        taken = sorted((s, e) for _, s, e in places)
        reach = list(accumulate((e for _, e in taken), max))
        for kind, s, e in further:
            before = bisect_left(taken, (e, 0))
            score = _score(text, kind, s, e)
            if score >= LEAST_SCORE and not (before and reach[before - 1] > s):
                found.append(Span(kind, s, e, score, False))
    return sorted(found, key=lambda x: (x.start, KINDS.index(x.kind)))


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with the name of the kind in place of each span; of overlapping ones the first, and then the longest, names it."""
    if not spans:
        return text
    out, done = [], 0
    for x in sorted(spans, key=lambda x: (x.start, -x.end)):
        if x.start >= done:
            out += [text[done : x.start], f"[{x.kind.upper()}]"]
        done = max(done, x.end)
    return "".join([*out, text[done:]])


_SPANS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("score", pa.float64()),
            ("base", pa.bool_()),
            ("value", pa.string()),
        ]
    )
)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for scalar in batch.column(1):
            text = scalar.as_py()
            rows.append([{**x._asdict(), "value": text[x.start : x.end]} for x in find_spans(text)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], names=[batch.schema.names[0], "spans"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``spans`` of each document's whole text: kind, start, end, score, whether of a base kind, and the text itself.

    One pass without a shuffle.
    """
    chosen = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = chosen.schema[0].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean,value:string>>"
    return chosen.mapInArrow(_found, f"`{id_col}` {kind}, spans {spans}")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``[EMAIL]`` and so on in place of the spans; all columns and rows stay."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (scalar.as_py() for scalar in batch.column(place))
            columns = batch.columns
            columns[place] = pa.array([redacted(t, find_spans(t)) for t in texts], batch.schema.types[place])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
