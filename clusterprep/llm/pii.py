"""Personal data: patterns propose spans, checksums confirm them, context scores them.

A pattern alone proposes; a validator decides whether the proposal can be what
it looks like: parts of an address up to 255, the Luhn sum of a card, the
remainder modulo 97 of an IBAN, the number of digits of a phone number. Words
around a span then move its score up or down. Kinds whose pattern and checksum
are strong on their own (`BASE_KINDS`) are always reported, with their score;
the others only from `MIN_SCORE` on.

Positions are code points, the end exclusive. Every pattern is matched in time
linear in the text: runs are found first and cut into matches, where a plain
search would start again at each character of a long run. A null text is
empty; it and any text without personal data have no spans. Each row is
treated on its own, so repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow, picked

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
MIN_SCORE = 0.6
CONTEXT = 40  # code points looked at on either side of a span

# Score of a validated span without context, and the words that raise it.
PRIOR = {
    "email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.95, "ssn": 0.4, "local_phone": 0.3,
}
RAISING = {
    "email": "mail email contact write",
    "ip": "ip address host server login",
    "card": "card credit visa mastercard payment tarjeta karte carte",
    "phone": "phone tel call mobile fax telefon",
    "iban": "iban account bank konto compte cuenta",
    "ssn": "ssn social security",
    "local_phone": "phone tel call mobile fax telefon",
}
LOWERING = "version order invoice isbn serial sku part example"
RAISE, LOWER_BY = 0.35, 0.3

_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[a-z]+")
_RAISING = {kind: frozenset(words.split()) for kind, words in RAISING.items()}
_LOWERING = frozenset(LOWERING.split())

Span = tuple[int, int, int, float]  # start, number of the kind, end, score


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an IBAN's check digits are right."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the run of local characters before it, the domain after it."""
    free = 0  # end of the last match
    at = text.find("@")
    while at >= 0:
        domain = _EMAIL_DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
        if start < at:
            yield start, domain.end()
            free = domain.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each dotted run of numbers; only those up to 255 count."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", match.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
            yield match.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for match in _IBAN.finditer(text):
        if mod97(match.group().replace(" ", "")):
            yield match.span()


def _spans_of(pattern: re.Pattern):
    return lambda text: (match.span() for match in pattern.finditer(text))


_FINDERS = {
    "email": emails,
    "ip": addresses,
    "card": cards,
    "phone": phones,
    "iban": ibans,
    "ssn": _spans_of(_SSN),
    "local_phone": _spans_of(_LOCAL_PHONE),
}
_DIGIT = re.compile("[0-9]")


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, moved by the words near the span, between 0 and 1."""
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    words = set(_WORD.findall(near.lower()))
    value = PRIOR[kind] + RAISE * bool(words & _RAISING[kind]) - LOWER_BY * bool(words & _LOWERING)
    return round(min(1.0, max(0.0, value)), 2)


def find_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind; base kinds always, others by score."""
    found: list[Span] = []
    digits = _DIGIT.search(text) is not None
    for number, kind in enumerate(KINDS):
        if not digits and kind != "email":
            break
        for start, end in _FINDERS[kind](text):
            value = score(text, kind, start, end)
            if kind in BASE_KINDS or value >= MIN_SCORE:
                found.append((start, number, end, value))
    found.sort()
    base = [span for span in found if span[1] < len(BASE_KINDS)]
    starts = [span[0] for span in base]
    reach = list(accumulate((span[2] for span in base), max))  # largest end so far

    def free(span: Span) -> bool:
        before = bisect_left(starts, span[2])
        return not before or reach[before - 1] <= span[0]

    return [span for span in found if span[1] < len(BASE_KINDS) or free(span)]


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("score", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)
_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and its spans (kind, start, end, score)."""

    def run(batches):
        for slab in slabs(batches, "text"):
            rows = [
                [
                    {"kind": KINDS[number], "start": start, "end": end, "score": value}
                    for start, number, end, value in find_spans(text or "")
                ]
                for text in slab.column("text").to_pylist()
            ]
            spans = pa.array(rows, pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([slab.column("doc_id"), spans], ["doc_id", "spans"])

    rows = picked(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([rows.schema["doc_id"], SCHEMA["spans"]])
    return map_arrow(rows, run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and the text with each span replaced by [KIND].

    Of spans that overlap, the first replaces; the rest of the others goes with it.
    """

    def clean(text: str) -> str:
        parts, at = [], 0
        for start, number, end, _ in find_spans(text):
            if start >= at:
                parts += [text[at:start], f"[{KINDS[number].upper()}]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def run(batches):
        for slab in slabs(batches, "text"):
            texts = [clean(text or "") for text in slab.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [slab.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    rows = picked(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])
    return map_arrow(rows, run, schema)
