"""Personal data in text: patterns propose spans, validators confirm them, context adjusts the score.

Every kind has a pattern, a validator and a score it starts with. Words near a span raise the score if
they speak for its kind and lower it if they speak against any. Spans of the base kinds stay
whatever their score; those of other kinds must reach a threshold and overlap nothing else.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import per_batch

# Base kinds first; spans are listed in this order.
KINDS = ("email", "ip", "card", "phone", "iban", "payment", "ssn")
BASE = 4
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"

# Points of a hundred: what a confirmed span of a kind starts with, and what words around it change.
PRIORS = {"email": 90, "ip": 60, "card": 80, "phone": 70, "iban": 80, "payment": 45, "ssn": 40}
FOR, AGAINST, THRESHOLD = 30, 30, 70
# Code points looked at before and after a span.
BEFORE, AFTER = 40, 20
CONTEXT = {
    "email": ("address", "contact", "email", "mail", "reach", "write"),
    "ip": ("address", "client", "host", "ip", "login", "server"),
    "card": ("amex", "card", "credit", "debit", "mastercard", "pay", "payment", "visa"),
    "phone": ("call", "cell", "fax", "mobile", "phone", "tel", "telephone"),
    "iban": ("account", "bank", "iban", "konto", "transfer"),
    "payment": ("amex", "card", "credit", "debit", "mastercard", "pay", "payment", "visa"),
    "ssn": ("insurance", "security", "social", "ssn"),
}
COUNTER = ("build", "dummy", "example", "invoice", "isbn", "order", "sample", "serial", "sku", "version")


def _word(words: tuple[str, ...]) -> str:
    return f"(?:^|[^a-z])(?:{'|'.join(words)})(?:[^a-z]|$)"


# The same matches as the patterns above, in time that grows with the text: runs start where they
# start, and an address is found by its sign.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(PHONE)
_IBAN = re.compile(IBAN, re.ASCII)
_SSN = re.compile(SSN, re.ASCII)
_NO_DIGIT = re.compile("[^0-9]+")
_CONTEXT = [re.compile(_word(CONTEXT[k])) for k in KINDS]
_COUNTER = re.compile(_word(COUNTER))
_LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the check of payment cards."""
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (twice + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod_97(number: str) -> bool:
    """Whether an account number, without blanks, passes the check of international ones."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def small_parts(address: str) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255 for part in address.split("."))


def possible_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for found in _DOMAIN.finditer(text) if "@" in text else ():
        start = at = found.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = found.end()
            yield start, last


def _matches(pattern: re.Pattern[str], text: str, holds: Callable[[str], bool]) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if holds(m[0])]


def _phone_digits(text: str) -> bool:
    return 8 <= len(_NO_DIGIT.sub("", text)) <= 15


def confirmed(text: str) -> list[list[tuple[int, int]]]:
    """For each kind, the start and end of what its pattern finds and its validator confirms."""
    card, payment = [], []
    for found in _CARD.finditer(text):
        if 13 <= len(found[0]) and 13 <= len(digits := _NO_DIGIT.sub("", found[0])) <= 19 and luhn(digits):
            (card if len(digits) > 15 else payment).append(found.span())
    return [
        list(_emails(text)),
        _matches(_IP, text, small_parts),
        card,
        _matches(_PHONE, text, _phone_digits) if "+" in text else [],
        _matches(_IBAN, text, lambda t: mod_97(t.replace(" ", ""))),
        payment,
        _matches(_SSN, text, possible_ssn),
    ]


def score(text: str, kind: int, start: int, end: int) -> int:
    near = f"{text[max(0, start - BEFORE) : start]}\n{text[end : end + AFTER]}".translate(_LOWER)
    points = PRIORS[KINDS[kind]] + FOR * bool(_CONTEXT[kind].search(near)) - AGAINST * bool(_COUNTER.search(near))
    return max(0, min(100, points))


def spans(text: str) -> list[tuple[int, int, int, int]]:
    """Kind, start, end and score of all personal data in a text, by kind and start."""
    result, taken = [], []
    for kind, found in enumerate(confirmed(text)):
        scored = [(kind, a, b, score(text, kind, a, b)) for a, b in found]
        if kind >= BASE:
            scored = [s for s in scored if s[3] >= THRESHOLD and not _overlaps(taken, s)]
        result += scored
        if kind >= BASE - 1:
            taken = _covered(sorted((s[1], s[2]) for s in result))
    return result


def _covered(ordered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What some sorted spans cover, as spans that don't touch."""
    whole: list[tuple[int, int]] = []
    for start, end in ordered:
        if whole and start <= whole[-1][1]:
            whole[-1] = (whole[-1][0], max(end, whole[-1][1]))
        else:
            whole.append((start, end))
    return whole


def _overlaps(taken: list[tuple[int, int]], span: tuple[int, int, int, int]) -> bool:
    at = bisect_right(taken, span[1], key=lambda t: t[1])
    return at < len(taken) and taken[at][0] < span[2]


_SPANS = "array<struct<kind:string,start:int,end:int,score:int>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` of every row: kind, start and end in code points, and score of 0 to 100.

    Spans are sorted by kind and start. A null text holds nothing, as an empty one.
    """

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b, "score": s} for k, a, b, s in spans(text.as_py() or "")]
                for text in batch.column("text")
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())]))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

        return apply

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return per_batch(narrow, make, f"doc_id long, spans {_SPANS}")


def _listed(found: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the personal data of every document.

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` as
    ``kind:start:end`` joined by commas, and ``scores`` in the same order; empty lists are empty strings.
    Rows that repeat are scanned alike; an empty table gives an empty one; other columns are not looked at.
    """
    found = scan(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS[:BASE]]
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), scores.alias("scores")
    )


def masked(text: str) -> str:
    """A text in which each span is replaced by its kind in brackets; of spans that overlap, the first and longest names the rest."""
    out, at = [], 0
    for start, _, end, kind in sorted((a, -b, b, k) for k, a, b, _ in spans(text)):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all personal data in a text masked; null texts and other columns as they are."""
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    schema = docs.schema
    place = docs.columns.index(text_col)

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if t is None else masked(t) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return apply

    return per_batch(docs, make, schema)
