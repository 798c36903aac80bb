"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, scheme marks and words that
announce an account. Parsers of their own kind read outwards from an anchor, decide where the span begins and
ends, and validate it. The base kinds are those of plain patterns, leftmost and without overlap within a kind.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.arrays import pieces

# Kinds in the order in which spans at the same place are listed, and the characters of their parts.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account")
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
SCHEME = (LABEL - {"-"}) | frozenset("+.-")
PHONE = DIGITS | frozenset(" ().-")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOGIN_END = frozenset(" \t\n\v\f\r/?#@")
CUES = ("iban", "IBAN", "Iban")

_automaton: list = []


def automaton():
    if not _automaton:
        import ahocorasick

        made = ahocorasick.Automaton()
        for anchor in ("@", "+", "://", *DIGITS, *CUES):
            made.add_word(anchor, anchor)
        made.make_automaton()
        _automaton.append(made)
    return _automaton[0]


def run_end(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_around(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign, whose name begins no earlier than ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
        end, dots = run_end(text, end + 1, LABEL), dots + 1
    return (start, end) if dots else None


def numbers_from(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Numbers joined by single dots from ``at`` on, and where they end."""
    found = []
    while True:
        end = run_end(text, at, DIGITS)
        found.append((at, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
            at = end + 1
        else:
            return found, end


def part_fits(text: str, start: int, end: int) -> bool:
    digits = text[start:end].lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def digits_from(text: str, at: int) -> tuple[str, int]:
    """Digits from ``at`` on, parted by single spaces or hyphens at most, and where they end."""
    digits, end = [], at
    while True:
        stop = run_end(text, end, DIGITS)
        digits.append(text[end:stop])
        if stop + 1 < len(text) and text[stop] in " -" and text[stop + 1] in DIGITS:
            end = stop + 1
        else:
            return "".join(digits), stop


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def phone_from(text: str, at: int) -> tuple[int, int] | None:
    """The number that begins with the plus sign at ``at``; it ends with the last digit of its characters."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    count = sum(c in DIGITS for c in text[at:end])
    return (at, end) if 10 <= count <= 15 else None


def login_around(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """scheme://user:password@ around the scheme mark at ``at``."""
    start = at
    while start > floor and text[start - 1] in SCHEME:
        start -= 1
    while start < at and not (text[start].isascii() and text[start].isalpha()):
        start += 1
    end, colon = at + 3, -1
    while end < len(text) and text[end] not in LOGIN_END:
        if colon < 0 and text[end] == ":":
            colon = end
        end += 1
    good = start < at and at + 3 < colon < end - 1 and end < len(text) and text[end] == "@"
    return (start, end + 1) if good else None


def account_after(text: str, at: int) -> tuple[int, int] | None:
    """The international account number after a cue that ends before ``at``, if its check digits hold."""
    start = run_end(text, at, frozenset(" :#."))
    end = run_end(text, start, UPPER | DIGITS)
    number = text[start:end]
    if not 15 <= len(number) <= 34 or not (number[:2].isalpha() and number[2:4].isdigit()):
        return None
    turned = number[4:] + number[:4]
    return (start, end) if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else None


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of all spans in code points, sorted."""
    found = []
    free = dict.fromkeys(KINDS, 0)  # where the next span of a kind may begin

    def keep(kind: str, span: tuple[int, int] | None) -> None:
        if span:
            found.append((span[0], KINDS.index(kind), span[1]))
            free[kind] = span[1]

    for last, anchor in automaton().iter(text):
        if anchor == "@":
            keep("email", email_around(text, last, free["email"]))
        elif anchor == "+":
            if last >= free["phone"]:
                keep("phone", phone_from(text, last))
        elif anchor == "://":
            keep("login", login_around(text, last - 2, free["login"]))
        elif anchor in DIGITS:
            if last >= free["ip"]:
                parts, end = numbers_from(text, last)
                for i in range(0, len(parts) - 3, 4):
                    if all(part_fits(text, *p) for p in parts[i : i + 4]):
                        keep("ip", (parts[i][0], parts[i + 3][1]))
                free["ip"] = end
            if last >= free["card"]:
                digits, end = digits_from(text, last)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    keep("card", (last, end))
                free["card"] = end
        elif last >= free["account"]:
            keep("account", account_after(text, last + 1))
    return sorted(found)


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; spans is an array of (start, kind, end) in code points, end exclusive.

    Sorted by start and then by kind as in KINDS. Whole texts are read; a null text is empty and has none. Spans of
    different kinds may overlap. Ids keep their type. Rows are independent: repeated rows, null ids and other columns change nothing; an empty
    table gives an empty result.
    """

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                spans = [
                    [{"start": a, "kind": KINDS[k], "end": b} for a, k, b in find_spans(t or "")]
                    for t in piece.column("text").to_pylist()
                ]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, spans array<struct<start:long,kind:string,end:long>>")


def redact_text(text: str) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first gives the name."""
    out, at = [], 0
    for start, kind, end in find_spans(text):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced; all rows and columns stay. Null texts stay null.

    ``length_column``, where there is one of that name, gets the new length in code points of rows that changed. A column of that name
    that holds no whole numbers is left alone.
    """
    counts = length_column in docs.columns and isinstance(docs.schema[length_column].dataType, T.IntegralType)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text_column):
                at = piece.schema.get_field_index(text_column)
                texts = piece.column(at).to_pylist()
                clean = [None if t is None else redact_text(t) for t in texts]
                columns = piece.columns
                columns[at] = pa.array(clean, piece.schema.field(at).type)
                if counts:
                    n = piece.schema.get_field_index(length_column)
                    old = columns[n].to_pylist()
                    new = [o if a == b else len(b) for a, b, o in zip(texts, clean, old, strict=True)]
                    columns[n] = pa.array(new, piece.schema.field(n).type)
                yield pa.RecordBatch.from_arrays(columns, schema=piece.schema)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
