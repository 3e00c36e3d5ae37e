"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression. Null text counts as empty and has no span; a text of any
length is scanned whole, in time in proportion to its length; rows are judged one by one, so
repeated rows and ties change nothing; an empty table gives an empty table; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm import spans
from tallyguard.llm.common import free_name, whole_text

BASE_KINDS = ["email", "ip", "card", "phone"]
# A span of an added kind stays at this score or more.
KEEP = 0.7
DIGITS_AND_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Words that speak for a kind when they stand within `spans.CONTEXT` code points.
WORDS = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "ssn": "ssn|social security|social|taxpayer",
}
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# `\G` also allows a start where the match before ended, inside a run.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9])++",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}


def _only(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """The remainder by 97 of an account number: its first four characters last, letters as 10 to 35."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        v = F.instr(F.lit(DIGITS_AND_LETTERS), F.substring(moved, i, F.lit(1))) - 1
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step)


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _card(v: Column, *_) -> Column:
    digits = _only(v, "0-9")
    return F.when(_between(F.length(digits), 12, 19), luhn(digits)).otherwise(False)


def _iban(v: Column, *_) -> Column:
    code = _only(v, "0-9A-Z")
    return F.when(_between(F.length(code), 15, 34), mod97(code) == 1).otherwise(False)


def _score(kind: str, base: float):
    """A start score by how telling the form is, raised by words nearby."""

    def score(value: Column, before: Column, after: Column) -> Column:
        near = F.concat_ws(" ", before, after).rlike(rf"(^|[^a-z])({WORDS[kind]})([^a-z]|$)")
        return F.lit(base) + F.when(near, 0.2).otherwise(0.0)

    return score


def _phone(v: Column, *_) -> Column:
    return _between(F.length(_only(v, "0-9")), 9, 15)


def _ip(v: Column, *_) -> Column:
    return v.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.|$)){4}$")


def _scored(kind: str, base: float, valid) -> spans.Kind:
    """A kind that needs words nearby or a checksum to reach the score."""
    score = _score(kind, base)
    return spans.Kind(kind, PATTERNS[kind], lambda v, b, a: valid(v, b, a) & (score(v, b, a) >= KEEP), score)


def kinds() -> list[spans.Kind]:
    """The base kinds, whose valid matches always stay, and the added ones, which need the score."""
    return [
        spans.Kind("email", PATTERNS["email"], lambda *_: F.lit(True), _score("email", 0.8)),
        spans.Kind("ip", PATTERNS["ip"], _ip, _score("ip", 0.6)),
        spans.Kind("card", PATTERNS["card"], _card, _score("card", 0.7)),
        spans.Kind("phone", PATTERNS["phone"], _phone, _score("phone", 0.6)),
        _scored("iban", 0.75, _iban),
        _scored("ssn", 0.5, lambda v, *_: ~v.rlike("^(000|666|9)|-00-|-0000$")),
    ]


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: personal data as structs (start, rank, kind, end, value, score)."""
    source = free_name(docs, "_whole")
    return spans.matches(docs.withColumn(source, whole_text(text)), source, kinds(), out).drop(source)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the union of all spans in ``text`` replaced by ``[KIND]``; null text stays null.

    Spans that overlap become one mask, of the kind that begins first, so nothing of any span is
    left. ``n_chars``, where the table has it, follows.
    """
    columns = docs.columns
    done = spans.masked(docs, text, kinds(), lambda kind: F.concat(F.lit("["), F.upper(kind), F.lit("]")))
    if "n_chars" in columns:
        changed = F.when(F.col(text).isNotNull(), F.length(text).cast(docs.schema["n_chars"].dataType))
        done = done.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in columns])
