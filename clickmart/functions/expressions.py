"""Column expressions shared by the plans. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower spend bound of each segment, highest first, and the rest.
SEGMENT_LADDER = [(1000, "VIP"), (500, "Premium"), (100, "Regular")]
SEGMENT_REST = "New"

# Interaction strength per interaction type.
STRENGTHS = {"view": 1, "cart": 2, "purchase": 3, "like": 4}

# Longest text that the key-value export still reads as a number.
MAX_INT_TEXT = 10
MAX_FLOAT_TEXT = 20

# Texts that count as a number.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def cents(price: Column) -> Column:
    """Price in whole cents, a half cent rounded away from zero as by a column of two decimals.

    Summing integers is exact, so a total does not depend on row order.
    """
    return (price.try_cast("decimal(20,2)") * 100).try_cast("long")


def money_sum(price: Column) -> Column:
    return F.sum(cents(price)) / F.lit(100.0)


def money_avg(price: Column) -> Column:
    amount = cents(price)
    return F.try_divide(F.sum(amount) / F.lit(100.0), F.count(amount))


def guarded_ratio(n: Column, d: Column, scale: float = 100.0) -> Column:
    """``n * scale / d``, or 0 when there is nothing to divide by."""
    return F.when(d > 0, n * F.lit(scale) / d).otherwise(F.lit(0.0))


def day_diff(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from start to end."""
    return F.datediff(end, start).cast("long")


def minute_diff(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end, which is not the number of whole minutes."""
    return F.floor(F.unix_seconds(end) / 60) - F.floor(F.unix_seconds(start) / 60)


def segment(spend: Column) -> Column:
    """Spend ladder; a missing spend falls through to the lowest segment."""
    ladder = F
    for bound, label in SEGMENT_LADDER:
        ladder = ladder.when(spend >= bound, F.lit(label))
    return ladder.otherwise(F.lit(SEGMENT_REST))


def strength(interaction_type: Column) -> Column:
    ladder = F
    for name, value in STRENGTHS.items():
        ladder = ladder.when(interaction_type == name, F.lit(value))
    return ladder


def _text_length(c: Column) -> Column:
    """Characters of a value as text; a number with an exponent counts as it is written without one.

    Text itself is taken as it stands, whatever it looks like.
    """
    text = c.cast("string")
    sign = F.when(text.startswith("-"), 1).otherwise(0)
    digits = F.length(F.rtrim(F.regexp_replace(text, r"^-|\.|E.*$", ""), F.lit("0")))
    exponent = F.regexp_extract(text, r"E([0-9]+)$", 1).try_cast("int")
    plain = sign + F.when(exponent >= digits - 1, exponent + 3).otherwise(digits + 1)
    is_number = F.typeof(c).isin("double", "float") & text.rlike(r"^-?[0-9.]+E([0-9]|1[0-5])$")
    return F.when(is_number, plain).otherwise(F.length(text))


def safe_int(c: Column) -> Column:
    """Whole number towards zero; NULL, unreadable or over-long text gives 0."""
    text = c.cast("string")
    number = F.when(text.rlike(NUMBER), text.try_cast("double")).try_cast("long")
    return F.when(_text_length(c) > MAX_INT_TEXT, F.lit(0).cast("long")).otherwise(
        F.coalesce(number, F.lit(0).cast("long"))
    )


def safe_float(c: Column) -> Column:
    """Number; NULL, unreadable or over-long text gives 0.0."""
    text = c.cast("string")
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(_text_length(c) > MAX_FLOAT_TEXT, F.lit(0.0)).otherwise(
        F.coalesce(number, F.lit(0.0))
    )


def default_text(c: Column, default: str) -> Column:
    """Text, with NULL and the empty string replaced."""
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(default))


def pad_id(prefix: str, number: Column, width: int = 4) -> Column:
    """``prefix`` and a zero-padded number; wider numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", number)


def pick(values: list[str], index: Column) -> Column:
    """The value at a zero-based position, wrapping around the list."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int")
    )
