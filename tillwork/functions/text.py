"""Text column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "UNKNOWN"

# The characters that count as white space, for trimming and as a regex class. Spelled
# out, because the Unicode mode of \\s costs several times more per row.
_BLANKS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680)) + "".join(
    chr(c) for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
_BLANK = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Decimal digits plus the superscript, subscript and circled digits.
_ALL_DIGITS = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]+$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def squeeze(c: Column, by: str = "_") -> Column:
    """Every run of white space becomes `by`."""
    return F.regexp_replace(c, rf"[{_BLANK}]+", by)


def bare_key(c: Column) -> Column:
    """Strip, upper-case, white space to underscore; NULL stays NULL."""
    return squeeze(F.upper(strip(c)))


def text_key(c: Column) -> Column:
    return F.coalesce(bare_key(c), F.lit(UNKNOWN))


def country_key(c: Column) -> Column:
    return F.coalesce(F.replace(bare_key(c), F.lit("UNSPECIFIED"), F.lit(UNKNOWN)), F.lit(UNKNOWN))


def customer_key(c: Column, number: bool = False) -> Column:
    """Ids that went through a float column lose their `.0` tail; NULL becomes UNKNOWN. `number`: the column is a float."""
    text = c.cast("string")
    if number:
        small = F.when(F.abs(c) < F.lit(2.0**62), c)  # NULL for NaN and what a bigint cannot hold
        text = F.when(small == F.floor(small), small.cast("bigint").cast("string")).otherwise(text)
    return F.coalesce(F.regexp_replace(text, r"^([0-9]+)\.0+$", "$1"), F.lit(UNKNOWN))


def to_number(c: Column) -> Column:
    """Double where the text is a number, else NULL.

    The cast alone would also take Java's type suffixes and hexadecimal forms, so only digits, signs,
    points and exponents reach it.
    """
    text = strip(c.cast("string"))
    infinite = F.lower(F.btrim(text, F.lit("+-"))).isin("inf", "infinity")
    return F.when(~text.rlike(r"[^0-9eE.+-]") | infinite, text.try_cast("double"))


def all_digits(c: Column) -> Column:
    return F.coalesce(c.rlike(_ALL_DIGITS), F.lit(False))


def first_match(c: Column, pattern: str) -> Column:
    """First match of a one-group pattern, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def plain_words(c: Column) -> Column:
    """ASCII letters and digits only, other runs become a blank, then a key; NULL stays NULL."""
    return bare_key(F.regexp_replace(c, rf"[^0-9a-zA-Z{_BLANK}]+", " "))


@F.pandas_udf(T.StringType())
def _decompose(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKD", v), na_action="ignore")


def compatibility_form(c: Column) -> Column:
    """NFKD. Only values outside ASCII reach the Python worker; the rest are sent as NULL."""
    exotic = c.rlike(r"[^\x00-\x7F]")
    return F.when(exotic, _decompose(F.when(exotic, c))).otherwise(c)


def product_words(c: Column, decompose: bool = True) -> Column:
    """Letters and digits joined by single underscores, upper-case; empty or NULL is UNKNOWN."""
    text = compatibility_form(c) if decompose else c
    joined = F.regexp_replace(text, r"[^\p{L}\p{N}_]", "_")
    joined = F.regexp_replace(joined, r"^_+|_+$", "")
    joined = F.regexp_replace(joined, r"_+", "_")
    return F.coalesce(F.upper(F.nullif(joined, F.lit(""))), F.lit(UNKNOWN))


def title_words(c: Column) -> Column:
    """Underscores to blanks, then a capital after every non-letter."""
    pieces = F.split(F.lower(F.replace(c, F.lit("_"), F.lit(" "))), r"(?<=[^\p{L}])")
    capital = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2147483647)))
    return strip(F.array_join(capital, ""))


def stable_id(c: Column) -> Column:
    """60-bit surrogate key from the text; the same in every run and on every executor."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_percent(*parts: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the text parts; independent of row order and partitioning."""
    return (stable_id(F.concat_ws("|", *parts)) % F.lit(buckets)).cast("int")
