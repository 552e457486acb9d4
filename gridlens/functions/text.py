"""Column expressions for text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A byte-order mark as seen in UTF-8 and when UTF-8 is read as Latin-1.
BYTE_ORDER_MARKS = ("\ufeff", "ï»¿")


def strip(value: Column) -> Column:
    """Remove every kind of whitespace at both ends (``trim`` removes blanks only).

    Looking for a set of characters is slow; text that begins and ends with printable ASCII has nothing to remove.
    """
    plain = F.substring(value, 1, 1).between("!", "~") & F.substring(value, -1, 1).between("!", "~")
    return F.when(plain, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def strip_upper(value: Column) -> Column:
    return F.upper(strip(value))


def is_blank(value: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return strip(F.coalesce(value, F.lit(""))) == ""


def pad_left(value: Column, width: int, fill: str = "0") -> Column:
    """Left-pad without truncating longer text, which ``lpad`` would do."""
    return F.when(F.length(value) < width, F.lpad(value, width, fill)).otherwise(value)


def pad_geo_code(value: Column) -> Column:
    """Six-digit geographic code; empty stays empty."""
    text = value.cast("string")
    return F.when(text == "", text).otherwise(pad_left(text, 6))


def clean_header(name: str) -> str:
    for mark in BYTE_ORDER_MARKS:
        name = name.replace(mark, "")
    return name.strip()
