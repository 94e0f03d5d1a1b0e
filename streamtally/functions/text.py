"""Text keys and escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the delimited-text format.
NULL_MARKER = "\\N"
ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def escaped_field(value: Column) -> Column:
    """One field of a tab-separated line: escaped text, or the null marker."""
    text = value.cast("string")
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return F.coalesce(text, F.lit(NULL_MARKER))


def surrogate_key(name: Column) -> Column:
    """A stable ten-digit id: the first 32 bits of the SHA-1 of the name, in decimal."""
    return F.lpad(F.conv(F.substring(F.sha1(name), 1, 8), 16, 10), 10, "0")


def hash_salt(value: Column, salts: int) -> Column:
    """A stable salt in ``0 .. salts-1``; the same row gets the same salt on a retry."""
    return F.pmod(F.xxhash64(value), F.lit(salts)).cast("int")
