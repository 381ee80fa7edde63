"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a text is stripped.
WHITESPACE = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends; Spark's own trim removes blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def contains_any(column: str, needles: list[str]) -> Column:
    return F.expr(" OR ".join(f"contains({column}, '{n}')" for n in needles))


def payload_text(value: Column) -> Column:
    """Bytes as text: UTF-8 where valid, else base64 in one line."""
    return F.when(F.is_valid_utf8(value), value.cast("string")).otherwise(
        F.replace(F.base64(value), F.lit("\r\n"), F.lit("")))


def payload_bytes(payload: Column, is_text: Column) -> Column:
    """The bytes that `payload_text` has shown: of a text itself, else what the base64 stands for."""
    return F.when(is_text, F.encode(payload, "UTF-8")).otherwise(F.try_to_binary(payload, F.lit("base64")))


def reason_class(reason: Column) -> Column:
    """The part of a reason before its values."""
    return F.substring_index(reason, ":", 1)
