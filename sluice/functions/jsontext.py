"""Payload text helpers (FN-6, FN-7, FN-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_json(text) -> Column:
    """JSON text -> VARIANT; NULL when the text is not JSON."""
    return F.try_parse_json(_col(text))


def text_of_bytes(b) -> Column:
    """Payload bytes -> text (UTF-8), unchanged."""
    return _col(b).cast("string")


def valid_utf8(b) -> Column:
    """Payload bytes -> text, NULL when the bytes are not valid UTF-8."""
    return F.try_validate_utf8(_col(b).cast("string"))


def split_csv(text) -> Column:
    """``a,b,c`` -> array of parts."""
    return F.split(_col(text), ",")
