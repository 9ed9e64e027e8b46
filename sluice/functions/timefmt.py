"""RFC3339 text <-> timestamp (FN-1, FN-2).

Text form is whole seconds, UTC rendered as ``Z`` (session zone is UTC, see
``sluice.session``).  Text that is not strict RFC3339 parses to the zero time
``0001-01-01T00:00:00Z`` instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the envelope's time format.
RFC3339_OUT = "yyyy-MM-dd'T'HH:mm:ssXXX"
RFC3339_IN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"
RFC3339_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
ZERO_TIME_TEXT = "0001-01-01T00:00:00Z"


def ZERO_TIME() -> Column:  # noqa: N802 - reads as the constant it stands for
    """The zero time ``0001-01-01 00:00:00`` UTC as a timestamp literal."""
    return F.lit("0001-01-01 00:00:00").cast("timestamp")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rfc3339(ts) -> Column:
    """Timestamp -> RFC3339 text at whole seconds; NULL -> zero time text.

    ``timestamp_ntz`` input is taken as UTC wall-clock time.
    """
    c = _col(ts).cast("timestamp")
    return F.coalesce(F.date_format(c, RFC3339_OUT), F.lit(ZERO_TIME_TEXT))


def parse_rfc3339(text) -> Column:
    """RFC3339 text -> timestamp; anything else -> zero time.

    The shape regex rejects forms the lenient parser would accept
    (date only, missing zone, space separator).
    """
    t = _col(text)
    parsed = F.when(t.rlike(RFC3339_SHAPE),
                    F.try_to_timestamp(t, F.lit(RFC3339_IN)))
    return F.coalesce(parsed, ZERO_TIME())
