"""Named custom checks (EXT-1), usable from DataFrames and from SQL.

A check is registered under a name and applied by name, so request validation
can refer to it the way struct tags refer to registered validators.  Two kinds:

- an *expression check* is a SQL expression over ``x`` (a STRING).  ``install``
  makes each of them a temporary SQL function ``check_<name>``, so it is part of the
  optimised plan wherever it is called, with no Python on its path;
- a *frame check* is a function ``(df, column, out) -> df`` that adds a BOOLEAN
  column, for tests that are queries of their own, as the registry's admission check.

Null results count as failed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nodes
from .routes import URI_TAIL

FrameCheck = Callable[[DataFrame, str, str], DataFrame]
_EXPRESSIONS: dict[str, str] = {}
_FRAMES: dict[str, FrameCheck] = {}
_NAME = re.compile(r"[a-z][a-z0-9_]*")


def register_check(name: str, test: str | FrameCheck, replace: bool = False) -> None:
    """Register a SQL expression over ``x``, or a frame check, under ``name``."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"a check is named in lower-case letters, digits and _: {name!r}")
    if name in registered() and not replace:
        raise ValueError(f"check {name!r} is already registered")
    for kind in (_EXPRESSIONS, _FRAMES):
        kind.pop(name, None)
    (_EXPRESSIONS if isinstance(test, str) else _FRAMES)[name] = test


def registered() -> list[str]:
    return sorted([*_EXPRESSIONS, *_FRAMES])


def install(spark: SparkSession) -> list[str]:
    """(Re)create the SQL function of every expression check; their names."""
    for name, expression in _EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION check_{name}(x STRING) RETURNS BOOLEAN "
                  f"RETURN coalesce({expression}, false)")
    return [f"check_{name}" for name in sorted(_EXPRESSIONS)]


def check(name: str, col: Column | str) -> Column:
    """Apply the expression check registered under ``name`` (after ``install``)."""
    if name not in _EXPRESSIONS:
        raise KeyError(f"no expression check named {name!r}")
    return F.call_function(f"check_{name}", (F.col(col) if isinstance(col, str) else col).cast("string"))


def passes(df: DataFrame, name: str, column: str, out: str) -> DataFrame:
    """``df`` with BOOLEAN ``out``: does ``column`` pass the check, of either kind."""
    if name in _FRAMES:
        return _FRAMES[name](df, column, out).withColumn(out, F.coalesce(out, F.lit(False)))
    install(df.sparkSession)
    return df.withColumn(out, check(name, column))


register_check("json_schema", nodes.with_admission)
register_check("json", "try_parse_json(x) IS NOT NULL")
register_check("required", "x IS NOT NULL AND x <> ''")
register_check("email", f"x RLIKE {nodes.literal(nodes.EMAIL_SHAPE)}")
register_check("pattern", nodes.pattern_ok("x"))
register_check("schema_uri", f"x RLIKE {nodes.literal(URI_TAIL)}")
register_check("version", "CASE WHEN x RLIKE '^0*[0-9]{1,4}([.]0*[0-9]{1,4}){0,2}$' "
                          "THEN forall(split(x, '[.]'), p -> try_cast(p AS INT) <= 1023) END")
