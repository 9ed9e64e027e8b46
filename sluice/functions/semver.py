"""Version text <-> ``STRUCT<major,minor,patch>`` (FN-3, FN-4, FN-5).

Parsing rule: one to three dot-separated unsigned decimal parts, each in
0..1023 (a 10-bit unsigned value); missing parts are 0; an empty part, a sign,
an underscore or a fourth part is an error (NULL).  Leading zeros are accepted
and normalised, so ``01.0`` and ``1`` are the same version.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The version grammar and the per-part bound.
VERSION_SHAPE = r"^[0-9]+(\.[0-9]+){0,2}$"
PART_MAX = 1023
DEFAULT_KEY_PREFIX = "schema"
KEY_SEPARATOR = ":"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_semver(text) -> Column:
    """Version text -> struct(major, minor, patch) of INT, or NULL if invalid."""
    t = _col(text)
    parts = F.split(t, r"\.")

    def part(i: int) -> Column:
        # Strip leading zeros before the numeric cast so a 41-digit value of
        # zeros does not overflow, and a long value fails the length check.
        p = F.coalesce(F.get(parts, i), F.lit("0"))
        digits = F.regexp_replace(p, r"^0+(?=[0-9])", "")
        return F.when(F.length(digits) <= 4, digits.try_cast("int"))

    major, minor, patch = part(0), part(1), part(2)
    ok = (t.rlike(VERSION_SHAPE)
          & (major <= PART_MAX) & (minor <= PART_MAX) & (patch <= PART_MAX))
    return F.when(ok, F.struct(major.alias("major"), minor.alias("minor"),
                               patch.alias("patch")))


def semver_text(v) -> Column:
    """struct(major, minor, patch) -> ``M.m.p``."""
    s = _col(v)
    return F.concat_ws(".", s["major"].cast("string"), s["minor"].cast("string"),
                       s["patch"].cast("string"))


def registry_key(name, version, prefix: str = DEFAULT_KEY_PREFIX) -> Column:
    """``prefix:name:M.m.p`` from a name and a parsed version struct."""
    return F.concat_ws(KEY_SEPARATOR, F.lit(prefix), _col(name), semver_text(version))
