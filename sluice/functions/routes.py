"""Topic and schema URI naming (PRJ-8, PRJ-9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semver import PART_MAX

# Topic suffix and URI layout ``<base>/schemas/<name>/<version>``.
TOPIC_SUFFIX = "-topic"
URI_SEGMENT = "/schemas/"
DEFAULT_REGISTRY_BASE = "http://schema-repository:8080"
URI_TAIL = r"/schemas/([^/]+)/([^/]+)$"

_PART = r"(0|[1-9][0-9]{0,2}|10[01][0-9]|102[0-3])"
SHORT_VERSION = r"^0*[0-9]{1,4}(\.0*[0-9]{1,4}){0,2}$"
CANONICAL_TAIL = rf"/schemas/[^/]+/{_PART}\.{_PART}\.{_PART}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def topic_of(name) -> Column:
    """Entity name -> topic name."""
    return F.concat(_col(name), F.lit(TOPIC_SUFFIX))


def schema_uri(name, version, base: str = DEFAULT_REGISTRY_BASE) -> Column:
    """(name, version text) -> schema URI."""
    return F.concat(F.lit(base + URI_SEGMENT), _col(name), F.lit("/"), _col(version))


def _tail(uri, group: int) -> Column:
    u = _col(uri)
    return F.when(u.rlike(URI_TAIL), F.regexp_extract(u, URI_TAIL, group))


def uri_name(uri) -> Column:
    """Schema name from a URI; NULL when the URI has no ``/schemas/n/v`` tail."""
    return _tail(uri, 1)


def uri_version(uri) -> Column:
    """Version text from a URI; NULL when the URI has no ``/schemas/n/v`` tail."""
    return _tail(uri, 2)


def normalise_uri(uri: Column | str) -> Column:
    """Rewrite a URI's version tail to ``M.m.p`` (``…/order/2`` → ``…/order/2.0.0``).

    URIs without a parsable ``/schemas/<name>/<version>`` tail are returned
    unchanged, so they simply find no schema.  The steps are bound one after the
    other with lambdas: each part of the URI is extracted once per row, wherever
    the optimiser copies the expression.
    """
    def bound(c: Column, f: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(c), f), F.lit(0))

    def text(head: Column, n: Column) -> Column:
        part = [F.coalesce(F.get(n, F.lit(i)), F.lit(0)).cast("string") for i in range(3)]
        return F.concat(F.regexp_replace(head, "[^/]+$", ""), part[0], F.lit("."), part[1], F.lit("."), part[2])

    def slow(u: Column) -> Column:
        return bound(F.regexp_extract(u, URI_TAIL, 2), lambda t: F.when(t.rlike(SHORT_VERSION), bound(
            F.transform(F.split(t, r"\."), lambda p: p.try_cast("int")),
            lambda n: F.when(F.forall(n, lambda x: x <= PART_MAX), text(u, n)).otherwise(u))).otherwise(u))

    # fast path: a tail that is already M.m.p without leading zeros, each part <= 1023
    u = _col(uri)
    return F.when(u.rlike(CANONICAL_TAIL), u).otherwise(bound(u, slow))
