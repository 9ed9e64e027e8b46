"""Scalar Column functions (time text, versions, routes, JSON text)."""

from .timefmt import ZERO_TIME, ZERO_TIME_TEXT, parse_rfc3339, rfc3339
from .semver import parse_semver, registry_key, semver_text
from .routes import schema_uri, topic_of, uri_name, uri_version
from .jsontext import split_csv, text_of_bytes, try_json, valid_utf8

__all__ = [
    "ZERO_TIME", "ZERO_TIME_TEXT", "parse_rfc3339", "rfc3339",
    "parse_semver", "registry_key", "semver_text",
    "schema_uri", "topic_of", "uri_name", "uri_version",
    "split_csv", "text_of_bytes", "try_json", "valid_utf8",
]
