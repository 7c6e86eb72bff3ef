"""Column helpers over record text: JSON, URIs, hosts, paths and times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_text(content, path: str) -> Column:
    """Text at a JSON path; JSON null and bad JSON give NULL."""
    return F.get_json_object(content, path)


def uri_did(uri: Column) -> Column:
    """Third part of an AT-URI; a URI without one gives ''."""
    return F.split_part(uri, F.lit("/"), F.lit(3))


def safe_timestamp(text: Column) -> Column:
    """Wall-clock time, NULL for bad text; the zone is ignored."""
    return text.try_cast("timestamp_ntz")


RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def rfc3339(text: Column) -> Column:
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(text))


def nul_escape(content: Column) -> Column:
    """An unescaped ``\\u0000`` in JSON text becomes ``<0x00>``."""
    return F.regexp_replace(content, r"(?<!\\)((?:\\\\)*)\\u0000", "$1<0x00>")


def normal_host(host: Column) -> Column:
    return F.rtrim(host, F.lit("/"))


def is_unset(column: Column) -> Column:
    """NULL or the store's empty text."""
    return column.isNull() | (column == "")


def collection_of(path: Column) -> Column:
    return F.split(path, "/", 2)[0]


def rkey_of(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/", 2), F.lit(2))


#: Patterns that error texts are grouped by, and what stands for them (fixed values).
ERROR_PATTERNS = (
    (r"did:[:a-z0-9]+", "did:xxx"),
    (r"json\.RawMessage\{[^}]+\}", "json.RawMessage{...}"),
    (r"[0-9]{1,3}(\.[0-9]{1,3}){3}:[0-9]+", "<IP>:<port>"),
)


def normal_error(error: Column) -> Column:
    for pattern, name in ERROR_PATTERNS:
        error = F.regexp_replace(error, pattern, name)
    return error


def like(value: Column, pattern: str, fold: bool = False) -> Column:
    """SQL ``like``, or ``ilike`` with ``fold``; a null value gives null."""
    return value.ilike(pattern) if fold else value.like(pattern)
