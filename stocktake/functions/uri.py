"""Column expressions for object URIs, keys and names (all JVM-side, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the URI format: `s3://<bucket>/<key>`; the bucket is the shortest run up to
# the first slash and the key must hold at least one character, so `s3://bucket/` is invalid.
# `(?s)`: a key may hold line breaks.
S3_URI_PATTERN = r"(?s)^s3://(.+?)/(.+)"
# Same split for web URLs (scheme http or https), used on page URLs.
WEB_URL_PATTERN = r"(?s)^https?://(.+?)/(.+)"

# Whitespace removed around map cells (Python's str.strip() set without the rare Unicode spaces).
CELL_WHITESPACE = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_PLAIN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quoted(name: str) -> Column:
    """Column reference safe for names with dots, dashes or spaces (plain names stay unquoted)."""
    if _PLAIN_NAME.match(name):
        return F.col(name)
    return F.col("`" + name.replace("`", "``") + "`")


def _group_or_null(c: Column | str, pattern: str, group: int) -> Column:
    # regexp_extract yields '' on no match; the groups can never be empty on a match.
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def uri_bucket(uri: Column | str, pattern: str = S3_URI_PATTERN) -> Column:
    """Bucket part of a URI, null when the URI does not match."""
    return _group_or_null(uri, pattern, 1)


def uri_key(uri: Column | str, pattern: str = S3_URI_PATTERN) -> Column:
    """Key part of a URI, null when the URI does not match."""
    return _group_or_null(uri, pattern, 2)


def is_valid_uri(uri: Column | str, pattern: str = S3_URI_PATTERN) -> Column:
    return _col(uri).rlike(pattern)


def folder_prefix(key: Column | str) -> Column:
    """Normalise a folder key so that it ends in exactly one added slash (`a` -> `a/`, `a/` -> `a/`)."""
    k = _col(key)
    return F.concat(F.regexp_replace(k, "/$", ""), F.lit("/"))


def render_uri(bucket: Column | str, prefix: Column | str) -> Column:
    return F.concat(F.lit("s3://"), _col(bucket), F.lit("/"), _col(prefix))


def base_name(key: Column | str) -> Column:
    """Last path component, ignoring trailing slashes (`a/b/` -> `b`, `/` -> ``)."""
    return F.substring_index(F.regexp_replace(_col(key), "/+$", ""), "/", -1)


def parent_folder(key: Column | str) -> Column:
    """Everything up to and including the last slash (`a/b/c.csv` -> `a/b/`, `a/b/` -> `a/b/`, `c` -> ``)."""
    return F.regexp_extract(_col(key), r"(?s)^(.*/)", 1)


def strip_quotes(etag: Column | str) -> Column:
    """Remove the double quotes around an ETag."""
    return F.btrim(_col(etag), F.lit('"'))


def clean_cell(c: Column | str) -> Column:
    """Trim a text cell; blank becomes null."""
    return F.nullif(F.btrim(_col(c).cast("string"), F.lit(CELL_WHITESPACE)), F.lit(""))


# Hash kinds. A plain MD5 is 32 lowercase hex digits; a multipart-upload ETag
# is an MD5 of part MD5s followed by `-<number of parts>`.
MD5_PATTERN = r"^[0-9a-f]{32}$"
MULTIPART_ETAG_PATTERN = r"^[0-9a-f]{32}-[0-9]+$"


def hash_kind(h: Column | str) -> Column:
    """`md5`, `multipart` or `other` (null for a null hash): hashes of different kinds never match."""
    c = _col(h)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.rlike(MD5_PATTERN), F.lit("md5"))
        .when(c.rlike(MULTIPART_ETAG_PATTERN), F.lit("multipart"))
        .otherwise(F.lit("other"))
    )


def is_folder_marker(key: Column | str, size: Column | str) -> Column:
    """A zero-byte entry whose key ends in a slash is the folder itself, not a file."""
    return _col(key).endswith("/") & (_col(size) == F.lit(0))


def ancestor_folders(folder: Column | str) -> Column:
    """All folder prefixes of a folder path, shortest first (`a/b/` -> [`a/`, `a/b/`]).

    Used to match an object against every listed folder that contains it at any depth.
    """
    parts = F.split(_col(folder), "/")
    n = F.size(parts) - F.lit(1)
    return F.when(
        n >= 1,
        F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))


# Cells with line breaks are written URL-encoded behind this mark, so that a row of a CSV export is one line and a
# large file can be split; so are cells that begin with the mark.
CELL_MARK = "%url:"


def csv_cell(c: Column | str) -> Column:
    """A text as a cell without line breaks; all but texts with line breaks stay as they are."""
    text = _col(c)
    return F.when(text.rlike(r"[\r\n]") | text.startswith(CELL_MARK), F.concat(F.lit(CELL_MARK), F.url_encode(text))).otherwise(text)


def from_csv_cell(c: Column | str) -> Column:
    """The inverse of :func:`csv_cell`."""
    cell = _col(c)
    return F.when(cell.startswith(CELL_MARK), F.try_url_decode(F.substring(cell, len(CELL_MARK) + 1, 1 << 30))).otherwise(cell)
