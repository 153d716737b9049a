"""Scalar text helpers (X1, X7, X13, X15, X17). All return Column expressions
that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# written as a regex character class that both Java regex and RE2 accept.
PY_WHITESPACE_CLASS = (
    r"\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
PY_STRIP_PATTERN = rf"\A[{PY_WHITESPACE_CLASS}]+|[{PY_WHITESPACE_CLASS}]+\z"
# The same set as characters, for a set-trim (no regex engine per value).
PY_WHITESPACE_CHARS = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """A column by its exact name, even with dots, spaces or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def py_strip(c) -> Column:
    """Strip leading/trailing Unicode whitespace the way ``str.strip`` does.
    Plain SQL ``trim`` removes spaces only."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def text_or_empty(c) -> Column:
    """Null -> "", any other value -> its text."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def leading_int(c) -> Column:
    """The leading ASCII digits of a text as an integer, else 0."""
    digits = F.regexp_extract(_col(c), r"^([0-9]+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("decimal(38,0)"),
                      F.lit(0).cast("decimal(38,0)"))


def release_tag_from_git(c) -> Column:
    """Git tag ``data-v0.1.0`` is stored as ``0.1.0``."""
    return F.regexp_replace(_col(c), r"^data-v", "")
