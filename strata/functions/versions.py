"""Release-tag ordering.

A tag's version is the tuple of the leading digits of each ``.`` part of the
stripped tag (no digits -> 0; suffixes such as ``rc1`` ignored). Spark arrays
compare element-wise with a shorter prefix first, exactly like Python tuples.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import leading_int, py_strip


def version_key(tag) -> Column:
    """array<decimal(38,0)> version tuple of a release tag."""
    t = F.col(tag) if isinstance(tag, str) else tag
    return F.transform(F.split(py_strip(t), r"\.", -1), lambda p: leading_int(p))


def release_order(tag: str = "release_tag") -> list[Column]:
    """Total order, newest first: greatest version tuple, then the shortest
    tag, then text order. ``1.10.0`` and ``1.10.0rc1`` tie on the tuple; the
    shorter wins."""
    return [F.desc(version_key(tag)), F.asc(F.length(F.col(tag))), F.asc(F.col(tag))]
