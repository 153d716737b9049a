"""Positions of rows in a total order, without a window over all rows.

Two passes: every partition numbers its own rows, the row counts of the
partitions are summed up to where each begins (one row a partition and group),
and a row's position is its number in the partition plus that offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

_AT, _PART, _BASE = "__at", "__part", "__base"


def _numbered(df: DataFrame) -> DataFrame:
    """Row numbers as the tasks of this read meet them, written to the shared
    scratch folder so that all that follows sees the same ones."""
    return written(df.withColumn(_AT, F.monotonically_increasing_id()), "positions")


def _offset(rows: DataFrame, within: Sequence[str], part: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``: number in the part plus the rows of the group's earlier
    parts. ``part`` columns, in order, say which part a row is of."""
    key = [*within, *part]
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.min(_AT).alias("__lo"))
    over = Window.partitionBy(*within).orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(key)],
                           (F.coalesce(F.sum("__n").over(over), F.lit(0)) - F.col("__lo")).alias(_BASE))
    same = [rows[c].eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(key)]
    on = same[0]
    for x in same[1:]:
        on &= x
    own = [c for c in rows.columns if c not in (_AT, _PART)]
    return rows.join(before, on).select(*own, (F.col(_AT) + F.col(_BASE)).cast("long").alias(name))


def ranked(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "index") -> DataFrame:
    """``df`` with ``name``: the 0-based position of each row among the rows
    that agree in ``within`` (null equals null), in ascending ``order`` (nulls
    first). Rows that agree in every column of ``order`` come in any order.

    One range shuffle on (within, order): a group of any size is spread over
    many tasks. Names beginning with two underscores are taken.
    """
    placed = df.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order)
    rows = _numbered(placed).withColumn(_PART, F.shiftright(_AT, 33))
    return _offset(rows, within, [_PART], name)


def line_positions(lines: DataFrame, within: Sequence[str] = (), name: str = "index", split: tuple[str, str] | None = None) -> DataFrame:
    """Lines as ``spark.read.text`` gives them, with ``name``: the 0-based
    position of a line in its file, or, where ``within`` names columns, among
    all lines of that group with its files in path order.

    No shuffle of lines by position: a task meets the lines of a file split in
    order, so counts per (file, split) say where each split begins.
    ``lines`` must come straight from the read; ``_metadata`` is asked for here.
    ``split`` names columns to keep the file and its split (first byte) in.
    """
    own = list(lines.columns)
    rows = _numbered(lines.select(*own, F.col("_metadata.file_path").alias("__file"),
                                  F.col("_metadata.file_block_start").alias("__block")))
    got = _offset(rows, list(within) or ["__file"], ["__file", "__block"] if within else ["__block"], name)
    return got.withColumnsRenamed(dict(zip(("__file", "__block"), split))) if split else got.drop("__file", "__block")


def split_positions(lines: DataFrame, file: str, block: str, name: str = "index") -> DataFrame:
    """``lines`` that carry their file and their split's first byte in the
    columns ``file`` and ``block`` (a streaming batch has no ``_metadata`` of
    its own), with ``name``: the 0-based position of a line in its file."""
    return _offset(_numbered(lines), [file], [block], name)
