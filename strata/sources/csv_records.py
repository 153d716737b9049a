"""CSV records over several lines, found split by split.

A quoted cell may hold line feeds, so whether a line begins a record depends on
all quotes before it. What a line does to that is a map of two states (outside
or inside quotes): most lines leave both as they are, some set the state
whatever it was, some turn it round. Maps compose, so every split of a file sums
up its own lines, one row a split is composed over the file, and each line's
state follows from its split's. Only lines that hold a quote take part.

Quotes follow RFC 4180: one opens a cell only at the cell's start, a doubled
one inside quotes is a quote, and one inside an unquoted cell is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

#: Columns of lines: file, split (its first byte), position in the file, text.
FILE, SPLIT, AT, LINE = "file", "split", "at", "line"
_FRESH, _CELL, _INSIDE, _CLOSED = 0, 1, 2, 3


def _ends(line: Column, delimiter: Column, begin: int) -> Column:
    """The state after a line that begins in state ``begin``: a fold over the
    pieces between its quotes."""

    def text(state: Column, piece: Column) -> Column:
        after = F.when(piece.endswith(delimiter), _FRESH).otherwise(_CELL)
        return F.when((piece == "") | (state == _INSIDE), state).otherwise(after)

    def quote(state: Column) -> Column:
        return F.when(state == _FRESH, _INSIDE).when(state == _CELL, _CELL).when(state == _INSIDE, _CLOSED).otherwise(_INSIDE)
    pieces = F.split(line, '"', -1)
    first = text(F.lit(begin), F.element_at(pieces, 1))
    return F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, lambda state, piece: text(quote(state), piece)) == _INSIDE


def _inside_after(over: Window, begin: Column) -> Column:
    """Whether the state after a row is inside: that of the last row that sets
    it, else the beginning, turned round by every row after it that does."""
    sets = F.last("sets", ignorenulls=True).over(over)
    at_set = F.coalesce(F.last(F.when(F.col("sets").isNotNull(), F.col("turns")), ignorenulls=True).over(over), F.lit(0))
    return F.coalesce(sets, begin) != ((F.col("turns") - at_set) % 2 == 1)


def quoted_lines(lines: DataFrame) -> DataFrame:
    """(file, split, at, before, after) of the lines that hold a quote:
    whether they begin and end inside quotes. ``lines`` has ``delimiter``."""
    q = lines.where(F.contains(LINE, F.lit('"'))) \
        .withColumns({"o": _ends(F.col(LINE), F.col("delimiter"), _FRESH), "i": _ends(F.col(LINE), F.col("delimiter"), _INSIDE)}) \
        .select(FILE, SPLIT, AT, F.when(F.col("o") == F.col("i"), F.col("o")).alias("sets"), (F.col("o") & ~F.col("i")).alias("turn"))
    own = Window.partitionBy(FILE, SPLIT).orderBy(AT)
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    q = written(q.withColumn("turns", F.sum(F.col("turn").cast("long")).over(so_far)), "csv-quotes")
    # The map of a whole split: what its last setting line and the turns after it come to.
    split_map = q.groupBy(FILE, SPLIT).agg(
        F.max_by("sets", F.when(F.col("sets").isNotNull(), F.col(AT))).alias("set"),
        F.coalesce(F.max(F.when(F.col("sets").isNotNull(), F.col("turns"))), F.lit(0)).alias("at_set"), F.max("turns").alias("all"))
    split_map = split_map.select(
        FILE, SPLIT, (F.col("set") != ((F.col("all") - F.col("at_set")) % 2 == 1)).alias("sets"),
        (F.col("set").isNull() & (F.col("all") % 2 == 1)).alias("turn"))
    files = Window.partitionBy(FILE).orderBy(SPLIT)
    up_to = files.rowsBetween(Window.unboundedPreceding, 0)
    split_map = split_map.withColumn("turns", F.sum(F.col("turn").cast("long")).over(up_to))
    split_map = split_map.withColumn("after", _inside_after(up_to, F.lit(False)))
    begins = split_map.select(FILE, SPLIT, F.coalesce(F.lag("after").over(files), F.lit(False)).alias("begin"))
    q = q.join(begins, [FILE, SPLIT]).withColumn("after", _inside_after(so_far, F.col("begin")))
    return q.select(FILE, SPLIT, AT, F.coalesce(F.lag("after").over(own), F.col("begin")).alias("before"), "after")


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows (file, split, at) with their number in the file."""
    own = Window.partitionBy(FILE, SPLIT).orderBy(AT)
    counts = rows.groupBy(FILE, SPLIT).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(FILE, SPLIT, F.coalesce(before, F.lit(0)).alias("base"))
    return rows.withColumn(name, F.row_number().over(own)).join(base, [FILE, SPLIT]).withColumn(name, F.col(name) + F.col("base")).drop("base")


def long_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans, open): ``spans`` has (file, first, last) of every record of more
    than one line; ``open`` (file, first) of the quote that a file never closes,
    so that what follows cannot be told to be its cell.

    The k-th line that opens a record is closed by the k-th that ends one, so
    they are joined on their numbers; no file is put into one task."""
    q = written(quoted_lines(lines).where("before <> after"), "csv-turns")
    opens = _numbered(q.where("NOT before AND after"), "k").select(FILE, "k", F.col(AT).alias("first"))
    closes = _numbered(q.where("before AND NOT after"), "k").select(FILE, "k", F.col(AT).alias("last"))
    both = written(opens.join(closes, [FILE, "k"], "left"), "csv-records")
    return both.where("last IS NOT NULL").select(FILE, "first", "last"), both.where("last IS NULL").select(FILE, "first")


def assemble(lines: DataFrame) -> DataFrame:
    """(file, at, record, open): records in the order of ``at`` (their first
    line); the lines of one are joined by line feeds. ``open`` marks the lines
    from a quote on that its file never closes: each stays a row of its own, so
    no line is lost and no group grows with a file. Every other column of
    ``lines`` is dropped."""
    spans, never = long_records(lines)
    inner = spans.select(F.col(FILE).alias("f"), F.explode(F.sequence("first", "last")).alias("a"), F.col("first").alias("of"))
    tagged = lines.join(inner, (F.col(FILE) == F.col("f")) & (F.col(AT) == F.col("a")), "left") \
        .join(never.select(F.col(FILE).alias("g"), F.col("first").alias("from")), F.col(FILE) == F.col("g"), "left") \
        .select(FILE, AT, LINE, "of", F.coalesce(F.col(AT) >= F.col("from"), F.lit(False)).alias("open"))
    single = tagged.where("of IS NULL").select(FILE, AT, F.col(LINE).alias("record"), "open")
    joined = tagged.where("of IS NOT NULL").groupBy(FILE, "of") \
        .agg(F.sort_array(F.collect_list(F.struct(AT, LINE))).alias("x")) \
        .select(FILE, F.col("of").alias(AT), F.array_join(f"x.{LINE}", "\n").alias("record"), F.lit(False).alias("open"))
    return single.unionByName(joined)
