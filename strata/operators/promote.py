"""Bronze -> silver promotion.

Top-1-per-key deduplication is a ``row_number`` window; Catalyst plans it as
a partial ``WindowGroupLimit`` below the shuffle, so a hot key is reduced to
one row per map partition before it moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.text import py_strip

# Literal frames at or below this many rows are broadcast by hint; anything
# larger is left to AQE's runtime size check (autoBroadcastJoinThreshold).
LITERAL_BROADCAST_MAX_ROWS = 100_000


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedupe_bronze(df: DataFrame) -> DataFrame:
    """One row per ``row_hash``; newest ``_src_ingested_at`` wins, then the
    greater batch id. Edited cells carry a new hash and land as new rows."""
    return newest_per_key(df, ["row_hash"], [F.desc("_src_ingested_at"), F.desc("_src_batch_id")])


def dedupe_registry(df: DataFrame, file_key: Sequence[str] | str = "baseid",
                    registered_at: str = "registered_at", tiebreak: Sequence[str] = ("did",)) -> DataFrame:
    """Newest registration per file (``ROW_NUMBER() ... ORDER BY
    registered_at DESC``), with a unique tail so the pick is deterministic."""
    keys = [file_key] if isinstance(file_key, str) else list(file_key)
    return newest_per_key(df, keys, [F.desc(registered_at)] + [F.desc(t) for t in tiebreak])


def silver_shape(df: DataFrame, spec: Sequence[tuple[str, Column | str, str | None]]) -> DataFrame:
    """P5: rename/cast/convert to dictionary properties.

    ``spec`` items are ``(target, source expr, type)``; the cast is
    ``try_cast`` so a bad text value becomes null instead of failing the job
    (ANSI mode is on)."""
    out = []
    for target, source, dtype in spec:
        expr = F.col(source) if isinstance(source, str) else source
        out.append((expr.try_cast(dtype) if dtype else expr).alias(target))
    return df.select(*out)


def split_multivalue(c) -> Column:
    """``;``-separated cell -> list of stripped, non-empty values."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.transform(F.split(col, ";", -1), lambda x: py_strip(x)), lambda x: x != "")


def submission_record(df: DataFrame, node: str, submitter_id: Column | str, properties: Sequence[str],
                links: Mapping[str, Column | str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Submission-shaped record ``{type, submitter_id, <props>, <link>:
    {submitter_id}}`` as a struct column ``record`` (plus ``keep`` columns)."""
    sid = F.col(submitter_id) if isinstance(submitter_id, str) else submitter_id
    fields = [F.lit(node).alias("type"), sid.alias("submitter_id")]
    fields += [F.col(p).alias(p) for p in properties]
    for name, target in (links or {}).items():
        t = F.col(target) if isinstance(target, str) else target
        fields.append(F.struct(t.alias("submitter_id")).alias(name))
    return df.select(*keep, F.struct(*fields).alias("record"))


def link_check(child: DataFrame, parent: DataFrame, child_fk: str, parent_key: str) -> DataFrame:
    """Child rows whose parent key does not exist (left anti).
    A null foreign key is not a broken link."""
    p = parent.select(F.col(parent_key).alias("__pk"))
    return child.filter(F.col(child_fk).isNotNull()) \
        .join(p, F.col(child_fk) == F.col("__pk"), "left_anti")


def link_counts(child: DataFrame, parent: DataFrame, child_fk: str, parent_key: str) -> DataFrame:
    """J2 summary in one pass: children and children whose parent is missing
    (left join against the distinct parent keys, then one aggregate)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    j = child.join(p, F.col(child_fk) == F.col("__pk"), "left")
    missing = F.col(child_fk).isNotNull() & F.col("__pk").isNull()
    return j.agg(F.count(F.lit(1)).alias("n_children"),
                 F.count(F.when(missing, 1)).alias("n_missing"))


def attach_object_id(files: DataFrame, registry: DataFrame, file_key: str, registry_key: str,
                     registered_at: str, object_id: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Left-join the *deduplicated* registry (W2) to file records."""
    reg = dedupe_registry(registry, registry_key, registered_at, tiebreak or (object_id,)) \
        .select(F.col(registry_key).alias("__rk"), F.col(object_id).alias("object_id"))
    return files.join(reg, F.col(file_key) == F.col("__rk"), "left").drop("__rk")


def vocabulary_frame(spark: SparkSession, vocab: Mapping[str, str], key: str = "source_value",
                     value: str = "term") -> DataFrame:
    """A controlled vocabulary as a small DataFrame (size known: len(vocab))."""
    return spark.createDataFrame([(k, v) for k, v in vocab.items()], f"{key} string, {value} string")


def vocab_map(df: DataFrame, column: str, vocab: DataFrame, key: str = "source_value",
              value: str = "term", out: str | None = None, known_rows: int | None = None) -> DataFrame:
    """Controlled-value mapping, left join; unmapped -> null.

    The vocabulary is broadcast by hint only when its row count is known and
    small (``known_rows``, e.g. a literal map); otherwise AQE measures it at
    runtime and falls back to a shuffle join when it is large."""
    v = vocab.select(F.col(key).alias("__vk"), F.col(value).alias(out or value))
    if known_rows is not None and known_rows <= LITERAL_BROADCAST_MAX_ROWS:
        v = F.broadcast(v)
    return df.join(v, F.col(column) == F.col("__vk"), "left").drop("__vk")
