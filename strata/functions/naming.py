"""Table-name and path conventions.

Names are schema in this pipeline: ``bronze_<study>_<node>``,
``silver_<study>_<node>``, ``gold_[staging_|prod_]<study>_<node>``.
Every function returns a Column so the rules run per row on executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Model-name environments that make the study two segments,
# the prefix a deposit key is listed under, and the study of a root-level file.
ENV_SEGMENTS = ("staging", "prod")
DEFAULT_PREFIX = "submissions"
UNASSIGNED_STUDY = "unassigned"
# Fixed value: characters outside this class become "_" in an engine-safe name.
UNSAFE_NAME_CHARS = r"[^a-z0-9_]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_name(c) -> Column:
    """Lower-case and replace every character outside ``[a-z0-9_]`` by "_"."""
    return F.regexp_replace(F.lower(_col(c)), UNSAFE_NAME_CHARS, "_")


def safe_names(headers, reserved: tuple[str, ...] = ()) -> Column:
    """Engine-safe names for an ordered header array.

    A left fold over the headers carries the names already taken (starting
    with ``reserved``); each header gets its safe form, or the first free
    ``<safe>_2``, ``<safe>_3`` ... . A natural ``a_2`` taken earlier is
    skipped over, so ``a, A, a_2`` becomes ``a, a_2, a_2_2``. Per-name
    ``row_number`` cannot express that. Only the new names are returned.
    """
    init = F.array(*[F.lit(r) for r in reserved]) if reserved else F.array().cast("array<string>")
    folded = F.aggregate(_col(headers), init, lambda taken, h: F.concat(taken, F.array(_first_free(taken, h))))
    return F.slice(folded, F.lit(len(reserved) + 1), F.size(folded)) if reserved else folded


def _first_free(taken: Column, header: Column) -> Column:
    base = safe_name(header)

    def candidate(n):
        return F.when(n == 1, base).otherwise(F.concat(base, F.lit("_"), n.cast("string")))

    free = F.filter(F.sequence(F.lit(2), F.size(taken) + 1),
                    lambda n: ~F.array_contains(taken, candidate(n)))
    # Fast path: an unused safe name needs no search.
    return F.when(~F.array_contains(taken, base), base).otherwise(candidate(F.element_at(free, 1)))


def study_from_table(c) -> Column:
    """The second ``_`` segment of a table name (null when there is none)."""
    return F.try_element_at(F.split(_col(c), "_", -1), F.lit(2))


def parse_model_name(c) -> Column:
    """struct(study_id, write_table, finding) for a model/table name.

    ``gold_staging_edcad_subject`` -> (``staging/edcad``, ``subject``);
    ``gold_ausdiab_medical_history`` -> (``ausdiab``, ``medical_history``).
    Names that break the convention get a finding instead of an exception.
    """
    parts = F.split(_col(c), "_", -1)
    n = F.size(parts)
    seg1 = F.try_element_at(parts, F.lit(2))
    seg2 = F.try_element_at(parts, F.lit(3))
    env = seg1.isin(*ENV_SEGMENTS)
    study = F.when(env, F.concat_ws("/", seg1, seg2)).otherwise(seg1)
    rest = F.when(env, F.slice(parts, 4, F.greatest(n - 3, F.lit(1)))) \
        .otherwise(F.slice(parts, 3, F.greatest(n - 2, F.lit(1))))
    table = F.when((env & (n >= 4)) | (~env & (n >= 3)), F.array_join(rest, "_")) \
        .otherwise(F.lit(""))
    finding = (
        F.when(n < 2, F.lit("no study segment"))
        .when(env & (n < 3), F.lit("no study after environment segment"))
        .when(table == "", F.lit("empty table part"))
    )
    study = F.when(n < 2, F.lit(None).cast("string")) \
        .when(env & (n < 3), F.lit(None).cast("string")).otherwise(study)
    return F.struct(study.alias("study_id"), table.alias("write_table"),
                    finding.alias("finding"))


def study_from_path(key, prefix: str = DEFAULT_PREFIX) -> Column:
    """P10: first path segment under the prefix; a file at the root is
    ``unassigned``."""
    k = _col(key)
    rest = F.when(k.startswith(prefix),
                  F.regexp_replace(F.substr(k, F.lit(len(prefix) + 1)), r"^/+", "")) \
        .otherwise(k)
    parts = F.filter(F.split(rest, "/", -1), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.element_at(parts, 1)).otherwise(F.lit(UNASSIGNED_STUDY))


def file_name(key) -> Column:
    """Last path segment of an object key."""
    return F.element_at(F.split(_col(key), "/", -1), -1)


def is_workbook(key) -> Column:
    """``.xlsx`` in any case, and not an Excel ``~$`` lock file."""
    name = file_name(key)
    return F.lower(name).endswith(".xlsx") & ~name.startswith("~$")


def release_path(tag, study, table) -> Column:
    """``release_jsons/v<tag>/<study>/<table>.json``."""
    return F.concat_ws("/", F.lit("release_jsons"), F.concat(F.lit("v"), _col(tag)),
                       _col(study), F.concat(_col(table), F.lit(".json")))
