"""Validation gate and run summaries.

Contract: the gate returns the distinct failure signatures of the latest run;
**no rows means pass, any row means fail**. Three invariants are kept:
scope to ``validation_id = max(validation_id)``, exclude ``PASS`` markers, and
read the results of the current target only (the caller passes that frame).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (assumption): LIKE patterns for the gate's known-noise
# categories — null-typed fields, additional properties, and the root
# ``programs`` requirement.
DEFAULT_IGNORED_ERRORS = (
    "None is not of type%",
    "Additional properties are not allowed%",
    "'programs' is a required property%",
)
# Fixed value: studies matching this pattern are not gated (``synth1`` is).
SYNTHETIC_STUDY_PATTERN = "%synthetic%"
SIGNATURE_COLUMNS = ("study_id", "node", "validator", "invalid_key", "validation_error")


@dataclass(frozen=True)
class GatePolicy:
    """Gate policy as data. Recorded beside the results every run."""
    ignored_errors: Sequence[str] = DEFAULT_IGNORED_ERRORS
    extra_ignored: Sequence[str] = ()
    exempt_nodes: Sequence[str] = ()
    errors_only: bool = False
    synthetic_pattern: str = SYNTHETIC_STUDY_PATTERN

    @property
    def patterns(self) -> tuple[str, ...]:
        return tuple(self.ignored_errors) + tuple(self.extra_ignored)

    def as_frame(self, spark: SparkSession, validation_id: str | None = None) -> DataFrame:
        rows = [(validation_id, "ignored_error", p) for p in self.patterns]
        rows += [(validation_id, "exempt_node", n) for n in self.exempt_nodes]
        rows += [(validation_id, "errors_only", str(self.errors_only).lower()),
                 (validation_id, "synthetic_pattern", self.synthetic_pattern)]
        return spark.createDataFrame(rows, "validation_id string, setting string, value string")


def keep_greatest(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` equals its maximum (A4, ``= (SELECT max(...))``).

    The maximum is one value and is looked up first; as a literal it is pushed
    into the scan, which on a table partitioned by ``column`` reads one
    partition. The lookup itself is an aggregate over all of them: for a stored
    table ``sources.snapshots.read_greatest`` takes it from folder names."""
    top = df.agg(F.max(column).alias("m")).first()["m"]
    return df.filter(F.col(column) == F.lit(top)) if top is not None else df.filter(F.lit(False))


def latest_run(results: DataFrame) -> DataFrame:
    """A4: rows of the greatest ``validation_id``."""
    return keep_greatest(results, "validation_id")


def _like_any(c: Column, patterns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for p in patterns:
        cond = cond | c.like(p)
    return cond


def _real(policy: GatePolicy) -> Column:
    """F8 row predicate: not PASS, error not matching an ignored pattern,
    study not synthetic, node not exempt. ``coalesce`` keeps null errors and
    null studies in play (three-valued logic would drop them)."""
    cond = (F.col("validation_result") != "PASS") \
        & ~_like_any(F.coalesce(F.col("validation_error"), F.lit("")), policy.patterns) \
        & ~F.coalesce(F.col("study_id"), F.lit("")).like(policy.synthetic_pattern)
    if policy.exempt_nodes:
        cond = cond & ~F.coalesce(F.col("node"), F.lit("")).isin(*policy.exempt_nodes)
    if policy.errors_only:
        cond = cond & (F.col("validation_result") == "ERROR")
    return cond


def real_failures(results: DataFrame, policy: GatePolicy = GatePolicy()) -> DataFrame:
    """F8: the latest run's rows that count against the gate."""
    return latest_run(results).filter(_real(policy))


def gate_signatures(results: DataFrame, policy: GatePolicy = GatePolicy()) -> DataFrame:
    """A2: distinct failure signatures of the latest run with their counts;
    empty = pass. The run is picked before anything is aggregated, so past
    runs are not read; map-side combine shrinks a hot study."""
    return real_failures(results, policy).groupBy(*SIGNATURE_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def error_summary(results: DataFrame) -> DataFrame:
    """Count by node and error for the latest run, non-null errors,
    most frequent first."""
    return (latest_run(results).filter(F.col("validation_error").isNotNull())
            .groupBy("node", "validation_error").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "node", "validation_error"))


def latest_validation_per_study(artifacts: DataFrame) -> DataFrame:
    """The latest ``validation_id`` per study."""
    return artifacts.groupBy("study_id").agg(F.max("validation_id").alias("validation_id"))


def run_studies(artifacts: DataFrame, validation_id: str) -> DataFrame:
    """The studies a dump run wrote, so the validator checks exactly
    those (join key: study and validation id)."""
    return artifacts.filter(F.col("validation_id") == validation_id).select("study_id").distinct()


def gate_message(signatures: DataFrame) -> DataFrame:
    """A3: one row: number of signatures and the sorted studies involved
    (studies are few; the set is bounded by the study count)."""
    return signatures.agg(F.count(F.lit(1)).alias("n_signatures"),
                          F.array_join(F.sort_array(F.collect_set("study_id")), ",").alias("studies"))
