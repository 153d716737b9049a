"""Extension points.

E2: custom steps are plain functions over DataFrames registered by key;
built-in keys cannot be shadowed and a key cannot be registered twice.
E3: a custom check is a Column predicate plus a message Column; it becomes
finding rows in the results layout like any dictionary rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[..., DataFrame]
BUILTIN_STEPS = frozenset({"ingest", "validate", "gate", "release"})


class StepRegistry:
    def __init__(self) -> None:
        self._steps: dict[str, Step] = {}

    def register(self, key: str, fn: Step) -> Step:
        if key in BUILTIN_STEPS:
            raise ValueError(f"step {key!r} would shadow a built-in step")
        if key in self._steps:
            raise ValueError(f"step {key!r} is already registered")
        self._steps[key] = fn
        return fn

    def step(self, key: str):
        def deco(fn: Step) -> Step:
            return self.register(key, fn)
        return deco

    def run(self, key: str, *frames: DataFrame, **kwargs) -> DataFrame:
        return self._steps[key](*frames, **kwargs)

    def keys(self) -> list[str]:
        return sorted(self._steps)


def custom_check(df: DataFrame, *, node: str, name: str, fails: Column, message: Column, validation_id: str,
                 schema_version: str, invalid_key: str | None = None, key: str = "submitter_id",
                 study: str = "study_id") -> DataFrame:
    """Rows of ``df`` where ``fails`` holds become FAIL findings."""
    return df.filter(fails).select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"),
        F.lit(node).alias("node"), F.col(study).alias("study_id"), F.lit("FAIL").alias("validation_result"),
        F.lit(invalid_key).cast("string").alias("invalid_key"), F.lit(f"{node}/custom/{name}").alias("schema_path"),
        F.lit(name).alias("validator"), F.lit(None).cast("string").alias("validator_value"),
        message.alias("validation_error"), F.lit(schema_version).alias("schema_version"),
        F.col(key).cast("string").alias("submitter_id"))
