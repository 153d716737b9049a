"""Session construction and run-level settings.

Everything here is configuration, not execution: the library's work is
expressed as DataFrame plans and Catalyst/AQE decide the physical strategy.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. On a cluster these are applied only when the
# cluster has not set them already (see ``ensure_defaults``).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partition values such as validation ids and snapshot ids are text;
    # inference would turn "0042" into 42.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans here are built from many Column expressions (compiled rules);
    # call-site capture costs several JVM round trips per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you
    and call ``ensure_defaults`` on it instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    driver_mem = os.environ.get("STRATA_DRIVER_MEMORY")
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


_SHIPPED: set[str] = set()


def _refresh_debugging_flag() -> None:
    """PySpark caches the call-site-capture switch per process on first
    use; drop the cache so the session's current value applies."""
    try:
        import pyspark.errors.utils as eu
        eu._enable_debugging_cache = None
    except Exception:  # noqa: BLE001 - an older/newer layout: nothing to refresh
        pass


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in Python workers (pandas stages unpickle
    functions from it) in local mode, where workers share the driver's
    machine: zip the package once per context and ``addPyFile`` it. On a
    cluster the package is installed on the executors or passed with
    ``--py-files``; nothing is written to a machine-local folder there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not spark.sparkContext.master.startswith("local"):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="strata-pyfiles-"), "strata.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply library defaults where the session has no value, make sure a
    checkpoint directory exists, and ship the package to Python workers."""
    for key, value in DEFAULT_CONF.items():
        try:
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        except Exception:  # static conf on a running session: leave it
            pass
    _refresh_debugging_flag()
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A folder set on the context wins; else ``spark.checkpoint.dir``, which a
    cluster names. Only a local master without either (tests) gets a scratch
    folder of its own; on a cluster that would be a folder executors cannot
    see, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared scratch space and read from
    there: what is used several times is made once, and an executor's loss
    costs no recomputation before it."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str, *partition_by: str) -> tuple[DataFrame, str]:
    """``written``, and the folder, for ``remove_path`` after the last use."""
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared scratch space."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
