"""Session construction and the settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings that shape the plans: adaptive execution re-plans joins from
# measured sizes (broadcast only what it measured as small, split skewed
# partitions), and aggregates always shuffle on all their keys so that a
# hot join key never becomes a hot aggregate partition.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_plan_settings(spark: SparkSession) -> SparkSession:
    """Set the plan-shaping SQL settings on an existing session."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "siftkit", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; cluster deployments pass their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SIFTKIT_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**PLAN_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Uses ``spark.checkpoint.dir`` (or a directory already set on the
    context). When neither is set, a local master (as in tests) gets a scratch
    folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="siftkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``siftkit`` importable in Python workers (as ``--py-files`` would).

    The pandas UDF and the enrichment predictor are pickled by module
    reference, so executors must be able to import the package. The source
    is zipped once per application and distributed by Spark.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="siftkit-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
