"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "plumbline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


#: Bytecode of one method up to which the JVM compiles it to machine code.
COMPILED_BYTECODE = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Have steps over wide rows run as compiled code.

    Spark joins the expressions of a stage into one method. The JVM only interprets a method of more than
    ``COMPILED_BYTECODE`` bytes, which a table of some thirty columns exceeds; from there on Spark is to call
    the expressions one by one. Results do not depend on it; a lower limit of the session stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > COMPILED_BYTECODE:
        spark.conf.set(limit, str(COMPILED_BYTECODE))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own, removed at its end.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)
    return shared


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` over all shuffle partitions.

    For stages that compute much per byte: adaptive execution would otherwise
    merge small inputs into few tasks. A grouping by the same keys reuses it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back.

    Used where a result feeds several later stages or a loop: the lineage is
    cut on shared storage, so a lost executor does not restart the work.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def collected(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of results that nothing refers to any more, instead of when the driver's heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
