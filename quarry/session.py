"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "quarry", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    Under ``spark-submit`` (a master already configured by the launch) only
    settings the launch left unset are filled in — shuffle partitions,
    memory and file-split sizes stay whatever the cluster chose.  Local runs
    (tests, bench) get small-machine defaults.
    """
    from pyspark import SparkConf

    launched = SparkConf()  # spark-submit / spark-defaults settings, if any
    cluster = master is None and launched.contains("spark.master") and not launched.get("spark.master", "").startswith("local")
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if not cluster:
        cpus = os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(master or f"local[{cpus}]")
        defaults.update({
            "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus) * 2),
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "16g"),
        })
    else:
        # sizes for ~100 TB inputs, used only when the launch did not choose
        defaults.update({
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
            "spark.sql.files.maxPartitionBytes": "256m",
        })
        if shuffle_partitions:
            defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in defaults.items():
        if cluster and launched.contains(k):
            continue  # the launch decided
        builder = builder.config(k, v)
    event_dir = os.environ.get("QUARRY_EVENT_LOG_DIR")
    if event_dir:  # stage / task timings without the UI: Spark's event log in a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (HDFS / object store) and is
    only read here.  When it is unset (local tests) a private folder is
    created and registered, so that lineage cuts still have a target.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return spark.conf.get("spark.checkpoint.dir", None) or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quarry-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark.sparkContext, path))
    return path


_SCRATCH: list = []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system it is; False if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this session has handed out.  Results
    that still read them must have been written or collected before; runs at
    exit for sessions that are still up."""
    mine = [p for sc, p in _SCRATCH if sc is spark.sparkContext]
    _SCRATCH[:] = [x for x in _SCRATCH if x[0] is not spark.sparkContext]
    return sum(delete_path(spark, p) for p in mine)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone by now
            clear_scratch(spark)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers (``addPyFile`` of a
    zip of the package, once per context) — needed by Python UDFs whose
    closures refer to library code.  Where the package is installed on every
    node this is harmless."""
    import shutil

    import quarry
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(quarry.__file__))
    # The zip is a code artifact made from the driver's own copy of the
    # package; addPyFile ships it to every executor, so no data lives here.
    out = tempfile.mkdtemp(prefix="quarry-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "quarry"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="quarry")
    sc.addPyFile(archive)
    _SHIPPED.add(id(sc))
