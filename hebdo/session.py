"""Session helpers.

Nothing here creates global state on import. ``build_session`` is what tests
and the bench use; library functions always take the session or a DataFrame
as an argument.
"""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "hebdo",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings this library expects.

    ``shuffle_partitions`` is 8 on a local master; on a cluster its own setting stays unless a number is given.
    """
    master = master or os.environ.get("HEBDO_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # weekly series are hash-partitioned by series key for their windows; let
         # joins on (series key, week) reuse that partitioning instead of re-shuffling
         # both sides (only weekly-grain tables are joined on such keys; raw-level
         # joins are broadcasts of size-checked dimensions)
         .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("HEBDO_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the cluster names it.

    Order: the directory already set on the context (Spark sets it from
    ``spark.checkpoint.dir`` at start-up), then ``spark.checkpoint.dir`` from
    the session or context configuration. Only when none is set on a local
    master (tests) is a scratch folder created and registered; on a cluster
    a machine-local folder would not survive executor loss, so an unset
    directory is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                               "(HDFS/S3/ABFS) readable by every executor")
        d = tempfile.mkdtemp(prefix="hebdo-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hebdo`` importable on every Python worker (once per context).

    Grouped-map / map-in-pandas functions are pickled by reference to this
    package, so executors need its code: it is zipped and distributed with
    ``addPyFile`` (Spark copies it to every executor), whatever directory
    the driver runs from.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="hebdo-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)  # the driver's file server reads it when an executor starts, so it stays until the driver ends
    atexit.register(lambda: os.path.exists(path) and os.remove(path))
    _SHIPPED.add(key)
