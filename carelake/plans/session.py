"""Session settings.

The settings below are the ones the queries rely on.  On a cluster the
caller's session is used as is; ``configure`` only fills in what is unset.
"""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the queries are designed for (Spark 4 defaults, set explicitly in
# sessions built here).  AQE re-plans joins with
# measured sizes (broadcast only below the threshold, sort-merge beyond it),
# splits skewed join partitions and coalesces small shuffle partitions.
REQUIRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Local defaults for sessions built here (tests, bench).  The queries do not
# depend on the session time zone (source timestamps are TIMESTAMP_NTZ and
# only dates are derived), so a caller's session keeps its own.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "carelake",
                  extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in {**LOCAL_DEFAULTS, **REQUIRED, **(extra or {})}.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in {**REQUIRED, **(extra or {})}.items():  # a reused session may carry other values
        try:
            spark.conf.set(k, v)
        except Exception:  # static settings apply only at session start
            pass
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Prepare a caller's session for the queries without overriding it.

    Only the checkpoint folder is looked up (and chosen when the session has
    none).  AQE, partition coalescing and skew-join handling are Spark 4
    defaults; sessions built by ``build_session`` set them explicitly, a
    cluster's own choices are left as they are."""
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    A cluster names it in ``spark.checkpoint.dir``; unset is an error there.
    Only a ``local`` master (tests) gets a scratch folder of our own, set on the
    SparkContext (the setting itself cannot change at run time)."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        master = sc.master if sc else ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = _LOCAL_CKPT.get(id(spark))
        if d is None:
            d = _LOCAL_CKPT[id(spark)] = tempfile.mkdtemp(prefix="carelake-ckpt-", dir="/tmp")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_LOCAL_CKPT: dict = {}


def recommended_settings(input_bytes: float, executors: int, cores_per_executor: int,
                         executor_memory_gb: float = 32.0, shuffle_fraction: float = 0.3) -> dict[str, str]:
    """Settings sized for a cluster and an input volume.

    * ``maxPartitionBytes``: 256 MB splits (fewer, larger scan tasks; parquet
      splits at row-group boundaries).
    * ``shuffle.partitions``: the larger of 3 x total cores and the expected
      shuffle volume / 200 MB, so one reduce task's data fits comfortably in
      its share of executor memory; AQE coalesces small ones at run time.
    * AQE advisory size 256 MB; skew split when a partition is 5x the median
      and over 512 MB.
    * Broadcast only below 64 MB (measured), never by row-count guess.
    """
    cores = executors * cores_per_executor
    shuffle_bytes = input_bytes * shuffle_fraction
    parts = max(3 * cores, int(shuffle_bytes / (200 * 1024 ** 2)))
    per_task_gb = executor_memory_gb / cores_per_executor
    if per_task_gb < 1:
        parts *= 2
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.speculation": "true",
    }


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> str | None:
    """Make ``carelake`` importable on executors (needed where Python runs on
    executors: the judge's ``mapInPandas``).  Done once per session.

    Classic session: the package's ``.py`` files are zipped into the shared
    checkpoint folder (file name carries a content hash, written through
    Spark's Hadoop client when that folder is a cluster file system) and
    added with ``addPyFile``.  Spark Connect session: the zip is written on
    the client and uploaded with ``addArtifacts``."""
    import hashlib
    import io
    import os
    import zipfile

    try:
        sc = spark.sparkContext
        token = ("sc", id(sc), sc.applicationId)
    except Exception:
        sc, token = None, ("connect", id(spark))
    if token in _SHIPPED:
        return None
    pkg_dir = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    name = f"carelake-{hashlib.sha1(data).hexdigest()[:12]}.zip"

    def write_local(path: str) -> None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if not os.path.exists(path):
            with open(path, "wb") as fh:
                fh.write(data)

    if sc is None:  # Spark Connect: the client uploads the file
        path = os.path.join(tempfile.mkdtemp(prefix="carelake-pkg-"), name)
        write_local(path)
        spark.addArtifacts(path, pyfile=True)
    else:
        target = ensure_checkpoint_dir(spark).rstrip("/") + "/carelake_pkg"
        path = f"{target}/{name}"
        if target.startswith("/") or target.startswith("file:"):
            write_local(path[len("file:"):] if path.startswith("file:") else path)
        else:  # a cluster file system: write through Spark's Hadoop client
            jvm = spark._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
            if not fs.exists(hpath):
                out = fs.create(hpath)
                out.write(bytearray(data))
                out.close()
        sc.addPyFile(path)
    _SHIPPED.add(token)
    return path
