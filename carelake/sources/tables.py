"""Driver tables (parquet) and the scan operator."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table.  Column pruning and filter pushdown to the
    parquet reader are left to Catalyst: select/filter after this call."""
    return spark.read.parquet(table_path(sf_dir, name))


def scan_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = load(spark, sf_dir, name)
    return df.select(*columns) if columns else df


def hadoop_path(spark: SparkSession, path: str):
    """(file system, Hadoop path); None where the session has no JVM of its own."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder (of part files)."""
    found = hadoop_path(spark, path)
    return bool(found) and found[0].exists(found[1]) and found[0].getFileStatus(found[1]).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    found = hadoop_path(spark, path)
    return bool(found) and found[0].exists(found[1])


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none where it is not there."""
    found = hadoop_path(spark, path)
    if not found or not found[0].exists(found[1]):
        return []
    return sorted(x.getPath().getName() for x in found[0].listStatus(found[1]) if x.isDirectory())


def listing(spark: SparkSession, sf_dir: str, names=("region", "nation", "customer", "supplier", "orders",
                                                     "conversations")) -> tuple | None:
    """What the folder holds now: per table the bytes, the files and the time of
    the last change.  Definitions kept from an earlier listing are not used
    again when it differs.  None (never equal, nothing kept) without a JVM."""
    out = []
    for name in names:
        found = hadoop_path(spark, table_path(sf_dir, name))
        if not found:
            return None
        fs, path = found
        if fs.exists(path):
            total = fs.getContentSummary(path)
            out.append((name, total.getLength(), total.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)
