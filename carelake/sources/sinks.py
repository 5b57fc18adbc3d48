"""Writing tables and reporting their sizes.

Tables are written under the shared folder the session names in
``spark.checkpoint.dir`` (see ``plans.session.ensure_checkpoint_dir``), never
under a machine-local temporary folder.
"""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir
from .tables import hadoop_path


def table_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/carelake_tables"


#: Spark's bound on a generated method; HotSpot compiles none over 8,000 bytes.
_METHOD, _COMPILED = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def small_methods(spark: SparkSession):
    """Runs jobs without whole-stage methods that the JVM would interpret."""
    old = spark.conf.get(_METHOD, None)
    if old is None or int(old) > _COMPILED:
        spark.conf.set(_METHOD, str(_COMPILED))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_METHOD)
        else:
            spark.conf.set(_METHOD, old)


POINTER = "_current"


def _folder(spark: SparkSession, path: str):
    found = hadoop_path(spark, path)
    if found is None:
        raise RuntimeError("replacing a written table needs a session with a JVM of its own (no Spark Connect)")
    return found


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that the pointer of the table at ``path`` names; None without one."""
    fs, at = _folder(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        name = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{path}/{name}"


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Name version ``name`` in the pointer: a new file that replaces it by one rename."""
    jvm = spark._jvm
    fs, new = _folder(spark, f"{path}/_next-{name}")
    out = fs.create(new)
    out.write(bytearray(name.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(_folder(spark, f"{path}/{POINTER}")[1]), how)


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` to a new version folder of the table at ``path``, which no
    reader sees yet.  A write that fails leaves nothing behind."""
    from uuid import uuid4
    spark = df.sparkSession
    folder = f"{path}/v-{uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(folder)
    except Exception:
        fs, at = _folder(spark, folder)
        fs.delete(at, True)
        raise
    return folder


def save_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = 1) -> DataFrame:
    """Replace the table at ``path`` and return a DataFrame reading it.

    The rows go to a new version folder, then one rename switches the small
    file that names the current version.  So a reader gets the old rows or the
    new ones, ``df`` may read the table that it replaces, and a write that fails
    changes nothing.  Versions before the last ``keep`` replaced ones are
    deleted, so readers that began before have time to end.

    Writing then re-reading also cuts the lineage: later work restarts from
    the written files, not from the source scan, if an executor is lost."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder = write_version(df, path, partition_by)
    _point(spark, path, folder.rsplit("/", 1)[1])
    _expire(spark, path, keep)
    return spark.read.parquet(folder)


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a table written by ``save_overwrite``."""
    folder = current_version(spark, path.rstrip("/"))
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(folder)


def _expire(spark: SparkSession, path: str, keep: int) -> None:
    """Delete version folders older than the current and the ``keep`` before it.  Folders
    younger than the current one belong to writes under way and stay."""
    current = current_version(spark, path)
    fs, at = _folder(spark, path)
    versions = sorted(((x.getModificationTime(), x.getPath().getName()) for x in fs.listStatus(at)
                       if x.isDirectory() and x.getPath().getName().startswith("v-")), reverse=True)
    since = next((t for t, name in versions if current.endswith(name)), 0)
    older = [name for t, name in versions if t <= since and not current.endswith(name)]
    for name in older[keep:]:
        fs.delete(_folder(spark, f"{path}/{name}")[1], True)


def create_namespace(spark: SparkSession, name: str) -> str:
    """``CREATE SCHEMA IF NOT EXISTS`` with its location in the shared folder.

    Catalogs are configuration in open-source Spark (``CREATE CATALOG`` does
    not parse), so only the schema level is created here."""
    loc = table_root(spark) + f"/{name}.db"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{loc}'")
    return name


def save_table(df: DataFrame, qualified_name: str) -> DataFrame:
    """Replace a catalog table whose files live under the namespace folder.

    Like ``save_overwrite``, with the catalog as the pointer: the rows are
    written to a new version folder, then the external table is set to it.  A
    table with another schema is entered anew; its files are not touched."""
    spark = df.sparkSession
    ns, name = qualified_name.split(".", 1)
    path = table_root(spark) + f"/{ns}.db/{name}"
    folder = write_version(df, path)
    if spark.catalog.tableExists(qualified_name):
        if [(f.name, f.dataType) for f in spark.table(qualified_name).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {qualified_name} SET LOCATION '{folder}'")
            return spark.table(qualified_name)
        spark.sql(f"DROP TABLE {qualified_name}")
    spark.catalog.createTable(qualified_name, path=folder, source="parquet", schema=df.schema)
    return spark.table(qualified_name)


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for several tables in one job: a union of
    one-row global aggregates (each a partial count per task)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
