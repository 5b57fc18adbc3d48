"""Replacing written tables: all or nothing, and readable meanwhile."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carelake.sources import sinks


def rows(spark, n, text="x"):
    return spark.range(n).select("id", F.lit(text).alias("text"))


def path():
    return tempfile.mkdtemp(prefix="carelake-saved-", dir="/tmp") + "/t"


def test_table_replaced_from_itself(spark):
    p = path()
    sinks.save_overwrite(rows(spark, 10), p)
    sinks.save_overwrite(sinks.read_saved(spark, p).where("id >= 4").withColumn("text", F.lit("y")), p)
    assert sorted(map(tuple, sinks.read_saved(spark, p).collect())) == [(i, "y") for i in range(4, 10)]


def test_failed_write_changes_nothing(spark):
    p = path()
    sinks.save_overwrite(rows(spark, 10), p)
    before = sorted(os.listdir(p))
    with pytest.raises(Exception, match="boom"):
        sinks.save_overwrite(rows(spark, 10).withColumn("text", F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise("z")), p)
    assert sorted(os.listdir(p)) == before
    assert {r.text for r in sinks.read_saved(spark, p).collect()} == {"x"}


def test_reader_that_began_before_still_ends(spark):
    p = path()
    old = sinks.save_overwrite(rows(spark, 10), p)
    new = sinks.save_overwrite(rows(spark, 3, "new"), p)
    assert old.count() == 10 and new.count() == 3 and sinks.read_saved(spark, p).count() == 3


def test_old_versions_go_and_others_stay(spark):
    import time
    p = path()
    for n in range(4):
        sinks.save_overwrite(rows(spark, n + 1), p)
        time.sleep(0.05)
    os.mkdir(f"{p}/v-another-write-under-way")
    sinks.save_overwrite(rows(spark, 9), p)
    folders = [x for x in os.listdir(p) if x.startswith("v-")]
    assert sinks.read_saved(spark, p).count() == 9 and len(folders) <= 3
    assert os.path.basename(sinks.current_version(spark, p)) in folders


def test_partitions_and_empty_tables(spark):
    p = path()
    sinks.save_overwrite(rows(spark, 6).withColumn("k", F.col("id") % 3), p, ["k"])
    assert sinks.read_saved(spark, p).where("k = 1").count() == 2
    sinks.save_overwrite(rows(spark, 0), p)
    assert sinks.read_saved(spark, p).count() == 0 and sinks.read_saved(spark, p).columns == ["id", "text"]
    with pytest.raises(FileNotFoundError):
        sinks.read_saved(spark, p + "-none")


def test_catalog_table_replaced_from_itself_and_with_another_schema(spark):
    from uuid import uuid4
    ns = sinks.create_namespace(spark, f"ns_{uuid4().hex[:8]}")
    name = f"{ns}.t"
    sinks.save_table(rows(spark, 5), name)
    sinks.save_table(spark.table(name).where("id > 1"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3, 4]
    with pytest.raises(Exception, match="boom"):
        sinks.save_table(spark.table(name).withColumn("text", F.raise_error(F.lit("boom")).cast("string")), name)
    assert spark.table(name).count() == 3
    sinks.save_table(spark.table(name).select("id", F.lit(1.5).alias("amount")), name)
    assert [tuple(r) for r in spark.table(name).orderBy("id").collect()] == [(2, 1.5), (3, 1.5), (4, 1.5)]
