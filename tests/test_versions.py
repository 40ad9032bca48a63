"""Whole-table replacement and archives when writers die."""

import os
import signal
import subprocess
import sys
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratesmith.sources import sinks, versions

REPO = str(Path(__file__).resolve().parent.parent)
SLOW_WRITER = """
import sys, time
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from ratesmith.sources import sinks
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", {target!r} + "-warehouse").getOrCreate())

def slow(batches):
    for batch in batches:
        yield batch
        time.sleep(600)

sinks.overwrite(spark.range(0, 100, 1, 2).mapInArrow(slow, "id long"), {target!r})
"""


def numbers(spark, target):
    return sorted(row.id for row in sinks.read(spark, target).collect())


def test_a_killed_writer_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "table")
    sinks.overwrite(spark.range(3), target)
    process = subprocess.Popen([sys.executable, "-c", SLOW_WRITER.format(repo=REPO, target=target)],
                               stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        begun = time.time()
        while not [p for p in Path(target).rglob("*.parquet") if "version-2" in str(p)]:
            assert process.poll() is None and time.time() - begun < 90
            time.sleep(0.2)
    finally:
        os.killpg(process.pid, signal.SIGKILL)
        process.wait()
    assert numbers(spark, target) == [0, 1, 2]
    left = [name for name in os.listdir(target) if name.startswith("version-2")]
    assert len(left) == 1
    sinks.overwrite(spark.range(5), target)
    assert numbers(spark, target) == [0, 1, 2, 3, 4]
    assert not set(left) & set(os.listdir(target))


def test_a_version_counts_when_it_is_named(spark, tmp_path):
    target = str(tmp_path / "table")
    sinks.overwrite(spark.range(2), target)
    before = sinks.read(spark, target)
    version = versions.add(spark.range(9), target)
    assert numbers(spark, target) == [0, 1]
    versions.point(spark, target, version)
    assert numbers(spark, target) == list(range(9))
    assert before.count() == 2  # a reader keeps the version it started with
    assert versions.current(spark, target).endswith(version)


def test_a_failing_write_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "table")
    sinks.overwrite(spark.range(2), target)
    failing = spark.range(0, 10, 1, 4).select(
        F.when(F.col("id") > 8, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        sinks.overwrite(failing, target)
    assert numbers(spark, target) == [0, 1] and sinks.exists(spark, target)


def test_replacing_a_table_by_itself(spark, tmp_path):
    target = str(tmp_path / "table")
    sinks.overwrite(spark.range(4), target)
    sinks.overwrite(sinks.read(spark, target).where("id > 1"), target)
    assert numbers(spark, target) == [2, 3]


def test_catalog_tables_move_to_their_new_rows(spark):
    name = "replaced_table"
    try:
        sinks.overwrite(spark.range(3), name)
        sinks.overwrite(spark.range(5), name)
        assert sinks.read(spark, name).count() == 5
        sinks.overwrite(spark.range(2).withColumn("more", F.lit("x")), name)
        assert sinks.read(spark, name).columns == ["id", "more"] and sinks.read(spark, name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch(spark, n, at):
    return spark.range(n).withColumn("CREATED_AT", F.lit(at).cast("timestamp"))


def test_archive_decides_by_names(spark, tmp_path):
    target = str(tmp_path / "archive")
    first, second = datetime(2001, 1, 5, 9, 30), datetime(2001, 1, 5, 9, 30, 0, 1)
    assert sinks.archive(batch(spark, 3, first), target)
    # a broken file would fail any read of the archive
    for path in Path(target).rglob("*.parquet"):
        path.write_bytes(b"no table")
    for path in Path(target).rglob(".*.crc"):
        path.unlink()
    assert not sinks.archive(batch(spark, 3, first), target)
    assert sinks.archive(batch(spark, 4, second), target)
    assert not sinks.archive(batch(spark, 5, first), target)
    assert len(sinks.archived(spark, target)) == 2


def test_archive_batches_do_not_double(spark, tmp_path):
    target = str(tmp_path / "archive")
    at = datetime(2001, 1, 5)
    assert not sinks.archive(batch(spark, 0, at), target)
    assert sinks.archive(batch(spark, 3, at), target)
    # a second writer that decided before the first one's rename
    name = sinks.archived(spark, target)[0]
    assert not versions.write_once(batch(spark, 3, at), target, f"{sinks.BATCH}={name}")
    found = sinks.read_archive(spark, target)
    assert found.count() == 3 and found.columns == ["id", "CREATED_AT"]
    # a writer that died while writing leaves nothing that is read
    batch(spark, 7, at).write.parquet(f"{target}/_arriving-1")
    assert sinks.read_archive(spark, target).count() == 3
    assert sinks.archive(batch(spark, 2, datetime(1969, 12, 31)), target) is False
