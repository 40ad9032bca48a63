"""Writers of result tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratesmith.operators.publish import PUBLICATION_COLUMNS, replace_by_key
from ratesmith.sources import versions

DATE_COLUMN = "ACHIEVEMENT_DATE"
BATCH = "BATCH"


def overwrite(df: DataFrame, target: str) -> None:
    """Replace a whole table, given by path or by catalog name.

    The old rows are there until the new ones are complete; `read` finds the current ones by path.
    """
    if "/" in target:
        versions.replace(df, target)
    else:
        versions.replace_catalog(df, target)


def read(spark: SparkSession, target: str) -> DataFrame:
    """A table that `overwrite` or Spark itself wrote, by path or by catalog name."""
    return versions.read(spark, target) if "/" in target else spark.table(target)


def insert(df: DataFrame, table: str, replace: bool = True) -> None:
    """Insert into an existing catalog table, in place of its rows or after them.

    The table's own column order is used, so that columns cannot be swapped by position.
    """
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=replace)


def _by_folder(df: DataFrame, column: str) -> DataFrame:
    """Rows brought together by folder, so that tasks do not each write a file to every folder.

    Adaptive execution splits the folders that hold too much for one task.
    """
    return df.hint("rebalance", column)


def start_published(df: DataFrame, target: str) -> None:
    """First write of a published table, one folder per achievement date."""
    rows = _by_folder(df, DATE_COLUMN)
    rows.write.mode("error").partitionBy(DATE_COLUMN).parquet(target)


def read_published(spark: SparkSession, target: str) -> DataFrame:
    table = spark.read.parquet(target)
    return table.withColumn(DATE_COLUMN, F.col(DATE_COLUMN).cast("date"))


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a path holds a table already. A table that cannot be read is an error."""
    if versions.current(spark, target):
        return True
    try:
        spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def update_published(batch: DataFrame, target: str) -> None:
    """Replace the batch's keys in a published table.

    Only the folders of the batch's dates, NULL among them, are read and rewritten, whatever the
    table's history; the new folders are complete before they replace the old ones. The batch is
    read several times, so it should be a written table. An empty batch changes nothing.
    """
    existing = read_published(batch.sparkSession, target)
    first, last, nulls = batch.agg(
        F.min(DATE_COLUMN), F.max(DATE_COLUMN), F.count_if(F.col(DATE_COLUMN).isNull())).first()
    if first is None and not nulls:
        return
    in_range = F.col(DATE_COLUMN).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    if nulls:
        in_range = F.coalesce(in_range, F.lit(False)) | F.col(DATE_COLUMN).isNull()
    candidates, dates = existing.where(in_range), batch.select(F.col(DATE_COLUMN).alias("batch_date")).distinct()
    touched = candidates.join(
        dates, candidates[DATE_COLUMN].eqNullSafe(dates["batch_date"]), "left_semi")
    columns = [name for name in existing.columns if name != DATE_COLUMN] + [DATE_COLUMN]
    updated = replace_by_key(touched, batch).select(*columns)
    (
        _by_folder(updated, DATE_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_COLUMN)
        .parquet(target)
    )


def archive(batch: DataFrame, target: str) -> bool:
    """Add the batch if it is newer than everything archived; says whether it was added.

    An archive has one folder per batch, named by its stamp. The names of the folders decide, so no
    file of the archive is read; a batch becomes visible whole, in one rename, and a name is taken
    once, so a batch that is offered again, by a writer that died or by another one, does not
    double. An empty batch is not archived. The first batch starts the archive.
    """
    arriving = batch.agg(F.unix_micros(F.max("CREATED_AT"))).first()[0]
    if arriving is None:
        return False
    name = batch_name(arriving)
    if any(stamp >= name for stamp in archived(batch.sparkSession, target)):
        return False
    return versions.write_once(batch, target, f"{BATCH}={name}")


def batch_name(micros: int) -> str:
    """A stamp in UTC as text that sorts as the stamps do."""
    return (datetime(1970, 1, 1) + timedelta(microseconds=micros)).strftime("%Y%m%dT%H%M%S%f")


def archived(spark: SparkSession, target: str) -> list[str]:
    """Names of an archive's batches in the order of their stamps."""
    names = versions.Folder(spark, target).names()
    return sorted(name.removeprefix(f"{BATCH}=") for name in names if name.startswith(f"{BATCH}="))


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(BATCH)


def replace_publication(batch: DataFrame, target: str) -> None:
    """Replace the whole publication table; it carries no batch stamp."""
    overwrite(batch.select(*PUBLICATION_COLUMNS), target)


def route(landing: DataFrame, target: str, column: str = "DATA_REFERENCE_IDENTIFIER") -> None:
    """Write each indicator to its own folder in one pass over the landing rows."""
    rows = _by_folder(landing, column)
    rows.write.mode("overwrite").partitionBy(column).parquet(target)


def read_routed(
    spark: SparkSession, target: str, indicator: str, column: str = "DATA_REFERENCE_IDENTIFIER"
) -> DataFrame:
    """One indicator's rows; the other indicators' folders are not read.

    The folder column is text: without a type, numbers in folder names would lose their zeros.
    """
    found = spark.read.parquet(target).schema
    fields = [StructField(f.name, StringType()) if f.name == column else f for f in found.fields]
    return spark.read.schema(StructType(fields)).parquet(target).where(F.col(column) == indicator)

