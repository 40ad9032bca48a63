"""Tables that are replaced as a whole without a moment in which they are not whole.

A table's folder holds one folder per version and a pointer file. A version is complete before the
pointer that names it is written beside the old one and renamed over it, the last and only visible
step. A writer that dies before leaves the old version in place, and its own folder to the next
writer to clear away. One writer at a time; readers keep the version they started with, because the
version before the current one stays. Object stores need a file system client whose renames of
single files replace in one step.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
KEPT_VERSIONS = 1


class Folder:
    """Operations on one folder of the file system that holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._gateway, self._hadoop = spark.sparkContext._gateway, spark._jvm.org.apache.hadoop.fs
        configuration = spark._jsc.hadoopConfiguration()
        place = self._path("")
        self._system = place.getFileSystem(configuration)
        self._context = self._hadoop.FileContext.getFileContext(
            self._system.makeQualified(place).toUri(), configuration)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of what the folder holds; none if it does not exist."""
        if not self._system.exists(self._path("")):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self._path(""))]

    def read(self, name: str) -> str | None:
        """A small text file's content, None where there is none."""
        if not self._system.exists(self._path(name)):
            return None
        stream = self._system.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A small text file, in place of one of that name in a single step."""
        draft = f"_{uuid.uuid4().hex}"
        stream = self._system.create(self._path(draft))
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self._rename(draft, name, overwrite=True)

    def move(self, name: str, new: str) -> bool:
        """Give a folder a new name; False if the name is taken."""
        try:
            self._rename(name, new, overwrite=False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _rename(self, name: str, new: str, overwrite: bool) -> None:
        kind = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE if overwrite else kind.NONE
        self._context.rename(self._path(name), self._path(new), options)

    def remove(self, name: str) -> None:
        self._system.delete(self._path(name), True)


def _number(version: str) -> int:
    return int(version.split("-")[1])


def versions(folder: Folder) -> list[str]:
    """Versions the pointer names, the current one first."""
    return (folder.read(POINTER) or "").split()


def current(spark: SparkSession, target: str) -> str | None:
    """Path of a table's current version; None if no version was ever completed."""
    found = versions(Folder(spark, target))
    return f"{target.rstrip('/')}/{found[0]}" if found else None


def add(df: DataFrame, target: str) -> str:
    """Write the next version; nothing reads it until `point` names it."""
    found = versions(Folder(df.sparkSession, target))
    number = _number(found[0]) + 1 if found else 1
    version = f"version-{number}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{target.rstrip('/')}/{version}")
    return version


def point(spark: SparkSession, target: str, version: str) -> None:
    """Make a complete version the current one and clear away what is older or was left behind."""
    folder = Folder(spark, target)
    named = [version, *versions(folder)][:KEPT_VERSIONS + 1]
    folder.write(POINTER, "\n".join(named))
    for name in folder.names():
        if name.startswith("version-") and name not in named:
            folder.remove(name)


def replace(df: DataFrame, target: str) -> None:
    """Write the rows as the table's new content."""
    point(df.sparkSession, target, add(df, target))


def read(spark: SparkSession, target: str) -> DataFrame:
    """The current version; a folder without a pointer is read as a plain table."""
    return spark.read.parquet(current(spark, target) or target)


def replace_catalog(df: DataFrame, name: str) -> None:
    """Write the rows as a catalog table's new content: its location moves once they are complete.

    A table with other columns is defined anew, which takes two catalog steps.
    """
    spark = df.sparkSession
    target = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"
    version = add(df, target)
    location = f"{target}/{version}"
    written = spark.read.parquet(location)
    if spark.catalog.tableExists(name) and spark.table(name).schema == written.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, location, "parquet")
    spark.catalog.refreshTable(name)
    point(spark, target, version)


def write_once(df: DataFrame, target: str, name: str) -> bool:
    """Write a folder of that name whole, or leave the one that is there; says which."""
    folder = Folder(df.sparkSession, target)
    draft = f"_arriving-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{folder.path}/{draft}")
    if folder.move(draft, name):
        return True
    folder.remove(draft)
    return False
