"""Output tables of a run under one shared root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.operators import quality
from ratesmith.sources import sinks


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return sinks.exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return sinks.read(self.spark, self.path(name))

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table in place of its last version and go on from the written rows."""
        sinks.overwrite(df, self.path(name))
        return self.read(name)

    def archive(self, name: str, batch: DataFrame) -> bool:
        """Add a batch that is newer than what an archive holds, which the first batch starts."""
        return sinks.archive(batch, self.path(name))

    def archived(self, name: str) -> DataFrame:
        return sinks.read_archive(self.spark, self.path(name))

    def publish(self, name: str, batch: DataFrame) -> DataFrame:
        """Replace the batch's keys in a published table, which the first batch starts."""
        if self.has(name):
            sinks.update_published(batch, self.path(name))
        else:
            sinks.start_published(batch, self.path(name))
        return self.published(name)

    def sketch(self, name: str, batch: DataFrame) -> DataFrame:
        """Refresh the organisation sketches of the batch's months after its publication.

        Only these months' folders of the published table are read, never its history.
        """
        months = batch.select(F.col(sinks.DATE_COLUMN).alias("month")).distinct()
        published = self.published(name)
        touched = published.join(
            months, published[sinks.DATE_COLUMN].eqNullSafe(months["month"]), "left_semi")
        fresh, target = quality.organisation_sketches(touched), f"sketches_{name}"
        if not self.has(target):
            fresh = quality.organisation_sketches(published)
            return self.stage(target, fresh)
        return self.stage(target, quality.replace_sketches(self.read(target), fresh))

    def published(self, name: str) -> DataFrame:
        return sinks.read_published(self.spark, self.path(name))
