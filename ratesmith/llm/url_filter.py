"""URL filters by a temporal list join.

Dated list entries (key, action, change, day) become validity intervals: an `add` holds from its
day to the next dated row of the same key and action, a `remove` ends it. Keys are a host, a parent
domain or a host with its first path segment. A capture is judged by the entries active on its
fetch day: the longest key decides, then `allow` over `block`; without one it is kept. Each
distinct key and day meets the intervals once, so a domain that a third of all captures share is a
few rows there; the verdicts then go back by key and day.

NULL or malformed URLs have no host, match nothing and are kept; a NULL fetch day matches nothing.
Of dated rows of one day, `add` comes last. Repeated rows are separate captures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratesmith.llm.common import ROW, numbered
from ratesmith.sources.workspace import staged


RESULT = ("host", "matched_key", "action", "kept")


def intervals(entries: DataFrame) -> DataFrame:
    """Entry rows (key, action, change, day) as key, action, first and end (exclusive, NULL open).

    A key has as many dated rows as the list was changed for it.
    """
    rows = entries.where("key IS NOT NULL AND day IS NOT NULL").select(
        "key", "action", "change", "day").distinct()
    later = Window.partitionBy("key", "action").orderBy(
        "day", F.when(F.col("change") == "remove", 0).otherwise(1))
    return (
        rows.withColumn("end", F.lead("day").over(later))
        .where("change = 'add' AND (end IS NULL OR end > day)")
        .select("key", "action", F.col("day").alias("first"), "end")
    )


def with_keys(captures: DataFrame) -> DataFrame:
    """Captures (url, fetch_day) with their host and every key that could list them."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    segment = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    labels = F.split("host", "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.when(F.col("segment") != "", F.array(F.concat_ws("/", "host", "segment"))).otherwise(
        F.array().cast("array<string>"))
    return (
        captures.withColumn("host", F.nullif(host, F.lit(""))).withColumn("segment", segment)
        .withColumn("keys", F.when(F.col("host").isNotNull(), F.concat(path, domains)))
        .drop("segment")
    )


def active_entries(points: DataFrame, entries: DataFrame) -> DataFrame:
    """For distinct (key, fetch_day): the action that holds, allow before block."""
    spans = intervals(entries)
    active = (spans["first"] <= points["fetch_day"]) & (
        spans["end"].isNull() | (spans["end"] > points["fetch_day"]))
    return (
        points.join(spans, (points["key"] == spans["key"]) & active)
        .groupBy(points["key"], "fetch_day").agg(F.min("action").alias("action"))
    )


def judge(captures: DataFrame, entries: DataFrame, *columns: str) -> DataFrame:
    """Captures (url, fetch_day and `columns`) with host, matched key, action and kept.

    A given column with the name of one of these four is returned as `given_` and that name.
    """
    given = [F.col(name).alias(f"column_{i}") for i, name in enumerate(columns)]
    rows = staged(with_keys(numbered(captures.select("url", "fetch_day", *given))), "captures")
    names = [f"given_{name}" if name in RESULT else name for name in columns]
    wanted = rows.select(ROW, "fetch_day", F.explode("keys").alias("key"))
    points = wanted.select("key", "fetch_day").distinct()
    verdicts = active_entries(points, entries)
    best = wanted.join(verdicts, ["key", "fetch_day"]).groupBy(ROW).agg(
        F.max_by(F.struct("key", "action"), F.length("key")).alias("best"))
    return rows.join(best, ROW, "left").select(
        *(F.col(f"column_{i}").alias(name) for i, name in enumerate(names)), "host", F.col("best.key").alias("matched_key"), F.col("best.action").alias("action"),
        (F.coalesce(F.col("best.action"), F.lit("allow")) != "block").alias("kept"))
