"""Organisations, their versions, and the network each practice belongs to on a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith import constants as c
from ratesmith.functions.period import as_date

_SPAN, _HALF = 2**32, 2**31
_OPEN = _SPAN - 1


def valid_on(day: Column, start: str, end: str) -> Column:
    """A version is valid from its start to its end, both included; no end means open."""
    return (F.col(start) <= day) & ((F.col(end) >= day) | F.col(end).isNull())


def _register_valid_on(day: Column) -> Column:
    return valid_on(day, "OPEN_DATE", "CLOSE_DATE") & valid_on(
        day, "DSS_RECORD_START_DATE", "DSS_RECORD_END_DATE"
    )


def active_practices(register: DataFrame, list_size: DataFrame, day: date | str) -> DataFrame:
    """Register rows valid on the date, of practices that reported a population for it.

    A practice with two valid register rows appears twice, as in the register itself.
    """
    when = F.lit(as_date(day))
    reported = list_size.where(F.col("EXTRACT_DATE") == when).select("PRACTICE_CODE").distinct()
    open_rows = register.where(_register_valid_on(when))
    return open_rows.select(F.col("CODE").alias("PRACTICE_CODE")).join(
        reported, "PRACTICE_CODE", "left_semi"
    )


def active_on_dates(register: DataFrame, days: list[date | str]) -> DataFrame:
    """Distinct (practice, date) pairs valid in the register, for a few dates in one pass."""
    dates = F.array(*[F.lit(as_date(day)) for day in days])
    return (
        register.withColumn("EXTRACT_DATE", F.explode(dates))
        .where(_register_valid_on(F.col("EXTRACT_DATE")))
        .select(F.col("CODE").alias("PRACTICE_CODE"), "EXTRACT_DATE")
        .distinct()
    )


def active_only(population: DataFrame, active: DataFrame) -> DataFrame:
    """Population rows of active practices; a practice listed twice does not count twice."""
    keys = [name for name in ("PRACTICE_CODE", "EXTRACT_DATE") if name in active.columns]
    return population.join(active, keys, "left_semi")


def membership_history(
    organisations: DataFrame, roles: DataFrame, codes: DataFrame, relationships: DataFrame
) -> DataFrame:
    """Every practice-to-network relationship of operational organisations."""
    live = organisations.where(F.col("datetype") == c.OPERATIONAL)
    live_roles = roles.where(F.col("datetype") == c.OPERATIONAL)
    code = codes.select(F.col("ID").alias("code_id"), "displayname")

    member_roles = live_roles.join(
        code.where(F.col("displayname").isin(c.MEMBER_ROLES)),
        F.col("roleID") == F.col("code_id"),
    ).select("organisationID")
    members = live.join(member_roles, "organisationID").select(
        F.col("organisationID").alias("PRACTICE_CODE"), F.col("Name").alias("PRACTICE_NAME")
    )
    network_roles = (
        live_roles.where((F.col("roleID") == c.NETWORK_ROLE) & (F.col("primaryRole") == 1))
        .join(code, F.col("roleID") == F.col("code_id"))
        .select("organisationID")
    )
    networks = live.join(network_roles, "organisationID").select(
        F.col("organisationID").alias("PCN_CODE"), F.col("Name").alias("PCN_NAME")
    )
    links = relationships.join(
        code.where(F.col("displayname") == c.MEMBERSHIP),
        F.col("relationshipID") == F.col("code_id"),
    ).select(
        F.col("organisationID").alias("PRACTICE_CODE"),
        F.col("targetOrganisationID").alias("PCN_CODE"),
        F.col("StartDate").alias("RELATIONSHIP_START_DATE"),
        F.col("EndDate").alias("RELATIONSHIP_END_DATE"),
    )
    return links.join(networks, "PCN_CODE").join(members, "PRACTICE_CODE").select(
        "PRACTICE_NAME", "PRACTICE_CODE", "RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE",
        "PCN_NAME", "PCN_CODE",
    )


def merged_history(history: DataFrame) -> DataFrame:
    """Relationships with overlapping and touching intervals of one practice and network as one.

    An interval touches the next one if that begins on the day after its end. Rows without a start,
    and rows that end before they start, are valid on no day and go. Intervals shrink to one per
    start day first, so a window sees at most as many rows as a relationship has start days.
    """
    versions = ("RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE")
    start, end = map(F.col, versions)
    parties = [name for name in history.columns if name not in versions]
    last = F.coalesce(F.unix_date(end), F.lit(_HALF - 1)).cast("bigint")
    days = (
        history.where(start.isNotNull() & (end.isNull() | (end >= start)))
        .groupBy(*parties, start).agg(F.max(last).alias("last"))
    )
    by_start = Window.partitionBy(*parties).orderBy(versions[0])
    reached = F.max("last").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.unix_date(start) > reached + 1, F.lit(True))
    islands = days.withColumn("new", new.cast("int")).withColumn("island", F.sum("new").over(by_start))
    merged = islands.groupBy(*parties, "island").agg(
        F.min(versions[0]).alias(versions[0]), F.max("last").alias("last"))
    open_end = F.when(F.col("last") < _HALF - 1, F.date_from_unix_date(F.col("last").cast("int")))
    return merged.withColumn(versions[1], open_end).select(*history.columns)


def _version_rank(start: Column, end: Column) -> Column:
    """One number that orders versions: later start first, then open end, then earlier end."""
    open_or_early = F.when(end.isNull(), _OPEN).otherwise(_HALF - F.unix_date(end))
    return F.unix_date(start).cast("bigint") * _SPAN + open_or_early


def _version_dates(rank: Column) -> tuple[Column, Column]:
    """Start and end of a ranked version."""
    low = F.pmod(rank, F.lit(_SPAN))
    start = F.date_from_unix_date(((rank - low) / _SPAN).cast("int"))
    end = F.when(low != _OPEN, F.date_from_unix_date((_HALF - low).cast("int")))
    return start, end


def mapping_as_of(history: DataFrame, day: date | str) -> DataFrame:
    """The network of each practice on a date: its valid version with the latest start.

    Ties on the start go to the lowest network code. The versions of a practice in one network
    first shrink to one number each, in a hash table of every map task, so that neither a sort
    nor a shuffle sees the whole history. The choice between networks works on what is left.
    """
    versions = ("RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE")
    networks = [name for name in history.columns if name not in versions]
    rest = [name for name in networks if name not in ("PRACTICE_CODE", "PCN_CODE")]
    latest = (
        history.where(valid_on(F.lit(as_date(day)), *versions))
        .groupBy(*networks)
        .agg(F.max(_version_rank(*map(F.col, versions))).alias("rank"))
    )
    start, end = _version_dates(F.col("rank"))
    ordered = F.struct(
        F.negative(F.unix_date(start)).alias("recency"), "PCN_CODE", *rest, end.alias("end"),
        start.alias("start"),
    )
    best = latest.groupBy("PRACTICE_CODE").agg(F.min(ordered).alias("best"))
    source = {"PRACTICE_CODE": "PRACTICE_CODE", versions[0]: "best.start", versions[1]: "best.end"}
    return best.select(
        *[F.col(source.get(name, f"best.{name}")).alias(name) for name in history.columns],
        F.lit(as_date(day)).alias("EXTRACT_DATE"),
    )


def network_names(mapping: DataFrame) -> DataFrame:
    return mapping.select("PCN_CODE", "PCN_NAME").distinct()


def mapped_only(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of organisations that belong to a network."""
    members = mapping.select(F.col("PRACTICE_CODE").alias("ORG_ID"))
    return rows.join(members, "ORG_ID", "left_semi")


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides; empty if the sets are disjoint.

    Both sides shrink to their distinct keys before they meet, so a frequent key costs nothing.
    """
    return left.select(key).distinct().intersect(right.select(key).distinct())
