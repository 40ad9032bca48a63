"""Organisations and populations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith.operators import mapping, population, quality
from registry import bindings as b
from registry.catalogue import register
from registry.check_views import AT, CURRENT
from registry.views import Tables

_DAY = f"DATE '{CURRENT[2]}'"


@register(f"""
SELECT r.CODE AS PRACTICE_CODE FROM {{fx_practice_register}} r
WHERE r.OPEN_DATE <= {_DAY} AND (r.CLOSE_DATE >= {_DAY} OR r.CLOSE_DATE IS NULL)
 AND r.DSS_RECORD_START_DATE <= {_DAY} AND (r.DSS_RECORD_END_DATE >= {_DAY} OR r.DSS_RECORD_END_DATE IS NULL)
 AND r.CODE IN (SELECT PRACTICE_CODE FROM {{fx_list_size_snapshots}} WHERE EXTRACT_DATE = {_DAY})""")
def active_practices(t: Tables) -> DataFrame:
    return mapping.active_practices(
        t["fx_practice_register"], t["fx_list_size_snapshots"], b.PERIOD.month_start
    )


@register(f"""
SELECT PRACTICE_CODE, SEX, AGE_FROM, EXTRACT_DATE, CAST(val AS BIGINT) AS val FROM {{ck_active_snapshots}} WHERE EXTRACT_DATE = {_DAY}""")
def active_list_size(t: Tables) -> DataFrame:
    rows = population.snapshot(t["fx_list_size_snapshots"], b.PERIOD.month_start)
    active = mapping.active_practices(t["fx_practice_register"], rows, b.PERIOD.month_start)
    return mapping.active_only(rows, active)


@register(f"SELECT *, DATE '{AT}' AS EXTRACT_DATE FROM {{ck_mapping}}")
def asof_mapping(t: Tables) -> DataFrame:
    return b.practice_mapping(t)


@register("""
SELECT o.Name AS PRACTICE_NAME, o.organisationID AS PRACTICE_CODE, l.StartDate AS RELATIONSHIP_START_DATE, l.EndDate AS RELATIONSHIP_END_DATE,
 n.Name AS PCN_NAME, n.organisationID AS PCN_CODE
FROM {fx_org} o, {fx_org_role} r, {fx_org_code} rc, {fx_org_relationship} l, {fx_org_code} lc, {fx_org} n, {fx_org_role} nr, {fx_org_code} nrc
WHERE o.datetype = 'Operational' AND n.datetype = 'Operational' AND r.datetype = 'Operational' AND nr.datetype = 'Operational'
 AND rc.displayname IN ('GP PRACTICE', 'PRESCRIBING COST CENTRE') AND o.organisationID = r.organisationID AND r.roleID = rc.ID
 AND nr.roleID = 'RO272' AND nr.primaryRole = 1 AND l.organisationID = o.organisationID AND l.relationshipID = lc.ID
 AND l.targetOrganisationID = n.organisationID AND lc.displayname = 'IS PARTNER TO' AND n.organisationID = nr.organisationID AND nr.roleID = nrc.ID""")
def org_relationships(t: Tables) -> DataFrame:
    return mapping.membership_history(
        t["fx_org"], t["fx_org_role"], t["fx_org_code"], t["fx_org_relationship"]
    )


_RELATIONSHIPS = """
SELECT o.Name AS PRACTICE_NAME, o.organisationID AS PRACTICE_CODE, l.StartDate AS s, l.EndDate AS e, n.Name AS PCN_NAME, n.organisationID AS PCN_CODE
FROM {fx_org_relationship} l JOIN {fx_org} o ON o.organisationID = l.organisationID AND o.datetype = 'Operational'
JOIN {fx_org} n ON n.organisationID = l.targetOrganisationID AND n.datetype = 'Operational'
JOIN {fx_org_role} r ON r.organisationID = o.organisationID AND r.datetype = 'Operational' AND r.roleID IN ('RO76', 'RO177')
JOIN {fx_org_role} nr ON nr.organisationID = n.organisationID AND nr.datetype = 'Operational' AND nr.roleID = 'RO272' AND nr.primaryRole = 1
WHERE l.relationshipID = 'RE8'"""
_LATEST = f"""
SELECT PRACTICE_NAME, PRACTICE_CODE, s AS RELATIONSHIP_START_DATE, e AS RELATIONSHIP_END_DATE, PCN_NAME, PCN_CODE, DATE '{AT}' AS EXTRACT_DATE
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY PRACTICE_CODE ORDER BY s DESC, PCN_CODE, PRACTICE_NAME, PCN_NAME, CASE WHEN e IS NULL THEN 0 ELSE 1 END, e) AS place
 FROM ({{rows}}) x WHERE s <= DATE '{AT}' AND (e >= DATE '{AT}' OR e IS NULL)) y WHERE place = 1"""


def _memberships(t: Tables) -> DataFrame:
    return mapping.membership_history(
        t["fx_org"], t["fx_org_role"], t["fx_org_code"], t["fx_org_relationship"]
    )


@register(_LATEST.replace("{rows}", _RELATIONSHIPS))
def org_mapping(t: Tables) -> DataFrame:
    """From the organisation tables to the network of each practice, names included."""
    return mapping.mapping_as_of(_memberships(t), b.PERIOD.end)


_ISLANDS = f"""
SELECT PRACTICE_NAME, PRACTICE_CODE, MIN(s) AS s, CASE WHEN MAX(CASE WHEN e IS NULL THEN 1 ELSE 0 END) = 0 THEN MAX(e) END AS e, PCN_NAME, PCN_CODE
FROM (SELECT *, SUM(fresh) OVER (PARTITION BY PRACTICE_CODE, PCN_CODE ORDER BY s, f ROWS UNBOUNDED PRECEDING) AS island
 FROM (SELECT *, CASE WHEN s > MAX(f) OVER (PARTITION BY PRACTICE_CODE, PCN_CODE ORDER BY s, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS fresh
  FROM (SELECT *, COALESCE(e, DATE '2500-01-01') AS f FROM ({_RELATIONSHIPS}) r WHERE e IS NULL OR e >= s) a) b) c
GROUP BY PRACTICE_NAME, PRACTICE_CODE, PCN_NAME, PCN_CODE, island"""


@register(_LATEST.replace("{rows}", _ISLANDS))
def org_mapping_merged(t: Tables) -> DataFrame:
    """As `org_mapping`, with the intervals of one practice and network merged before the choice."""
    return mapping.mapping_as_of(mapping.merged_history(_memberships(t)), b.PERIOD.end)


@register("SELECT DISTINCT PCN_CODE, PCN_NAME FROM {ck_mapping}")
def pcn_names(t: Tables) -> DataFrame:
    return mapping.network_names(b.practice_mapping(t))


@register(
    "SELECT * FROM {fx_published} WHERE ORG_ID IN (SELECT PRACTICE_CODE FROM {ck_mapping})"
)
def mapped_practices_only(t: Tables) -> DataFrame:
    return mapping.mapped_only(t["fx_published"], b.practice_mapping(t))


@register("""
SELECT DISTINCT GPPRAC AS PRACTICE_CODE FROM {fx_episodes} WHERE GPPRAC IN (SELECT CODE FROM {fx_practice_register} WHERE CLOSE_DATE IS NOT NULL)""")
def keysets_disjoint(t: Tables) -> DataFrame:
    """Practices with episodes that also stand in the list of closed practices."""
    closed = t["fx_practice_register"].where(F.col("CLOSE_DATE").isNotNull())
    return mapping.shared_keys(
        t["fx_episodes"].withColumnRenamed("GPPRAC", "PRACTICE_CODE"),
        closed.withColumnRenamed("CODE", "PRACTICE_CODE"),
        "PRACTICE_CODE",
    )


_VALID = f"""
SELECT * FROM {{fx_mapping_history}} WHERE RELATIONSHIP_START_DATE <= DATE '{AT}' AND (RELATIONSHIP_END_DATE >= DATE '{AT}' OR RELATIONSHIP_END_DATE IS NULL)"""


@register(f"SELECT PRACTICE_CODE, COUNT(*) AS mappings FROM ({_VALID}) v GROUP BY 1 HAVING COUNT(*) > 1")
def dq_mapping_unique(t: Tables) -> DataFrame:
    """Practices with several valid mappings, before one is chosen."""
    day = F.lit(b.PERIOD.end)
    valid = mapping.valid_on(day, "RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE")
    return quality.repeated_practices(t["fx_mapping_history"].where(valid))


@register(f"""
SELECT PCN_CODE, PCN_NAME, AGE_FIVE_YEAR, COUNT, EXTRACT_DATE, 'D388FDB3-E3D7-44F2-80C7-0832B448C9B4' AS Attribute_ID
FROM {{ck_list_size}} WHERE EXTRACT_DATE = {_DAY}""")
def pcn_list_size(t: Tables) -> DataFrame:
    return population.list_size_by_network(
        b.wide_list_size(t),
        b.practice_mapping(t),
        {b.PERIOD.month_start: "D388FDB3-E3D7-44F2-80C7-0832B448C9B4"},
        b.register_rows(t),
    )


@register("SELECT PCN_CODE, PCN_NAME, AGE_FIVE_YEAR, COUNT, EXTRACT_DATE, Attribute_ID FROM {ck_denominators}")
def denominator_two_periods(t: Tables) -> DataFrame:
    return population.list_size_by_network(
        b.wide_list_size(t),
        b.practice_mapping(t),
        population.denominator_attributes(b.PERIOD),
        b.register_rows(t),
    )


@register(f"SELECT AGE_FIVE_YEAR, DATE '{CURRENT[0]}' AS EXTRACT_DATE, Count FROM {{ck_england}}")
def england_list_size(t: Tables) -> DataFrame:
    return population.standard_population(
        b.wide_list_size(t), b.PERIOD.start, b.register_rows(t)
    )
