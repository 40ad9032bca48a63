"""Published rows and sinks. Sinks write to the session's shared folder and are read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.operators import mapping, population, publish
from ratesmith.sources import reference, sinks
from ratesmith.sources.workspace import new_path, staged
from registry import activity, bindings as b, rates
from registry.catalogue import register
from registry.check_views import AT
from registry.views import Tables

_STAMP = "'2001-01-05 09:30:00' AS CREATED_AT"
_EARLIER = "'2000-12-05 09:30:00' AS CREATED_AT"


def _long_check(source: str, attribute: str, value: str) -> str:
    return f"""
SELECT PCN_CODE AS ORG_ID, DATE '{AT}' AS ACHIEVEMENT_DATE, 'E1B4261F-8649-42D0-A40E-208AA41F8EAE' AS DATA_REFERENCE_IDENTIFIER,
 {attribute} AS ATTRIBUTE_IDENTIFIER, CAST(CAST(ROUND(SUM({value})) AS BIGINT) AS VARCHAR) AS ATTRIBUTE_VALUE, 'int' AS ATTRIBUTE_TYPE, {_STAMP}
FROM {{{source}}} GROUP BY PCN_CODE, {attribute}"""


_CRUDE_ID = (
    "CASE ATTRIBUTE_ID WHEN 'D3C64D53-20CF-43E7-B15B-1AA8613F7B74' THEN 'd4909566-9bc8-11ed-a8fc-0242ac120002' "
    "ELSE 'd4909836-9bc8-11ed-a8fc-0242ac120002' END"
)
_DENOMINATOR_CHECK = _long_check("ck_denominators", "Attribute_ID", "COUNT")
_NUMERATOR_CHECK = _long_check("ck_both_numerators", "ATTRIBUTE_ID", "standardised_admissions")
_CRUDE_CHECK = _long_check("ck_both_numerators", _CRUDE_ID, "admissions")


def _codes(t: Tables) -> DataFrame:
    return reference.attribute_codes(reference.attribute_mapping(t.spark))


def _long(t: Tables, table: DataFrame, value: str, labels: dict | None = None) -> DataFrame:
    return publish.long_rows(
        table, "PCN_CODE", b.PERIOD.end, labels or {}, value, _codes(t), b.CREATED_AT
    )


def _denominators(bands: DataFrame) -> DataFrame:
    return population.list_size_from(bands, population.denominator_attributes(b.PERIOD))


@register(_DENOMINATOR_CHECK)
def cqrs_denominator(t: Tables) -> DataFrame:
    bands = b.network_bands(t, b.practice_mapping(t))
    return b.stamp_text(_long(t, _denominators(bands), "COUNT"))


@register(_NUMERATOR_CHECK)
def cqrs_numerator(t: Tables) -> DataFrame:
    both = rates.both_numerators(t, *rates.staged_inputs(t))
    return b.stamp_text(_long(t, both, "standardised_admissions"))


@register(_CRUDE_CHECK)
def udal_non_standardised(t: Tables) -> DataFrame:
    both = rates.both_numerators(t, *rates.staged_inputs(t))
    return b.stamp_text(_long(t, both, "admissions", c.CRUDE_IDS))


@register(f"""
SELECT ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER, CASE WHEN numerator AND ATTRIBUTE_VALUE <> '0' THEN
 CASE WHEN CAST(ATTRIBUTE_VALUE AS BIGINT) <= 7 THEN '*' ELSE CAST((CAST(ATTRIBUTE_VALUE AS BIGINT) + 2) // 5 * 5 AS VARCHAR) END
 ELSE ATTRIBUTE_VALUE END AS ATTRIBUTE_VALUE, ATTRIBUTE_TYPE, CREATED_AT
FROM (SELECT *, FALSE AS numerator FROM ({_DENOMINATOR_CHECK}) a UNION ALL SELECT *, TRUE FROM ({_NUMERATOR_CHECK}) b
 UNION ALL SELECT *, TRUE FROM ({_CRUDE_CHECK}) c) x""")
def udal_suppressed(t: Tables) -> DataFrame:
    """All three groups of rows, with small numbers hidden in the numerators only."""
    practices, bands = rates.staged_inputs(t)
    both = staged(rates.both_numerators(t, practices, bands), "numerators")
    rows = publish.stack([
        _long(t, _denominators(bands), "COUNT"),
        _long(t, both, "standardised_admissions"),
        _long(t, both, "admissions", c.CRUDE_IDS),
    ])
    numerators = [
        c.ADMISSIONS_NUMERATOR, c.ADMISSIONS_BASE_NUMERATOR,
        c.ADMISSIONS_CRUDE, c.ADMISSIONS_BASE_CRUDE,
    ]
    return b.stamp_text(publish.suppressed(rows, numerators))


def _publication_check(source: str, current: str, labels: tuple[str, str], value: str) -> str:
    return f"""
SELECT 'PCN' AS ORGANISATION_TYPE, PCN_CODE AS ORGANISATION_CODE, PCN_NAME AS ORGANISATION_NAME, 'NCD9900' AS QUALITY_SERVICE, '{AT}' AS ACH_DATE,
 'NCD022' AS IND_CODE, CASE ATTRIBUTE_ID WHEN '{current}' THEN '{labels[0]}' ELSE '{labels[1]}' END AS MEASURE, CAST(SUM({value}) AS DOUBLE) AS VALUE, {_STAMP}
FROM {{{source}}} GROUP BY PCN_CODE, PCN_NAME, ATTRIBUTE_ID"""


_PUBLICATION_CHECK = " UNION ALL ".join([
    _publication_check("ck_denominators", c.ADMISSIONS_DENOMINATOR,
                       ("Denominator", "Base Year Denominator"), "COUNT"),
    _publication_check("ck_both_numerators", c.ADMISSIONS_NUMERATOR,
                       ("Numerator", "Base Year Numerator"), "standardised_admissions"),
    _publication_check("ck_both_numerators", c.ADMISSIONS_NUMERATOR,
                       ("Numerator - Non-standardised", "Base Year Numerator - Non-standardised"),
                       "admissions"),
])


def _publication(t: Tables) -> DataFrame:
    practices, bands = rates.staged_inputs(t)
    both = staged(rates.both_numerators(t, practices, bands), "numerators")

    def rows(table: DataFrame, labels: dict, value: str) -> DataFrame:
        return publish.publication_rows(
            table, c.NETWORK_TYPE, "PCN_CODE", "PCN_NAME", b.PERIOD.year_label, b.PERIOD.end,
            c.ADMISSIONS_CODE, labels, value, b.CREATED_AT,
        )

    return publish.stack([
        rows(_denominators(bands), c.DENOMINATOR_LABELS, "COUNT"),
        rows(both, c.NUMERATOR_LABELS, "standardised_admissions"),
        rows(both, c.CRUDE_LABELS, "admissions"),
    ])


@register(_PUBLICATION_CHECK)
def publication_rows(t: Tables) -> DataFrame:
    return b.stamp_text(_publication(t))


@register(f"""
SELECT ORGANISATION_TYPE, ORGANISATION_CODE, ORGANISATION_NAME, QUALITY_SERVICE, ACH_DATE, IND_CODE, MEASURE, VALUE FROM ({_PUBLICATION_CHECK}) x""")
def publication_replace(t: Tables) -> DataFrame:
    """The publication table after it was written twice: the second write replaces the first."""
    rows = staged(_publication(t), "publication_batch")
    target = new_path(t.spark, "publication")
    sinks.replace_publication(rows.withColumn("VALUE", F.lit(0.0)), target)
    sinks.replace_publication(rows, target)
    return sinks.read(t.spark, target)


# --- appointment exports --------------------------------------------------------------------
_MEASURES = [c.WAITS_DENOMINATOR_LABEL, c.WAITS_NUMERATOR_LABEL, c.ROUNDS_NUMERATOR_LABEL]
_EXPORT_CHECK = f"""
SELECT * FROM ({activity.DENOMINATOR_CHECK} UNION ALL {activity.NUMERATOR_CHECK} UNION ALL {activity.ROUNDS_CHECK}) x
WHERE ORG_ID IN (SELECT PRACTICE_CODE FROM {{ck_mapping}})"""


def _export(t: Tables) -> DataFrame:
    return mapping.mapped_only(activity.measured(t, _MEASURES), b.practice_mapping(t))


@register(
    "SELECT ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER, ATTRIBUTE_VALUE, ATTRIBUTE_TYPE, CREATED_AT "
    f"FROM ({_EXPORT_CHECK}) y"
)
def landing_export(t: Tables) -> DataFrame:
    return b.stamp_text(publish.landing_rows(_export(t))).orderBy("ORG_ID")


@register(
    "SELECT ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER, ATTRIBUTE_VALUE, ATTRIBUTE_TYPE, CREATED_AT "
    f"FROM ({_EXPORT_CHECK}) y WHERE DATA_REFERENCE_IDENTIFIER = 'FB4334A8-2E9C-43AB-9D1F-51C4A4F14E6B'"
)
def route_indicator(t: Tables) -> DataFrame:
    """Care-home rounds read back from the folder their rows were routed to."""
    target = new_path(t.spark, "routed")
    sinks.route(publish.landing_rows(_export(t)), target)
    return b.stamp_text(sinks.read_routed(t.spark, target, c.ROUNDS_INDICATOR)).select(
        *publish.LONG_COLUMNS
    )


@register(f"SELECT *, {_EARLIER} FROM {{fx_published}}")
def sink_overwrite(t: Tables) -> DataFrame:
    """A table written twice holds the second batch only."""
    target = new_path(t.spark, "overwrite")
    sinks.overwrite(b.late_batch(t), target)
    sinks.overwrite(b.published(t), target)
    return b.stamp_text(sinks.read(t.spark, target))


@register(f"""
SELECT *, {_EARLIER} FROM {{fx_published}} UNION ALL SELECT *, {_STAMP} FROM {{fx_late_batch}}""")
def sink_insert(t: Tables) -> DataFrame:
    """Insert in place of a table's rows, then after them; columns given in another order."""
    target, table = new_path(t.spark, "insert"), f"insert_{uuid.uuid4().hex}"
    b.late_batch(t).write.option("path", target).saveAsTable(table)
    for batch, replace in ((b.published(t), True), (b.late_batch(t), False)):
        sinks.insert(batch.select(*reversed(batch.columns)), table, replace)
    t.spark.sql(f"DROP TABLE {table}")  # its files stay
    return b.stamp_text(t.spark.read.parquet(target))


_REPLACED = f"""
SELECT p.*, {_EARLIER} FROM {{fx_published}} p WHERE NOT EXISTS (SELECT 1 FROM {{fx_late_batch}} n WHERE n.ORG_ID = p.ORG_ID
 AND n.ACHIEVEMENT_DATE = p.ACHIEVEMENT_DATE AND n.DATA_REFERENCE_IDENTIFIER = p.DATA_REFERENCE_IDENTIFIER AND n.ATTRIBUTE_IDENTIFIER = p.ATTRIBUTE_IDENTIFIER)
UNION ALL SELECT *, {_STAMP} FROM {{fx_late_batch}}"""


@register(_REPLACED)
def keyed_replace(t: Tables) -> DataFrame:
    """A published table after an update that rewrites only the folders of the batch's dates."""
    target = new_path(t.spark, "published")
    sinks.start_published(b.published(t), target)
    sinks.update_published(staged(b.late_batch(t), "late_batch"), target)
    return b.stamp_text(sinks.read_published(t.spark, target))


@register(_REPLACED)
def keyed_replace_rows(t: Tables) -> DataFrame:
    """The same update as a pure transformation."""
    return b.stamp_text(publish.replace_by_key(b.published(t), b.late_batch(t)))


@register(f"SELECT *, {_EARLIER} FROM {{fx_published}} UNION ALL SELECT *, {_STAMP} FROM {{fx_late_batch}}")
def archive_append(t: Tables) -> DataFrame:
    """A newer batch joins the archive."""
    return b.stamp_text(publish.append_if_newer(b.published(t), b.late_batch(t)))


@register(f"SELECT *, {_EARLIER} FROM {{fx_published}}")
def archive_skip(t: Tables) -> DataFrame:
    """A batch as old as the archive is left out."""
    late = b.late_batch(t, b.EARLIER)
    return b.stamp_text(publish.append_if_newer(b.published(t), late))


@register(f"""
SELECT '2000-12-05 09:30:00' AS CREATED_AT, (SELECT COUNT(*) FROM {{fx_published}}) AS rows
UNION ALL SELECT '2001-01-05 09:30:00', (SELECT COUNT(*) FROM {{fx_late_batch}})""")
def archive_batches(t: Tables) -> DataFrame:
    """Batch sizes of an archive that was offered the same batch twice."""
    target = new_path(t.spark, "archive")
    sinks.archive(staged(b.published(t), "published_batch"), target)
    batch = staged(b.late_batch(t), "late_batch")
    for _ in range(2):
        sinks.archive(batch, target)
    return b.stamp_text(publish.batch_sizes(sinks.read_archive(t.spark, target)))


@register("SELECT * FROM {fx_published} UNION ALL SELECT * FROM {fx_late_batch} UNION ALL SELECT * FROM {fx_published_second}")
def union_all_aligned(t: Tables) -> DataFrame:
    """Three tables with their columns in different orders."""
    late, second = t["fx_late_batch"], t["fx_published_second"]
    return publish.stack([
        t["fx_published"], late.select(*reversed(late.columns)), second.select(*sorted(second.columns)),
    ])


@register("SELECT * FROM {fx_published} ORDER BY ACHIEVEMENT_DATE DESC")
def published_latest_first(t: Tables) -> DataFrame:
    return publish.latest_first(t["fx_published"])
