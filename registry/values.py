"""Scans, reshaping, scalar expressions and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.functions import bands, period, values
from ratesmith.operators import population, reshape, rollup
from ratesmith.sources import reference, scans
from registry import bindings as b
from registry.catalogue import register
from registry.check_views import CURRENT, EPISODE_COLUMNS
from registry.views import Tables

_WIDE = ", ".join(
    f"CAST(SUM(CASE WHEN SEX = '{sex}' AND AGE_FROM = {age} THEN val ELSE 0 END) AS BIGINT) AS {sex}_{age}_{age + 1}"
    for sex in ("FEMALE", "MALE")
    for age in range(120)
)
_ATTRIBUTE_ROWS = ", ".join(
    "(" + ", ".join("'" + part + "'" for part in row) + ")" for row in c.ATTRIBUTES
)
_KEY_ROWS = """SELECT s.SEX || '_' || CAST(a.age AS VARCHAR) || '_' || CAST(a.age + 1 AS VARCHAR) AS key, s.SEX, a.age
 FROM (VALUES ('MALE'), ('FEMALE')) s(SEX), (SELECT CAST(unnest(range(0, 120)) AS INT) AS age) a"""


@register(f"SELECT {EPISODE_COLUMNS} FROM {{fx_episode_table}}")
def scan_typed(t: Tables) -> DataFrame:
    return scans.episodes(t["fx_episode_table"])


@register(
    f"SELECT PRACTICE_CODE, EXTRACT_DATE, {_WIDE} FROM {{fx_list_size_snapshots}} "
    f"WHERE EXTRACT_DATE = DATE '{CURRENT[2]}' GROUP BY 1, 2"
)
def scan_snapshot(t: Tables) -> DataFrame:
    return population.snapshot(b.wide_list_size(t), b.PERIOD.month_start)


@register("""
SELECT supplier AS Supplier, gp_code AS GP_Code, time_between_booking_and_appt AS Wait_Time, context_type AS Context_Type,
 appt_status AS Appointment_Status, national_category AS National_Slot_Type, appt_count AS Appointments, appt_date AS Appointment_Date
FROM {ck_window}""")
def scan_period(t: Tables) -> DataFrame:
    return b.appointments(t)


@register(f"""
SELECT k.key AS ORIGINAL, k.SEX, CASE WHEN age < 95 THEN CAST(age AS VARCHAR) ELSE '95+' END AS AGE,
 CASE WHEN age < 95 THEN key ELSE k.SEX || '_95+' END AS AGE_ONE_YEAR,
 k.SEX || '_' || CASE WHEN age < 95 THEN CAST(age - age % 5 AS VARCHAR) || '_' || CAST(age - age % 5 + 4 AS VARCHAR) ELSE '95+' END AS AGE_FIVE_YEAR,
 k.SEX || '_' || CASE WHEN age < 90 THEN CAST(age - age % 10 AS VARCHAR) || '_' || CAST(age - age % 10 + 9 AS VARCHAR) ELSE '90+' END AS AGE_TEN_YEAR,
 CAST(COALESCE(SUM(l.val), 0) AS BIGINT) AS population
FROM ({_KEY_ROWS}) k LEFT JOIN {{fx_list_size_long}} l ON l.SEX = k.SEX AND l.AGE_FROM = k.age
GROUP BY 1, 2, 3, 4, 5, 6""")
def ref_age_bands(t: Tables) -> DataFrame:
    """The age reference with the population of each of its rows."""
    counted = t["fx_list_size_long"].groupBy("SEX", "AGE_FROM").agg(F.sum("val").alias("total"))
    keyed = counted.select(
        F.concat_ws("_", "SEX", "AGE_FROM", F.col("AGE_FROM") + 1).alias("ORIGINAL"), "total"
    )
    return (
        bands.age_reference(t.spark)
        .join(keyed, "ORIGINAL", "left")
        .withColumn("population", F.coalesce("total", F.lit(0)))
        .drop("total")
    )


@register(f"""
SELECT a.Indicator_description, a.DATA_REFERENCE_IDENTIFIER, a.Attribute_description, a.ATTRIBUTE_IDENTIFIER, COUNT(p.ORG_ID) AS published_rows
FROM (VALUES {_ATTRIBUTE_ROWS}) a(Indicator_description, DATA_REFERENCE_IDENTIFIER, Attribute_description, ATTRIBUTE_IDENTIFIER)
LEFT JOIN {{fx_published}} p ON p.ATTRIBUTE_IDENTIFIER = a.ATTRIBUTE_IDENTIFIER GROUP BY 1, 2, 3, 4""")
def ref_attributes(t: Tables) -> DataFrame:
    """The attribute lookup with the number of published rows of each attribute."""
    mapping = reference.attribute_mapping(t.spark).withColumnsRenamed(
        {"Indicator": "DATA_REFERENCE_IDENTIFIER", "Attribute_ID": "ATTRIBUTE_IDENTIFIER"}
    )
    counted = t["fx_published"].groupBy("ATTRIBUTE_IDENTIFIER").agg(
        F.count("ORG_ID").alias("rows")
    )
    return (
        mapping.join(counted, "ATTRIBUTE_IDENTIFIER", "left")
        .withColumn("published_rows", F.coalesce("rows", F.lit(0)))
        .drop("rows")
    )


@register("""
SELECT national_category AS FRIENDLY_IDENTIFIER, COUNT(*) AS appointment_rows,
 CASE WHEN national_category = 'Patient contact during Care Home Round' THEN 'FB4334A8-2E9C-43AB-9D1F-51C4A4F14E6B' ELSE 'INDICATOR NOT FOUND IN LOOKUP' END AS DATA_REFERENCE_IDENTIFIER,
 CASE WHEN national_category = 'Patient contact during Care Home Round' THEN '982C9A99-A4EA-48FB-ABE9-B60B3E2F1719' ELSE 'INDICATOR NOT FOUND IN LOOKUP' END AS ATTRIBUTE_IDENTIFIER
FROM {fx_appointments} GROUP BY 1""")
def attr_lookup_default(t: Tables) -> DataFrame:
    """Categories looked up by description; most have no identifier."""
    rows = t["fx_appointments"].groupBy(
        F.col("national_category").alias("FRIENDLY_IDENTIFIER")
    ).agg(F.count("*").alias("appointment_rows"))
    return reference.with_attribute_ids(rows, reference.attribute_mapping(t.spark))


@register("SELECT DISTINCT gp_code AS GP_Code FROM {ck_window}")
def practice_universe(t: Tables) -> DataFrame:
    return rollup.practice_universe(b.appointments(t))


@register(
    "SELECT * FROM {fx_published} WHERE ATTRIBUTE_IDENTIFIER = '767390F9-FD7E-4B01-A8AE-82B41DE00A02'"
)
def published_subset(t: Tables) -> DataFrame:
    return scans.published_subset(t["fx_published"], [c.WAITS_NUMERATOR])


@register("""
SELECT * FROM {fx_published} WHERE ACHIEVEMENT_DATE = (SELECT MAX(ACHIEVEMENT_DATE) FROM {fx_published})""")
def latest_month(t: Tables) -> DataFrame:
    return scans.latest_month(t["fx_published"])


@register(f"""
SELECT p.PRACTICE_CODE, p.EXTRACT_DATE, k.key, CAST(COALESCE(s.val, 0) AS BIGINT) AS val
FROM (SELECT DISTINCT PRACTICE_CODE, EXTRACT_DATE FROM {{fx_list_size_snapshots}}) p CROSS JOIN ({_KEY_ROWS}) k
LEFT JOIN {{fx_list_size_snapshots}} s ON s.PRACTICE_CODE = p.PRACTICE_CODE AND s.EXTRACT_DATE = p.EXTRACT_DATE AND s.SEX = k.SEX AND s.AGE_FROM = k.age""")
def unpivot_wide(t: Tables) -> DataFrame:
    wide = b.wide_list_size(t).drop(*population.ADMIN_COLUMNS)
    return reshape.unpivot_counts(wide, population.IDS)


_CODE_TEXT = """
SELECT EPIKEY, CASE WHEN OPERTN_3_01 IS NULL THEN NULL ELSE DIAG_4_01 || ',' || DIAG_4_02 || ',' || DIAG_4_01 || ', ' || DIAG_4_02 || ',' END AS codes
FROM {fx_episodes}"""


@register(f"""
SELECT EPIKEY, array_to_string(list_sort(list_distinct(string_split(codes, ','))), '|') AS code_set,
 len(list_distinct(string_split(codes, ','))) AS n_codes
FROM ({_CODE_TEXT}) x""")
def codes_to_array(t: Tables) -> DataFrame:
    rows = t.sql(_CODE_TEXT).withColumn("entries", values.code_set(F.col("codes")))
    return rows.select(
        "EPIKEY",
        F.array_join(F.array_sort("entries"), "|").alias("code_set"),
        F.when(F.col("entries").isNotNull(), F.size("entries")).cast("bigint").alias("n_codes"),
    )


_SEX_TEXT = "SELECT EPIKEY, CASE WHEN EPIKEY % 7 = 0 THEN NULL ELSE SEX END AS code FROM {fx_episodes}"


@register(f"""
SELECT EPIKEY, CASE code WHEN '1' THEN 'MALE' WHEN '2' THEN 'FEMALE' ELSE 'UNKNOWN' END AS SEX FROM ({_SEX_TEXT}) x""")
def sex_relabel(t: Tables) -> DataFrame:
    return t.sql(_SEX_TEXT).select("EPIKEY", values.sex_name(F.col("code")).alias("SEX"))


@register("""
SELECT EPIKEY, CASE WHEN STARTAGE >= 95 THEN '95+' ELSE CAST(STARTAGE AS VARCHAR) END AS STARTAGE FROM {fx_episodes}""")
def age_topcode(t: Tables) -> DataFrame:
    return t["fx_episodes"].select("EPIKEY", bands.age_text(F.col("STARTAGE")).alias("STARTAGE"))


def _banded(t: Tables, width: int) -> DataFrame:
    label = bands.band(F.col("SEX"), F.col("AGE_FROM"), width).alias("band")
    return t["fx_list_size_long"].groupBy(label).agg(F.sum("val").alias("population"))


@register("""
SELECT SEX || '_' || CASE WHEN AGE_FROM < 95 THEN CAST(AGE_FROM - AGE_FROM % 5 AS VARCHAR) || '_' || CAST(AGE_FROM - AGE_FROM % 5 + 4 AS VARCHAR) ELSE '95+' END AS band,
 CAST(SUM(val) AS BIGINT) AS population FROM {fx_list_size_long} GROUP BY 1""")
def age_band_5(t: Tables) -> DataFrame:
    return _banded(t, 5)


@register("""
SELECT SEX || '_' || CASE WHEN AGE_FROM < 90 THEN CAST(AGE_FROM - AGE_FROM % 10 AS VARCHAR) || '_' || CAST(AGE_FROM - AGE_FROM % 10 + 9 AS VARCHAR) ELSE '90+' END AS band,
 CAST(SUM(val) AS BIGINT) AS population FROM {fx_list_size_long} GROUP BY 1""")
def age_band_10(t: Tables) -> DataFrame:
    return _banded(t, 10)


@register("""
SELECT ORG_ID, ACHIEVEMENT_DATE, CASE WHEN ATTRIBUTE_IDENTIFIER = '767390F9-FD7E-4B01-A8AE-82B41DE00A02' THEN 'Numerator' ELSE ATTRIBUTE_IDENTIFIER END AS MEASURE
FROM {fx_published}""")
def relabel_attributes(t: Tables) -> DataFrame:
    measure = values.relabel(F.col("ATTRIBUTE_IDENTIFIER"), {c.WAITS_NUMERATOR: "Numerator"})
    return t["fx_published"].select("ORG_ID", "ACHIEVEMENT_DATE", measure.alias("MEASURE"))


_DATE_TEXT = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))
  WHEN o_orderkey % 3 = 1 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), '-', '')
  WHEN o_orderkey % 6 = 2 THEN 'unknown' ELSE NULL END AS text
FROM {orders}"""


@register(f"""
SELECT o_orderkey, text, CASE WHEN o_orderkey % 3 < 2 THEN day ELSE NULL END AS parsed FROM ({_DATE_TEXT}) x""")
def parse_dates(t: Tables) -> DataFrame:
    return t.sql(_DATE_TEXT).select(
        "o_orderkey", "text", values.parse_date(F.col("text")).alias("parsed")
    )


_COUNT_TEXT = """
SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) * (l_linenumber - 2) AS VARCHAR(20)) END AS raw
FROM {lineitem}"""


@register(f"""
SELECT l_orderkey, l_partkey, raw, CASE WHEN raw IS NULL OR raw = '0' THEN '0' WHEN CAST(raw AS BIGINT) BETWEEN -7 AND 7 THEN '*'
 ELSE CAST(CAST(5 * ROUND(CAST(raw AS BIGINT) / 5.0) AS BIGINT) AS VARCHAR) END AS shown FROM ({_COUNT_TEXT}) x""")
def suppress_small(t: Tables) -> DataFrame:
    return t.sql(_COUNT_TEXT).withColumn("shown", values.suppress_small_count(F.col("raw")))


@register("""
SELECT c.code, COUNT(e.code) AS episodes
FROM (SELECT 'E' || CAST(p.p AS VARCHAR) || CAST(n.n AS VARCHAR) AS code FROM range(10, 15) p(p), range(0, 9) n(n)) c
LEFT JOIN (SELECT DIAG_4_01 AS code FROM {fx_episodes} UNION ALL SELECT DIAG_4_02 FROM {fx_episodes} WHERE DIAG_4_02 <> DIAG_4_01) e ON e.code = c.code
GROUP BY 1""")
def code_expand(t: Tables) -> DataFrame:
    """Episodes that carry each code of an expanded list in any position."""
    codes = reference.code_relation(t.spark, values.expand_codes("E", range(10, 15), 9))
    entries = values.code_set(F.concat_ws(",", "DIAG_4_01", "DIAG_4_02"))
    counted = (
        t["fx_episodes"].select(F.explode(entries).alias("code"))
        .groupBy("code").agg(F.count("*").alias("episodes"))
    )
    return codes.join(counted, "code", "left").fillna(0, ["episodes"])


_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}"
_FY = "CAST(date_trunc('year', {0} - INTERVAL 3 MONTH) + INTERVAL 3 MONTH AS DATE)"


def _calendar_check(day: str, keep: str) -> str:
    fy = _FY.format(f"date_trunc('month', {day})")
    return f"""
SELECT {keep}, last_day({day}) = {day} AS is_month_end, {fy} AS fy_start, CAST(date_trunc('month', {day}) AS DATE) AS month_start,
 CAST({day} - INTERVAL 1 YEAR AS DATE) AS baseline_end, CAST({fy} - INTERVAL 1 YEAR AS DATE) AS baseline_fy_start,
 CAST(date_trunc('month', {day}) - INTERVAL 1 YEAR AS DATE) AS baseline_month_start,
 strftime({fy} - INTERVAL 1 YEAR, '%y') || strftime({fy}, '%y') AS year_label"""


@register(f"{_calendar_check('day', 'day')} FROM ({_DAYS}) x")
def calendar_fields(t: Tables) -> DataFrame:
    days = t.sql(_DAYS)
    return days.withColumns(period.calendar_columns(F.col("day")))


@register(
    _calendar_check("report_end", "run_date, report_end")
    + f""" FROM (SELECT day AS run_date, CAST(date_trunc('month', day) - INTERVAL 1 DAY AS DATE) AS report_end FROM ({_DAYS}) x) y"""
)
def calendar_default(t: Tables) -> DataFrame:
    """The period a run on each date reports by default."""
    runs = t.sql(_DAYS).withColumnRenamed("day", "run_date")
    ends = runs.withColumn("report_end", period.last_complete_month_end(F.col("run_date")))
    return ends.withColumns(period.calendar_columns(F.col("report_end")))
