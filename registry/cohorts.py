"""Filters and cohort rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.operators import cohort, filters
from registry import bindings as b
from registry.catalogue import register
from registry.check_views import AT, CURRENT, EPISODE_COLUMNS, RULES
from registry.views import Tables


def _flat(rows: DataFrame) -> DataFrame:
    """Code arrays as text, which both engines print alike."""
    return rows.withColumns(
        {name: F.array_join(name, ",") for name in ("DIAG_3_CONCAT", "DIAG_4_CONCAT")}
    )


@register(f"""
SELECT EPIKEY, ADMIDATE FROM {{fx_episodes}} WHERE ADMIDATE >= DATE '{CURRENT[0]}' AND ADMIDATE <= DATE '{AT}'""")
def filter_period(t: Tables) -> DataFrame:
    kept = filters.keep_period(t["fx_episodes"], "ADMIDATE", b.PERIOD.start, b.PERIOD.end)
    return kept.select("EPIKEY", "ADMIDATE")


@register("SELECT EPIKEY, EPIORDER, SEX FROM {fx_episodes} WHERE EPIORDER = 1 AND SEX IN ('1', '2')")
def filter_isin(t: Tables) -> DataFrame:
    """Text codes against an integer and a text column."""
    kept = filters.keep_listed(t["fx_episodes"], "EPIORDER", c.FIRST_EPISODE)
    return filters.keep_listed(kept, "SEX", c.SEX_CODES).select("EPIKEY", "EPIORDER", "SEX")


@register("SELECT EPIKEY, MYDOB FROM {fx_episodes} WHERE MYDOB NOT IN ('011900', '011901', '011800')")
def filter_not_in_nulls(t: Tables) -> DataFrame:
    kept = filters.drop_listed(t["fx_episodes"], "MYDOB", c.INVALID_BIRTH_MONTHS)
    return kept.select("EPIKEY", "MYDOB")


_AGES = """
SELECT EPIKEY, CASE WHEN EPIKEY % 97 = 0 THEN CAST('NaN' AS DOUBLE) WHEN EPIKEY % 89 = 0 THEN NULL ELSE CAST(STARTAGE AS DOUBLE) + 0.5 END AS age
FROM {fx_episodes}"""


@register(f"SELECT EPIKEY, age FROM ({_AGES}) x WHERE NOT isnan(age) AND age >= 0 AND age <= 120")
def filter_range(t: Tables) -> DataFrame:
    """Limits given as text against a column with NULL and NaN."""
    return filters.keep_between(t.sql(_AGES), "age", ["0", "120"])


@register(
    "SELECT EPIKEY, OPERTN_3_01 FROM {fx_episodes} WHERE substr(OPERTN_3_01, 1, 1) NOT IN ('K', 'X')"
)
def filter_not_prefix(t: Tables) -> DataFrame:
    kept = filters.drop_prefixed(t["fx_episodes"], "OPERTN_3_01", ["K", "X"])
    return kept.select("EPIKEY", "OPERTN_3_01")


@register(f"SELECT {EPISODE_COLUMNS} FROM {{ck_valid}}")
def valid_episodes(t: Tables) -> DataFrame:
    arrays = cohort.codes_to_arrays(b.episodes(t))
    return _flat(cohort.valid_episodes(arrays, b.PERIOD.start, b.PERIOD.end))


def _rule(t: Tables, name: str) -> DataFrame:
    arrays = cohort.codes_to_arrays(b.episodes(t))
    return _flat(cohort.matching(arrays, cohort.CONDITION_RULES, name)).select(
        "EPIKEY", "DIAG_3_01", "DIAG_4_01", "OPERTN_3_01"
    )


def _rule_check(name: str) -> str:
    return (
        "SELECT EPIKEY, DIAG_3_01, DIAG_4_01, OPERTN_3_01 FROM {fx_episode_table} "
        f"WHERE {RULES[name]}"
    )


@register(_rule_check("no_exclusions_group"))
def cohort_no_exclusions(t: Tables) -> DataFrame:
    return _rule(t, "no_exclusions_group")


@register(_rule_check("cellulitis"))
def cohort_cellulitis(t: Tables) -> DataFrame:
    return _rule(t, "cellulitis")


@register(_rule_check("congestive_heart_failure"))
def cohort_heart_failure(t: Tables) -> DataFrame:
    return _rule(t, "congestive_heart_failure")


@register(_rule_check("copd"))
def cohort_copd(t: Tables) -> DataFrame:
    return _rule(t, "copd")


@register(_rule_check("hypertension"))
def cohort_hypertension(t: Tables) -> DataFrame:
    return _rule(t, "hypertension")


@register(_rule_check("influenza_pneumonia"))
def cohort_flu_pneumonia(t: Tables) -> DataFrame:
    return _rule(t, "influenza_pneumonia")


@register(f"""
SELECT {EPISODE_COLUMNS}, DATE '{CURRENT[0]}' AS RPSD, DATE '{CURRENT[1]}' AS RPED, DATE '{CURRENT[2]}' AS RP_month_start FROM {{ck_cohort}}""")
def cohort_all(t: Tables) -> DataFrame:
    return _flat(cohort.select_cohort(
        b.episodes(t), b.PERIOD.start, b.PERIOD.end, b.PERIOD.month_start
    ))
