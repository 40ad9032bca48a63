"""Check-side building blocks in plain SQL, written apart from the engine's own logic."""

from __future__ import annotations

CURRENT = ("2000-04-01", "2000-12-31", "2000-12-01")
BASELINE = ("1999-04-01", "1999-12-31", "1999-12-01")
STANDARD = "2000-04-01"
AT = "2000-12-31"

EPISODE_COLUMNS = (
    "GPPRAC, EPIKEY, ADMIDATE, ADMIMETH, EPISTAT, EPIORDER, EPITYPE, STARTAGE, MYDOB, SEX, MAINSPEF, "
    "FAE_EMERGENCY, DIAG_3_01, DIAG_3_CONCAT, DIAG_4_01, DIAG_4_CONCAT, OPERTN_3_01"
)

BAND = (
    "CASE WHEN {a} >= 95 THEN {s} || '_95+' ELSE {s} || '_' || CAST({a} - {a} % 5 AS VARCHAR) || '_' "
    "|| CAST({a} - {a} % 5 + 4 AS VARCHAR) END"
)
BAND_LIST = (
    "SELECT s.SEX || '_' || CASE WHEN b.lo = 95 THEN '95+' ELSE CAST(b.lo AS VARCHAR) || '_' || "
    "CAST(b.lo + 4 AS VARCHAR) END AS AGE_FIVE_YEAR FROM (VALUES ('MALE'), ('FEMALE')) s(SEX), "
    "(SELECT CAST(unnest(range(0, 100, 5)) AS INT) AS lo) b"
)

_PRIMARY = "(DIAG_3_01 IN ({0}) OR DIAG_4_01 IN ({0}))"
# Fixed code lists.
_CARDIAC = (
    "'K00','K01','K02','K03','K04','K05','K06','K07','K08','K09','K10','K11',"
    "'K12','K13','K14','K15','K16','K17','K18','K19','K20','K21','K22','K23',"
    "'K24','K25','K26','K27','K28','K29','K30','K31','K32','K33','K34','K35',"
    "'K36','K37','K38','K39','K40','K41','K42','K43','K44','K45','K46','K47',"
    "'K48','K49','K50','K52','K55','K56','K57','K60','K61','K66','K67','K68',"
    "'K69','K71'"
)
_DIABETES = (
    "'E100','E101','E102','E103','E104','E105','E106','E107','E108',"
    "'E110','E111','E112','E113','E114','E115','E116','E117','E118',"
    "'E120','E121','E122','E123','E124','E125','E126','E127','E128',"
    "'E130','E131','E132','E133','E134','E135','E136','E137','E138',"
    "'E140','E141','E142','E143','E144','E145','E146','E147','E148'"
)
_SKIN_1 = "'A','B','C','D','E','F','G','H','I','J','K','L','M','N','O','P','Q','R','T','V','W'"
_SKIN_2 = "'S1','S2','S3','X0','X1','X2','X4','X5'"
_SKIN_3 = "'S41','S42','S43','S44','S45','S47','S48','S49'"
_COPD = "'J41','J42','J43','J44','J47'"

_NO_CARDIAC = f"OPERTN_3_01 NOT IN ({_CARDIAC})"
RULES = {
    "no_exclusions_group": _PRIMARY.format(
        "'J45','J46','H66','H67','J02','J03','J06','J312','N10','N11','N12','N136','G40','G41','R56','O15'"
    ) + f" OR list_has_any(string_split(DIAG_4_CONCAT, ','), [{_DIABETES}])",
    "cellulitis": _PRIMARY.format("'L03','L04','L88','L080','L088','L089','L980'")
    + f" AND substr(OPERTN_3_01, 1, 1) NOT IN ({_SKIN_1})"
    f" AND substr(OPERTN_3_01, 1, 2) NOT IN ({_SKIN_2}) AND OPERTN_3_01 NOT IN ({_SKIN_3})",
    "influenza_pneumonia": _PRIMARY.format(
        "'J10','J11','J13','J14','J153','J154','J157','J159','J168','J181','J188'"
    ) + " AND ',' || DIAG_3_CONCAT || ',' NOT LIKE '%,D57,%'",
    "hypertension": _PRIMARY.format("'I10','I119'") + " AND " + _NO_CARDIAC,
    "congestive_heart_failure": _PRIMARY.format("'I50','J81','I110'") + " AND " + _NO_CARDIAC,
    "copd": f"DIAG_3_01 IN ({_COPD}) OR (DIAG_3_01 = 'J20' AND "
    f"list_has_any(string_split(DIAG_3_CONCAT, ','), [{_COPD}]))",
}


def _valid(start: str, end: str) -> str:
    return f"""
SELECT GPPRAC, EPIKEY, ADMIDATE, ADMIMETH, EPISTAT, EPIORDER, EPITYPE,
 CASE WHEN STARTAGE < 95 THEN CAST(STARTAGE AS VARCHAR) ELSE '95+' END AS STARTAGE, MYDOB,
 CASE SEX WHEN '1' THEN 'MALE' ELSE 'FEMALE' END AS SEX, MAINSPEF, FAE_EMERGENCY, DIAG_3_01,
 CASE WHEN split_part(DIAG_3_CONCAT, ',', 1) = split_part(DIAG_3_CONCAT, ',', 2) THEN split_part(DIAG_3_CONCAT, ',', 1) ELSE DIAG_3_CONCAT END AS DIAG_3_CONCAT,
 DIAG_4_01,
 CASE WHEN split_part(DIAG_4_CONCAT, ',', 1) = split_part(DIAG_4_CONCAT, ',', 2) THEN split_part(DIAG_4_CONCAT, ',', 1) ELSE DIAG_4_CONCAT END AS DIAG_4_CONCAT,
 OPERTN_3_01
FROM {{fx_episode_table}}
WHERE ADMIDATE >= DATE '{start}' AND ADMIDATE <= DATE '{end}' AND STARTAGE >= 0 AND STARTAGE <= 120
 AND SEX IN ('1','2') AND EPISTAT = '3' AND EPITYPE = '1' AND EPIORDER = 1
 AND ADMIMETH IN ('21','23','24','28','2A','2B','2C','2D')
 AND MYDOB IS NOT NULL AND MYDOB NOT IN ('011900','011901','011800') AND MAINSPEF NOT IN ('501','560','610')"""


def _cohort(valid: str) -> str:
    branches = " UNION ".join(
        f"SELECT * FROM {{{valid}}} WHERE {condition}" for condition in RULES.values()
    )
    return branches


def _cells(cohort: str) -> str:
    years = "CAST(replace(STARTAGE, '+', '') AS INT)"
    return f"""
SELECT PCN_CODE, {BAND.format(a=years, s='SEX')} AS AGE_FIVE_YEAR, SUM(FAE_EMERGENCY) AS admissions
FROM (SELECT DISTINCT GPPRAC, EPIKEY, STARTAGE, SEX, FAE_EMERGENCY, PCN_CODE FROM {{{cohort}}} JOIN {{ck_mapping}} ON GPPRAC = PRACTICE_CODE) x
GROUP BY 1, 2"""


def _numerator(cells: str, month: str, attribute: str) -> str:
    return f"""
SELECT u.PCN_CODE, u.PCN_NAME, COALESCE(a.admissions, 0) AS admissions, d.eng_population, d.stan_sum,
 d.stan_sum / d.eng_population AS DSR, d.pcn_pop, ROUND(d.pcn_pop * (d.stan_sum / d.eng_population)) AS standardised_admissions,
 100 * (ROUND(d.pcn_pop * (d.stan_sum / d.eng_population)) - COALESCE(a.admissions, 0)) / NULLIF(COALESCE(a.admissions, 0), 0) AS percentage_change,
 '{attribute}' AS ATTRIBUTE_ID
FROM (SELECT DISTINCT PCN_CODE, PCN_NAME FROM {{ck_mapping}}) u
LEFT JOIN (SELECT PCN_CODE, SUM(admissions) AS admissions FROM {{{cells}}} GROUP BY 1) a ON a.PCN_CODE = u.PCN_CODE
LEFT JOIN (
 SELECT l.PCN_CODE, MAX(t.total) AS eng_population, SUM(l.COUNT) AS pcn_pop,
  SUM(CAST(COALESCE(c.admissions, 0) AS DOUBLE) * e.Count / NULLIF(l.COUNT, 0)) AS stan_sum
 FROM {{ck_list_size}} l JOIN {{ck_england}} e ON e.AGE_FIVE_YEAR = l.AGE_FIVE_YEAR
 LEFT JOIN {{{cells}}} c ON c.PCN_CODE = l.PCN_CODE AND c.AGE_FIVE_YEAR = l.AGE_FIVE_YEAR
 CROSS JOIN (SELECT SUM(Count) AS total FROM {{ck_england}}) t
 WHERE l.EXTRACT_DATE = DATE '{month}' GROUP BY 1) d ON d.PCN_CODE = u.PCN_CODE"""


CHECK_VIEWS = {
    "ck_valid": _valid(*CURRENT[:2]),
    "ck_valid_base": _valid(*BASELINE[:2]),
    "ck_cohort": _cohort("ck_valid"),
    "ck_cohort_base": _cohort("ck_valid_base"),
    "ck_mapping": f"""
SELECT PRACTICE_CODE, PCN_CODE, PCN_NAME, RELATIONSHIP_START_DATE, RELATIONSHIP_END_DATE FROM (
 SELECT *, row_number() OVER (PARTITION BY PRACTICE_CODE ORDER BY RELATIONSHIP_START_DATE DESC, PCN_CODE, PCN_NAME, RELATIONSHIP_END_DATE NULLS FIRST) AS rn
 FROM {{fx_mapping_history}}
 WHERE RELATIONSHIP_START_DATE <= DATE '{AT}' AND (RELATIONSHIP_END_DATE >= DATE '{AT}' OR RELATIONSHIP_END_DATE IS NULL)) v WHERE rn = 1""",
    "ck_active_snapshots": """
SELECT * FROM {fx_list_size_snapshots} s WHERE EXISTS (SELECT 1 FROM {fx_practice_register} r
 WHERE r.CODE = s.PRACTICE_CODE AND r.OPEN_DATE <= s.EXTRACT_DATE AND (r.CLOSE_DATE >= s.EXTRACT_DATE OR r.CLOSE_DATE IS NULL)
 AND r.DSS_RECORD_START_DATE <= s.EXTRACT_DATE AND (r.DSS_RECORD_END_DATE >= s.EXTRACT_DATE OR r.DSS_RECORD_END_DATE IS NULL))""",
    "ck_list_size": f"""
SELECT g.PCN_CODE, g.PCN_NAME, g.EXTRACT_DATE, g.AGE_FIVE_YEAR, CAST(COALESCE(SUM(x.val), 0) AS BIGINT) AS COUNT
FROM (SELECT * FROM (SELECT DISTINCT PCN_CODE, PCN_NAME, EXTRACT_DATE FROM {{ck_active_snapshots}} s JOIN {{ck_mapping}} m ON m.PRACTICE_CODE = s.PRACTICE_CODE) p, ({BAND_LIST}) b) g
LEFT JOIN (SELECT m.PCN_CODE, s.EXTRACT_DATE, {BAND.format(a='s.AGE_FROM', s='s.SEX')} AS AGE_FIVE_YEAR, s.val
 FROM {{ck_active_snapshots}} s JOIN {{ck_mapping}} m ON m.PRACTICE_CODE = s.PRACTICE_CODE) x
 ON x.PCN_CODE = g.PCN_CODE AND x.EXTRACT_DATE = g.EXTRACT_DATE AND x.AGE_FIVE_YEAR = g.AGE_FIVE_YEAR
GROUP BY 1, 2, 3, 4""",
    "ck_england": f"""
SELECT b.AGE_FIVE_YEAR, CAST(COALESCE(SUM(x.val), 0) AS BIGINT) AS Count FROM ({BAND_LIST}) b
LEFT JOIN (SELECT {BAND.format(a='AGE_FROM', s='SEX')} AS AGE_FIVE_YEAR, val FROM {{ck_active_snapshots}} WHERE EXTRACT_DATE = DATE '{STANDARD}') x
 ON x.AGE_FIVE_YEAR = b.AGE_FIVE_YEAR GROUP BY 1""",
    "ck_cells": _cells("ck_cohort"),
    "ck_cells_base": _cells("ck_cohort_base"),
    "ck_numerator": _numerator("ck_cells", CURRENT[2], "D3C64D53-20CF-43E7-B15B-1AA8613F7B74"),
    "ck_numerator_base": _numerator(
        "ck_cells_base", BASELINE[2], "0871C126-B4C3-4054-A0C0-2481525A940F"
    ),
    "ck_both_numerators": "SELECT * FROM {ck_numerator} UNION ALL SELECT * FROM {ck_numerator_base}",
    "ck_denominators": f"""
SELECT PCN_CODE, PCN_NAME, AGE_FIVE_YEAR, COUNT, EXTRACT_DATE, CASE WHEN EXTRACT_DATE = DATE '{CURRENT[2]}' THEN 'D388FDB3-E3D7-44F2-80C7-0832B448C9B4' ELSE '88337490-8A59-4C40-8C13-FF0D9D01F48D' END AS Attribute_ID
FROM {{ck_list_size}} WHERE EXTRACT_DATE IN (DATE '{CURRENT[2]}', DATE '{BASELINE[2]}')""",
    "ck_window": f"SELECT * FROM {{fx_appointments}} WHERE appt_date >= DATE '{CURRENT[0]}' AND appt_date <= DATE '{CURRENT[1]}'",
}
