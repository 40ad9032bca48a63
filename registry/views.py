"""The logical tables as views on the given tables.

Each text is valid unchanged in Spark and in the check engine. In braces stand the tables and
views it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from registry.check_views import CHECK_VIEWS

REPORT_DATE = "2000-12-31"

VIEWS = {
    "fx_episodes": """
SELECT CAST(l_suppkey AS VARCHAR(20)) AS GPPRAC,
 l_orderkey*1000003 + l_partkey*11 + l_linenumber AS EPIKEY,
 CAST(l_shipdate AS DATE) AS ADMIDATE,
 split_part('21,23,24,28,2A,2B,2C,2D,11,12', ',', CAST(l_orderkey % 10 AS INT)+1) AS ADMIMETH,
 CASE WHEN l_partkey % 10 = 0 THEN '1' ELSE '3' END AS EPISTAT,
 CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END AS EPIORDER,
 CASE WHEN l_orderkey % 13 = 0 THEN '2' ELSE '1' END AS EPITYPE,
 CAST((l_partkey*7 + l_orderkey) % 126 AS INT) - 2 AS STARTAGE,
 CASE WHEN l_orderkey % 50 = 0 THEN '011900' WHEN l_orderkey % 51 = 0 THEN NULL ELSE '021987' END AS MYDOB,
 split_part('1,2,1,2,9', ',', CAST((l_partkey + l_linenumber) % 5 AS INT)+1) AS SEX,
 split_part('100,300,430,501,560,610,420', ',', CAST(l_partkey % 7 AS INT)+1) AS MAINSPEF,
 CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS FAE_EMERGENCY,
 split_part('J459,J312,N136,G401,E101,E999,L034,L080,L085,I110,I506,J816,J430,J209,I10,I119,J100,J157,J181,X999', ',', CAST((l_orderkey + l_partkey) % 20 AS INT)+1) AS DIAG_4_01,
 split_part('J459,D570,E148,J431,J470,Z760,K359', ',', CAST((l_orderkey*3 + l_linenumber) % 7 AS INT)+1) AS DIAG_4_02,
 CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE split_part('-,A12,K01,K71,S12,S43,X67,X01,U50,V19,Z23', ',', CAST((l_partkey + l_orderkey*2) % 11 AS INT)+1) END AS OPERTN_3_01
FROM {lineitem}""",
    "fx_episode_table": """
SELECT GPPRAC, EPIKEY, ADMIDATE, ADMIMETH, EPISTAT, EPIORDER, EPITYPE, STARTAGE, MYDOB, SEX,
 MAINSPEF, FAE_EMERGENCY, substr(DIAG_4_01, 1, 3) AS DIAG_3_01,
 substr(DIAG_4_01, 1, 3) || ',' || substr(DIAG_4_02, 1, 3) AS DIAG_3_CONCAT,
 DIAG_4_01, DIAG_4_01 || ',' || DIAG_4_02 AS DIAG_4_CONCAT, OPERTN_3_01
FROM {fx_episodes}""",
    "fx_mapping_history": """
SELECT DISTINCT CAST(l_suppkey AS VARCHAR(20)) AS PRACTICE_CODE, CAST(c_nationkey AS VARCHAR(20)) AS PCN_CODE, n_name AS PCN_NAME,
 CAST(o_orderdate AS DATE) AS RELATIONSHIP_START_DATE,
 CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS RELATIONSHIP_END_DATE
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE l_suppkey % 10 <> 9""",
    "fx_list_size_long": """
SELECT CAST(l_suppkey AS VARCHAR(20)) AS PRACTICE_CODE, CASE WHEN l_linenumber % 2 = 1 THEN 'MALE' ELSE 'FEMALE' END AS SEX,
 CAST((l_partkey*7 + l_orderkey) % 120 AS INT) AS AGE_FROM, SUM(CAST(l_quantity AS BIGINT)) AS val FROM {lineitem} GROUP BY 1,2,3""",
    "fx_appointments": """
SELECT CAST(l_suppkey AS VARCHAR(20)) AS gp_code, CAST(l_shipdate AS DATE) AS appt_date, CAST(l_quantity AS BIGINT) AS appt_count,
 split_part('Same Day,1 Day,2 to 7 Days,8 to 14 Days,15 to 21 Days,22 to 28 Days,More than 28 Days', ',', CAST((l_partkey*3 + l_linenumber) % 7 AS INT)+1) AS time_between_booking_and_appt,
 split_part('General Consultation Acute|General Consultation Routine|Unplanned Clinical Activity|Clinical Triage|Walk-in|Home Visit|Care Home Visit|Care Related Encounter but does not fit into any other category|Patient contact during Care Home Round|Group Consultation', '|', CAST(l_orderkey % 10 AS INT)+1) AS national_category,
 split_part('Attended,Seen,DNA,Booked,Unknown,Cancelled', ',', CAST(l_partkey % 6 AS INT)+1) AS appt_status,
 CASE WHEN l_orderkey % 9 = 0 THEN 'Inconsistent Mapping' ELSE 'Care Related Encounter' END AS context_type,
 CASE WHEN l_linenumber % 2 = 0 THEN 'System A' ELSE 'System B' END AS supplier
FROM {lineitem}""",
    "fx_list_size_snapshots": """
SELECT PRACTICE_CODE, SEX, AGE_FROM, CAST('2000-12-01' AS DATE) AS EXTRACT_DATE, val FROM {fx_list_size_long}
UNION ALL SELECT PRACTICE_CODE, SEX, AGE_FROM, CAST('2000-04-01' AS DATE), val + AGE_FROM % 3 FROM {fx_list_size_long}
UNION ALL SELECT PRACTICE_CODE, SEX, AGE_FROM, CAST('1999-12-01' AS DATE), val + AGE_FROM % 5 FROM {fx_list_size_long}""",
    "fx_published": """
WITH m AS (SELECT gp_code, last_day(appt_date) AS d, SUM(appt_count) AS den,
  SUM(CASE WHEN time_between_booking_and_appt IN ('Same Day','1 Day','2 to 7 Days','8 to 14 Days') THEN appt_count ELSE 0 END) AS num
 FROM {fx_appointments} GROUP BY 1,2),
c AS (SELECT gp_code, d, SUM(den) OVER (PARTITION BY gp_code, year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END ORDER BY d) AS cden, SUM(num) OVER (PARTITION BY gp_code, year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END ORDER BY d) AS cnum FROM m)
SELECT gp_code AS ORG_ID, d AS ACHIEVEMENT_DATE, '283A5FDD-D4BA-4DF7-AC70-B59C83285D3E' AS DATA_REFERENCE_IDENTIFIER,
 'FB4D2185-044E-44A4-9C11-02A0A4034A02' AS ATTRIBUTE_IDENTIFIER, CAST(CAST(cden AS BIGINT) AS VARCHAR(20)) AS ATTRIBUTE_VALUE, 'int' AS ATTRIBUTE_TYPE FROM c
UNION ALL
SELECT gp_code, d, '283A5FDD-D4BA-4DF7-AC70-B59C83285D3E', '767390F9-FD7E-4B01-A8AE-82B41DE00A02',
 CAST(CAST(CASE WHEN gp_code = '7' AND d = DATE '2000-11-30' THEN 1 WHEN gp_code = '3' AND d = DATE '2001-03-31' THEN cden + 10 ELSE cnum END AS BIGINT) AS VARCHAR(20)), 'int' FROM c""",
    "fx_published_second": """
SELECT ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER,
 CASE WHEN ORG_ID = '5' AND ACHIEVEMENT_DATE = DATE '2000-06-30' THEN '0' ELSE ATTRIBUTE_VALUE END AS ATTRIBUTE_VALUE, ATTRIBUTE_TYPE
FROM {fx_published}
UNION ALL SELECT ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, 'd4909566-9bc8-11ed-a8fc-0242ac120002', ATTRIBUTE_VALUE, ATTRIBUTE_TYPE
FROM {fx_published} WHERE ATTRIBUTE_IDENTIFIER = '767390F9-FD7E-4B01-A8AE-82B41DE00A02'""",
    "fx_late_batch": """
SELECT CASE WHEN CAST(ORG_ID AS INT) % 20 = 4 THEN 'N' || ORG_ID ELSE ORG_ID END AS ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER,
 ATTRIBUTE_IDENTIFIER, CAST(CAST(ATTRIBUTE_VALUE AS BIGINT) + 1 AS VARCHAR(20)) AS ATTRIBUTE_VALUE, ATTRIBUTE_TYPE
FROM {fx_published} WHERE ACHIEVEMENT_DATE >= DATE '2001-02-01'""",
    "fx_practice_register": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS CODE, CASE WHEN s_suppkey % 17 = 0 THEN DATE '2001-01-01' ELSE DATE '1990-04-01' END AS OPEN_DATE,
 CASE WHEN s_suppkey % 13 = 0 THEN DATE '1999-06-30' ELSE CAST(NULL AS DATE) END AS CLOSE_DATE, DATE '1990-04-01' AS DSS_RECORD_START_DATE,
 CASE WHEN s_suppkey % 11 = 0 THEN DATE '2000-06-30' ELSE CAST(NULL AS DATE) END AS DSS_RECORD_END_DATE FROM {supplier}
UNION ALL SELECT CAST(s_suppkey AS VARCHAR(20)), DATE '1990-04-01', CAST(NULL AS DATE), DATE '1995-04-01', CAST(NULL AS DATE) FROM {supplier} WHERE s_suppkey % 19 = 0""",
    "fx_org": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS organisationID, s_name AS Name, CASE WHEN s_suppkey % 23 = 0 THEN 'Legal' ELSE 'Operational' END AS datetype FROM {supplier}
UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR(20)), n_name, 'Operational' FROM {nation}""",
    "fx_org_role": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS organisationID, CASE WHEN s_suppkey % 2 = 0 THEN 'RO76' WHEN s_suppkey % 7 = 0 THEN 'RO999' ELSE 'RO177' END AS roleID, 1 AS primaryRole, 'Operational' AS datetype FROM {supplier}
UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR(20)), 'RO272', CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END, 'Operational' FROM {nation}""",
    "fx_org_code": """
SELECT 'RO76' AS ID, 'GP PRACTICE' AS displayname UNION ALL SELECT 'RO177', 'PRESCRIBING COST CENTRE' UNION ALL SELECT 'RO999', 'OTHER'
UNION ALL SELECT 'RO272', 'PRIMARY CARE NETWORK' UNION ALL SELECT 'RE8', 'IS PARTNER TO' UNION ALL SELECT 'RE4', 'IS COMMISSIONED BY'""",
    "fx_org_relationship": """
SELECT PRACTICE_CODE AS organisationID, 'N' || PCN_CODE AS targetOrganisationID,
 CASE WHEN PCN_CODE IN ('3','13') THEN 'RE4' ELSE 'RE8' END AS relationshipID, RELATIONSHIP_START_DATE AS StartDate, RELATIONSHIP_END_DATE AS EndDate FROM {fx_mapping_history}""",
}

_NAME = re.compile(r"\{(\w+)\}")


def inputs_of(text: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(text)))


class Tables:
    """The given tables of one folder and the logical tables on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.sql(VIEWS[name])
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Result of a text whose inputs stand in braces."""
        return self.spark.sql(text, **{name: self[name] for name in inputs_of(text)})


def check_sql(text: str) -> str:
    """A text with braces as one statement for the check engine, its views as CTEs."""
    texts = {**VIEWS, **CHECK_VIEWS}
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in texts and name not in ordered:
            for source in inputs_of(texts[name]):
                add(source)
            ordered.append(name)

    for name in inputs_of(text):
        add(name)
    ctes = [f"{name} AS ({_NAME.sub(r'\1', texts[name])})" for name in ordered]
    body = _NAME.sub(r"\1", text).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
