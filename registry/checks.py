"""Quality checks and table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.operators import audit, diff, quality
from ratesmith.sources.workspace import staged
from registry.catalogue import register
from registry.views import Tables

_NUM, _DEN = "'767390F9-FD7E-4B01-A8AE-82B41DE00A02'", "'FB4D2185-044E-44A4-9C11-02A0A4034A02'"


def _rounded(trend: DataFrame, *columns: str) -> DataFrame:
    return trend.withColumns({name: F.round(name, 6) for name in columns})


@register("""
SELECT ACHIEVEMENT_DATE, ORG_ID, COUNT(*) AS INDICATOR_COUNT, COUNT(*) <> 2 AS breach FROM {fx_late_batch} GROUP BY 1, 2
UNION ALL SELECT ACHIEVEMENT_DATE, ORG_ID, COUNT(*), COUNT(*) <> 2 FROM {fx_published_second} GROUP BY 1, 2""")
def dq_indicator_count(t: Tables) -> DataFrame:
    """Two attributes per organisation and month: true of one table, not of the other."""
    good = quality.attribute_count(t["fx_late_batch"], 2)
    return good.unionByName(quality.attribute_count(t["fx_published_second"], 2))


_RATIO = f"""
SELECT ORG_ID, ACHIEVEMENT_DATE, CAST(SUM(CASE WHEN ATTRIBUTE_IDENTIFIER = {_NUM} THEN CAST(ATTRIBUTE_VALUE AS BIGINT) END) AS BIGINT) AS numerator,
 CAST(SUM(CASE WHEN ATTRIBUTE_IDENTIFIER = {_DEN} THEN CAST(ATTRIBUTE_VALUE AS BIGINT) END) AS BIGINT) AS denominator FROM {{fx_published}} GROUP BY 1, 2"""


@register(f"SELECT *, ROUND(numerator / NULLIF(denominator, 0) * 100, 6) AS perc_of_denominator, numerator > denominator AS breach FROM ({_RATIO}) r")
def dq_pivot_ratio(t: Tables) -> DataFrame:
    share = quality.numerator_share(t["fx_published"], c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR)
    return _rounded(share, "perc_of_denominator")


_CHANGE = (
    "CASE WHEN {p} IS NULL THEN 0.0 ELSE ROUND(CAST({v} - {p} AS DOUBLE) * 100 / NULLIF({p}, 0), 6) END"
)


@register(f"""
SELECT ACHIEVEMENT_DATE, TOTAL_PRAC_COUNT, prev_month_value, ACHIEVEMENT_DATE = MAX(ACHIEVEMENT_DATE) OVER () AS is_latest,
 {_CHANGE.format(v='TOTAL_PRAC_COUNT', p='prev_month_value')} AS perc_change,
 ACHIEVEMENT_DATE = MAX(ACHIEVEMENT_DATE) OVER () AND NOT ({_CHANGE.format(v='TOTAL_PRAC_COUNT', p='prev_month_value')} BETWEEN -0.999999999 AND 0.999999999) AS breach
FROM (SELECT *, LAG(TOTAL_PRAC_COUNT) OVER (ORDER BY ACHIEVEMENT_DATE) AS prev_month_value
 FROM (SELECT ACHIEVEMENT_DATE, COUNT(DISTINCT ORG_ID) AS TOTAL_PRAC_COUNT FROM {{fx_published}} GROUP BY 1) a) x""")
def dq_org_count(t: Tables) -> DataFrame:
    return _rounded(quality.organisation_count(t["fx_published"]), "perc_change")


@register(f"""
SELECT ACHIEVEMENT_DATE, TOTAL_ATTRIBUTE_VALUE, prev_month_value, {_CHANGE.format(v='TOTAL_ATTRIBUTE_VALUE', p='prev_month_value')} AS perc_change,
 EXTRACT(month FROM ACHIEVEMENT_DATE) <> 4 AND {_CHANGE.format(v='TOTAL_ATTRIBUTE_VALUE', p='prev_month_value')} <= 0 AS breach
FROM (SELECT *, LAG(TOTAL_ATTRIBUTE_VALUE) OVER (ORDER BY ACHIEVEMENT_DATE) AS prev_month_value
 FROM (SELECT ACHIEVEMENT_DATE, CAST(SUM(CAST(ATTRIBUTE_VALUE AS BIGINT)) AS BIGINT) AS TOTAL_ATTRIBUTE_VALUE FROM {{fx_published}} WHERE ATTRIBUTE_IDENTIFIER = {_NUM} GROUP BY 1) a) x""")
def dq_month_total(t: Tables) -> DataFrame:
    return _rounded(quality.month_total(t["fx_published"], c.WAITS_NUMERATOR), "perc_change")


def _org_check(attribute: str, total: str, previous: str, change: str) -> str:
    return f"""
SELECT ORG_ID, ACHIEVEMENT_DATE, {total}, CAST(COALESCE({previous}, 0) AS BIGINT) AS {previous},
 COALESCE(ROUND(CAST({total} - {previous} AS DOUBLE) * 100 / NULLIF({previous}, 0), 6), 0.0) AS {change}
FROM (SELECT *, LAG({total}) OVER (PARTITION BY ORG_ID ORDER BY ACHIEVEMENT_DATE) AS {previous}
 FROM (SELECT ORG_ID, ACHIEVEMENT_DATE, CAST(SUM(CAST(ATTRIBUTE_VALUE AS BIGINT)) AS BIGINT) AS {total} FROM {{fx_published}} WHERE ATTRIBUTE_IDENTIFIER = {attribute} GROUP BY 1, 2) a) x"""


_ORG_TOTAL = _org_check(_NUM, "TOTAL_ATTRIBUTE_VALUE", "prev_month_value", "perc_change")
_ORG_POPULATION = _org_check(_DEN, "TOTAL_POPULATION", "prev_population", "pop_perc_change")


@register(f"SELECT *, perc_change < 0 AS breach FROM ({_ORG_TOTAL}) o")
def dq_org_total(t: Tables) -> DataFrame:
    trend = quality.organisation_total(t["fx_published"], c.WAITS_NUMERATOR)
    return _rounded(trend, "perc_change")


@register(f"""
SELECT o.*, p.TOTAL_POPULATION, p.prev_population, p.pop_perc_change, o.perc_change < 0 AND p.pop_perc_change >= 5 AS breach
FROM ({_ORG_TOTAL}) o JOIN ({_ORG_POPULATION}) p ON p.ORG_ID = o.ORG_ID AND p.ACHIEVEMENT_DATE = o.ACHIEVEMENT_DATE""")
def dq_org_total_population(t: Tables) -> DataFrame:
    """Falls of the numerator, reported only where the denominator rose."""
    trend = quality.organisation_total_with_population(
        t["fx_published"], c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR
    )
    return _rounded(trend, "perc_change", "pop_perc_change")


@register(f"""
SELECT 'ratio' AS "check", COUNT(*) AS offenders, COUNT(*) = 0 AS passed FROM ({_RATIO}) r WHERE numerator > denominator
UNION ALL SELECT 'organisation total', COUNT(*), COUNT(*) = 0 FROM ({_ORG_TOTAL}) o WHERE perc_change < 0
UNION ALL SELECT 'indicator count', COUNT(*), COUNT(*) = 0 FROM (SELECT ORG_ID FROM {{fx_published}} GROUP BY ORG_ID, ACHIEVEMENT_DATE HAVING COUNT(*) <> 2) i""")
def dq_summary(t: Tables) -> DataFrame:
    """One row per check with its number of offenders."""
    rows = t["fx_published"]
    return quality.summary({
        "ratio": quality.breaches(
            quality.numerator_share(rows, c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR)
        ),
        "organisation total": quality.breaches(
            quality.organisation_total(rows, c.WAITS_NUMERATOR)
        ),
        "indicator count": quality.breaches(quality.attribute_count(rows, 2)),
    })


_AUDIT = [
    audit.attributes("attributes", 2),
    audit.share("share", c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR),
    audit.organisations("organisations"),
    audit.month_total("month total", c.WAITS_NUMERATOR),
    audit.month_total("month total, denominator", c.WAITS_DENOMINATOR),
    audit.organisation_total("organisation total", c.WAITS_NUMERATOR),
    audit.organisation_total_with_population(
        "organisation total, population", c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR),
]
_MONTHS = """
SELECT ACHIEVEMENT_DATE, v, p, CASE WHEN p IS NULL THEN 0.0 ELSE ROUND(CAST(v - p AS DOUBLE) * 100 / NULLIF(p, 0), 6) END AS change,
 ACHIEVEMENT_DATE = MAX(ACHIEVEMENT_DATE) OVER () AS latest
FROM (SELECT *, LAG(v) OVER (ORDER BY ACHIEVEMENT_DATE) AS p FROM (SELECT ACHIEVEMENT_DATE, {value} AS v FROM {{fx_published}} {where} GROUP BY 1) a) x"""
_MONTH_SUM = "CAST(SUM(CAST(ATTRIBUTE_VALUE AS BIGINT)) AS BIGINT)"


def _month_audit(name: str, attribute: str) -> str:
    months = _MONTHS.format(value=_MONTH_SUM, where=f"WHERE ATTRIBUTE_IDENTIFIER = {attribute}")
    return (f"SELECT '{name}', NULL, ACHIEVEMENT_DATE, v, p, change FROM ({months}) m "
            "WHERE EXTRACT(month FROM ACHIEVEMENT_DATE) <> 4 AND change <= 0")


@register(f"""
SELECT "check", ORG_ID, ACHIEVEMENT_DATE, CAST(value AS DOUBLE) AS value, CAST(compared AS DOUBLE) AS compared, CAST(change AS DOUBLE) AS change FROM (
SELECT 'attributes' AS "check", ORG_ID, ACHIEVEMENT_DATE, COUNT(*) AS value, 2 AS compared, CAST(NULL AS DOUBLE) AS change FROM {{fx_published_second}} GROUP BY 2, 3 HAVING COUNT(*) <> 2
UNION ALL SELECT 'share', ORG_ID, ACHIEVEMENT_DATE, numerator, denominator, ROUND(numerator / NULLIF(denominator, 0) * 100, 6) FROM ({_RATIO}) r WHERE numerator > denominator
UNION ALL SELECT 'organisations', NULL, ACHIEVEMENT_DATE, v, p, change FROM ({_MONTHS.format(value='COUNT(DISTINCT ORG_ID)', where='')}) m WHERE latest AND NOT change BETWEEN -0.999999999 AND 0.999999999
UNION ALL {_month_audit('month total', _NUM)} UNION ALL {_month_audit('month total, denominator', _DEN)}
UNION ALL SELECT 'organisation total', ORG_ID, ACHIEVEMENT_DATE, TOTAL_ATTRIBUTE_VALUE, prev_month_value, perc_change FROM ({_ORG_TOTAL}) o WHERE perc_change < 0
UNION ALL SELECT 'organisation total, population', o.ORG_ID, o.ACHIEVEMENT_DATE, TOTAL_ATTRIBUTE_VALUE, prev_month_value, perc_change FROM ({_ORG_TOTAL}) o
 JOIN ({_ORG_POPULATION}) p ON p.ORG_ID = o.ORG_ID AND p.ACHIEVEMENT_DATE = o.ACHIEVEMENT_DATE WHERE perc_change < 0 AND pop_perc_change >= 5) z""".replace(
    "{fx_published}", "{fx_published_second}"))
def dq_audit(t: Tables) -> DataFrame:
    """Offending rows of seven checks from one pass over a table with a third attribute."""
    cells = staged(audit.cells(t["fx_published_second"], _AUDIT), "check_cells")
    return _rounded(audit.offenders(cells, _AUDIT), "change")


_COLUMNS = "ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER, ATTRIBUTE_VALUE, ATTRIBUTE_TYPE"


def _diff_check(left: str, right: str, columns: str = _COLUMNS) -> str:
    return f"""
SELECT {columns}, CAST(SUM(l) AS BIGINT) AS left_rows, CAST(SUM(r) AS BIGINT) AS right_rows
FROM (SELECT {columns}, 1 AS l, 0 AS r FROM ({left}) a UNION ALL SELECT {columns}, 0, 1 FROM ({right}) b) x
GROUP BY {columns} HAVING SUM(l) <> SUM(r)"""


@register(_diff_check(
    "SELECT * FROM {fx_published}",
    "SELECT * FROM {fx_published_second} WHERE ATTRIBUTE_IDENTIFIER <> 'd4909566-9bc8-11ed-a8fc-0242ac120002'",
))
def dq_tables_match(t: Tables) -> DataFrame:
    """Two published tables compared apart from stamps and the non-standardised rows."""
    left = t["fx_published"].withColumn("CREATED_AT", F.lit("2000-12-05"))
    right = t["fx_published_second"].withColumn("CREATED_AT", F.lit("2001-01-05"))
    return diff.tables_match(left, right, [c.ADMISSIONS_CRUDE])


_LINES = "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM {lineitem}"
_LINES_CHANGED = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 40 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_quantity FROM {lineitem} WHERE l_partkey % 50 <> 3"""


@register(_diff_check(_LINES, _LINES_CHANGED, "l_orderkey, l_linenumber, l_returnflag, l_quantity"))
def diff_exact(t: Tables) -> DataFrame:
    """Every row whose number of copies differs, in tables that hold exact copies."""
    return diff.row_differences(
        t.sql(_LINES), t.sql(_LINES_CHANGED), ignore_columns_order=False
    )


_VALUES = """
SELECT l_orderkey, l_suppkey, CASE WHEN l_partkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 9 = 1 THEN NULL ELSE l_quantity END AS measured FROM {lineitem}"""
_VALUES_CHANGED = """
SELECT CASE WHEN l_partkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 9 = 1 THEN NULL WHEN l_partkey % 90 = 2 THEN l_quantity + 1 ELSE l_quantity END AS measured,
 l_suppkey, l_orderkey FROM {lineitem}"""


@register(_diff_check(_VALUES, _VALUES_CHANGED, "l_orderkey, l_suppkey, measured"))
def diff_unordered(t: Tables) -> DataFrame:
    """Tables with NaN and NULL whose columns stand in different orders."""
    return diff.row_differences(t.sql(_VALUES), t.sql(_VALUES_CHANGED))


@register(f"""
SELECT l_orderkey, measured, CAST(SUM(l) AS BIGINT) AS left_rows, CAST(SUM(r) AS BIGINT) AS right_rows
FROM (SELECT l_orderkey, ROUND(measured) AS measured, 1 AS l, 0 AS r FROM ({_VALUES}) a UNION ALL SELECT l_orderkey, ROUND(measured), 0, 1 FROM ({_VALUES_CHANGED}) b) x
GROUP BY 1, 2 HAVING SUM(l) <> SUM(r) OR isnan(measured)""")
def diff_options(t: Tables) -> DataFrame:
    """Both tables transformed alike, columns in any order, and NaN equal to nothing."""
    return diff.table_differences(
        t.sql(_VALUES), t.sql(_VALUES_CHANGED),
        transforms=[lambda df: df.drop("l_suppkey"), lambda df: df.withColumn("measured", F.round("measured"))],
        ignore_nullable=True, ignore_column_order=True)


_PRICES = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM {orders}"
_PRICES_CHANGED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 71 = 0 THEN 'none' ELSE o_orderpriority END AS o_orderpriority,
 CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 0.0001 WHEN o_orderkey % 61 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM {orders} WHERE o_orderkey % 97 <> 5
UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice FROM {orders} WHERE o_orderkey % 83 = 0"""


@register(f"""
SELECT o_orderkey, left_rows, right_rows, CASE WHEN right_rows > 1 THEN 'repeated key' WHEN right_rows = 0 THEN 'missing'
 ELSE concat_ws(',', CASE WHEN lp <> rp THEN 'o_orderpriority' END, CASE WHEN ABS(lt - rt) > 0.01 THEN 'o_totalprice' END) END AS difference
FROM (SELECT a.o_orderkey, CAST(1 AS BIGINT) AS left_rows, CAST(COUNT(b.o_orderkey) AS BIGINT) AS right_rows, MAX(a.o_orderpriority) AS lp, MAX(b.o_orderpriority) AS rp,
 MAX(a.o_totalprice) AS lt, MAX(b.o_totalprice) AS rt FROM ({_PRICES}) a LEFT JOIN ({_PRICES_CHANGED}) b ON a.o_orderkey = b.o_orderkey GROUP BY 1) x
WHERE right_rows <> 1 OR lp <> rp OR ABS(lt - rt) > 0.01""")
def diff_approx(t: Tables) -> DataFrame:
    """Prices may differ by a cent; keys may be missing or repeated."""
    return diff.approximate_differences(
        t.sql(_PRICES), t.sql(_PRICES_CHANGED), ["o_orderkey"], 0.01
    )


_PAIRS = """
SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_quantity END AS first,
 CASE WHEN l_partkey % 26 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN l_quantity + 0.5 ELSE l_quantity END AS second FROM {lineitem}"""


@register(f"""
SELECT l_orderkey, l_partkey, first, second, 'exact' AS mode FROM ({_PAIRS}) x WHERE first IS DISTINCT FROM second
UNION ALL SELECT l_orderkey, l_partkey, first, second, 'within 0.5' FROM ({_PAIRS}) x WHERE (first IS NULL) <> (second IS NULL) OR ABS(first - second) >= 0.5""")
def diff_columns(t: Tables) -> DataFrame:
    """Rows in which two columns differ, exactly and by a precision."""
    pairs = t.sql(_PAIRS)
    exact = diff.column_differences(pairs, "first", "second").withColumn("mode", F.lit("exact"))
    near = diff.column_differences(pairs, "first", "second", 0.5)
    return exact.unionByName(near.withColumn("mode", F.lit("within 0.5")))


@register("""
SELECT * FROM (VALUES ('l_linenumber', 'int', 'bigint'), ('l_tax', 'double', 'missing'), ('l_note', 'missing', 'string')) f(field, left_type, right_type),
 (SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS r FROM {lineitem}) k""".replace(
    "SELECT * FROM", "SELECT field, left_type, right_type, CASE field WHEN 'l_note' THEN 0 ELSE n END AS left_values, "
    "CASE field WHEN 'l_tax' THEN 0 WHEN 'l_note' THEN r ELSE n END AS right_values FROM", 1))
def diff_schema(t: Tables) -> DataFrame:
    """Fields that differ between two versions of a table, and how many values they hold."""
    lines = t["lineitem"]
    changed = lines.withColumns({
        "l_linenumber": F.col("l_linenumber").cast("bigint"),
        "l_note": F.when(F.col("l_returnflag") == "R", F.lit("returned")),
    }).drop("l_tax")
    return diff.schema_report(lines, changed)


@register("""
SELECT path, left_type, right_type, n AS left_rows, n AS right_rows FROM (VALUES ('line.l_tax', 'double', 'missing'), ('amounts[]', 'double', 'int')) p(path, left_type, right_type), (SELECT COUNT(*) AS n FROM {lineitem}) k""")
def diff_schema_tree(t: Tables) -> DataFrame:
    """Places inside structs and arrays where two versions of a nested table differ."""
    lines = t["lineitem"].select("l_orderkey", F.struct("l_returnflag", "l_tax").alias("line"),
                                 F.array("l_quantity", "l_extendedprice").alias("amounts"))
    changed = lines.withColumn("line", F.col("line").dropFields("l_tax")).withColumn(
        "amounts", F.col("amounts").cast("array<int>"))
    return diff.tree_report(lines, changed)


@register(f"""
SELECT ACHIEVEMENT_DATE, TRUE AS near, TRUE AS near_overall FROM (SELECT DISTINCT ACHIEVEMENT_DATE FROM {{fx_published}}) m""")
def dq_org_count_sketch(t: Tables) -> DataFrame:
    """Organisations per month and in all from sketches, held against exact counts over all rows."""
    rows = t["fx_published"]
    sketches = staged(quality.organisation_sketches(rows), "sketches")
    estimated = quality.organisation_count_from(sketches).select(
        "ACHIEVEMENT_DATE", F.col("TOTAL_PRAC_COUNT").alias("estimate"))
    exact = quality.organisation_count(rows).select("ACHIEVEMENT_DATE", "TOTAL_PRAC_COUNT")
    overall = quality.all_organisations(sketches).select("organisations").scalar()
    distinct = rows.agg(F.count_distinct("ORG_ID").alias("n")).scalar()
    return exact.join(estimated, "ACHIEVEMENT_DATE").select(
        "ACHIEVEMENT_DATE",
        (F.abs(F.col("estimate") - F.col("TOTAL_PRAC_COUNT")) <= 0.05 * F.col("TOTAL_PRAC_COUNT")).alias("near"),
        (F.abs(overall - distinct) <= 0.05 * distinct).alias("near_overall"))
