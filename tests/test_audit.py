"""Checks in one pass give the rows of the single checks."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import audit, quality

SCHEMA = "ORG_ID string, ACHIEVEMENT_DATE date, ATTRIBUTE_IDENTIFIER string, ATTRIBUTE_VALUE string"
CHECKS = [
    audit.attributes("attributes", 2),
    audit.share("share", "num", "den"),
    audit.organisations("organisations", 5.0),
    audit.month_total("month num", "num"),
    audit.month_total("month other", "other"),
    audit.organisation_total("org num", "num"),
    audit.organisation_total_with_population("org num den", "num", "den", 2.0),
    audit.organisation_total_with_population("org other den", "other", "den", 2.0),
]


def single(data):
    """The same checks one by one, in the common columns."""
    b = quality.breaches
    total, previous, change = "TOTAL_ATTRIBUTE_VALUE", "prev_month_value", "perc_change"
    none = F.lit(None)
    parts = [
        ("attributes", b(quality.attribute_count(data, 2)), F.col("ORG_ID"), "INDICATOR_COUNT", F.lit(2), none),
        ("share", b(quality.numerator_share(data, "num", "den")), F.col("ORG_ID"), "numerator",
         F.col("denominator"), F.col("perc_of_denominator")),
        ("organisations", b(quality.organisation_count(data, 5.0)), none, "TOTAL_PRAC_COUNT",
         F.col(previous), F.col(change)),
    ]
    parts += [(name, b(quality.month_total(data, a)), none, total, F.col(previous), F.col(change))
              for name, a in (("month num", "num"), ("month other", "other"))]
    parts.append(("org num", b(quality.organisation_total(data, "num")), F.col("ORG_ID"), total,
                  F.col(previous), F.col(change)))
    parts += [(name, b(quality.organisation_total_with_population(data, a, "den", 2.0)), F.col("ORG_ID"), total,
               F.col(previous), F.col(change)) for name, a in (("org num den", "num"), ("org other den", "other"))]
    found = []
    for name, frame, org, value, compared, moved in parts:
        found += [(name, *row) for row in frame.select(
            org.cast("string"), "ACHIEVEMENT_DATE", F.col(value).cast("double"), compared.cast("double"),
            moved.cast("double")).collect()]
    return sorted(found, key=repr)


def random_rows(seed):
    draw = random.Random(seed)
    months = [date(2000, m, 28) for m in range(1, 13)] + [None]
    orgs = [*"ABCDEFG", None]
    return [(org, month, attribute, draw.choice(["0", "5", "*", None, str(draw.randint(0, 40)), str(draw.randint(0, 40))]))
            for org in orgs for month in months for attribute in ("num", "den", "other", None)
            for _ in range(draw.choice([0, 1, 1, 1, 2]))]


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_gives_the_rows_of_single_checks(spark, seed):
    data = spark.createDataFrame(random_rows(seed), SCHEMA).cache()
    found = audit.offenders(audit.cells(data, CHECKS), CHECKS)
    assert found.schema.simpleString() == spark.createDataFrame([], audit.OFFENDER).schema.simpleString()
    assert sorted(map(tuple, found.collect()), key=repr) == single(data)
    assert {row[0] for row in single(data)} >= {"attributes", "share", "month num", "org num", "org num den"}


def test_a_pass_reads_the_table_once(spark, tmp_path):
    spark.createDataFrame(random_rows(1), SCHEMA).write.parquet(str(tmp_path / "t"))
    cells = audit.cells(spark.read.parquet(str(tmp_path / "t")), CHECKS)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_sum" in plan


def test_summary_lists_checks_without_offenders(spark, rows):
    data = spark.createDataFrame([("A", date(2000, 1, 31), "num", "1"), ("A", date(2000, 1, 31), "den", "2")], SCHEMA)
    checks = [audit.attributes("two", 2), audit.attributes("three", 3)]
    found = audit.offenders(audit.cells(data, checks), checks)
    assert rows(audit.summary(found, ["two", "three"])) == [("three", 1, False), ("two", 0, True)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audit.offenders(audit.cells(empty, CHECKS), CHECKS).count() == 0
    assert audit.offenders(audit.cells(empty, []), []).count() == 0


def test_rows_of_other_checks(spark, rows):
    mapping = spark.createDataFrame([("P", 2)], "PRACTICE_CODE string, mappings long")
    found = audit.as_offenders("mapping", mapping, "PRACTICE_CODE", "mappings")
    assert rows(found) == [("mapping", "P", None, 2.0, None, None)]
