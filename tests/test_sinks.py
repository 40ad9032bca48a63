"""Sinks with missing dates and number-like identifiers."""

from ratesmith.operators.publish import replace_by_key
from ratesmith.sources import sinks
import pytest

SCHEMA = "ORG_ID string, ACHIEVEMENT_DATE date, DATA_REFERENCE_IDENTIFIER string, ATTRIBUTE_IDENTIFIER string, ATTRIBUTE_VALUE string"
TABLE = "SELECT * FROM VALUES ('A', DATE'2020-01-31', 'r', 'a', '1'), ('B', CAST(NULL AS DATE), 'r', 'a', '2'), ('D', DATE'2020-02-29', 'r', 'a', '4')"
NAMES = " AS t(ORG_ID, ACHIEVEMENT_DATE, DATA_REFERENCE_IDENTIFIER, ATTRIBUTE_IDENTIFIER, ATTRIBUTE_VALUE)"
BATCHES = [
    "SELECT * FROM VALUES ('C', CAST(NULL AS DATE), 'r', 'a', '9')",
    "SELECT * FROM VALUES ('C', CAST(NULL AS DATE), 'r', 'a', '9'), ('A', DATE'2020-01-31', 'r', 'a', '7')",
    "SELECT * FROM VALUES ('A', DATE'2020-01-31', 'r', 'a', '7')",
]


@pytest.mark.parametrize("batch", BATCHES)
def test_update_is_the_operator(spark, tmp_path, rows, batch):
    table, new, target = spark.sql(TABLE + NAMES), spark.sql(batch + NAMES), str(tmp_path / "t")
    sinks.start_published(table, target)
    sinks.update_published(new, target)
    names = table.columns
    assert rows(sinks.read_published(spark, target), *names) == rows(replace_by_key(table, new), *names)


def test_routed_identifiers_keep_their_zeros(spark, tmp_path):
    landing = spark.createDataFrame([("0012", 1), ("7", 2)], "DATA_REFERENCE_IDENTIFIER string, v int")
    sinks.route(landing, str(tmp_path / "r"))
    found = sinks.read_routed(spark, str(tmp_path / "r"), "0012").collect()
    assert [(r.DATA_REFERENCE_IDENTIFIER, r.v) for r in found] == [("0012", 1)]
