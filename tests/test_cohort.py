from datetime import date

import pytest

from ratesmith.operators import cohort, filters
from ratesmith.sources import reference

RULES = cohort.CONDITION_RULES


def test_unknown_birth_month_is_dropped(spark, rows):
    df = spark.createDataFrame(
        [(v,) for v in ["012022", "011999", "021987", None, "011900", "011901", "011800"]],
        "MYDOB string")
    kept = filters.drop_listed(df, "MYDOB", ["011900", "011901", "011800"])
    assert rows(kept) == [("011999",), ("012022",), ("021987",)]


def test_range_excludes_nan_and_null(spark, rows):
    values = [1.0, 4.0, 1666.0, 12.0, 15.0, 12.0, 7.0, 10.0, -1.0, 0.1, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "STARTAGE double")
    kept = [r[0] for r in filters.keep_between(df, "STARTAGE", ["0", "120"]).collect()]
    assert sorted(kept) == sorted([1, 4, 12, 15, 12, 7, 10, 0.1])
    with pytest.raises(ValueError):
        filters.keep_between(df, "STARTAGE", [0])


def test_text_codes_match_integer_column(spark, rows):
    df = spark.createDataFrame([(v,) for v in [1, 2, 1, 1, 1, 0, 9, 1]], "SEX bigint")
    kept = filters.keep_listed(df, "SEX", ["1", "2", "2A"])
    assert [r[0] for r in rows(kept)] == [1, 1, 1, 1, 1, 2]


def test_prefix_and_period(spark, rows):
    df = spark.createDataFrame(
        [("O15", date(2000, 4, 1)), ("J45", date(2000, 12, 31)), (None, date(2001, 1, 1))],
        "code string, day date")
    assert rows(filters.drop_prefixed(df, "code", ["O"]), "code") == [("J45",)]
    kept = filters.keep_period(df, "day", "2000-04-01", date(2000, 12, 31))
    assert rows(kept, "code") == [("J45",), ("O15",)]


def matching(spark, name, data, schema):
    df = spark.createDataFrame(data, schema)
    return "".join(sorted(r.id for r in cohort.matching(df, RULES, name).collect()))


DIAGNOSES = "id string, DIAG_3_01 string, DIAG_4_01 string"
ARRAYS = DIAGNOSES + ", DIAG_3_CONCAT array<string>, DIAG_4_CONCAT array<string>"
PROCEDURES = DIAGNOSES + ", OPERTN_3_01 string"


def test_rule_without_exclusions(spark):
    data = [
        ("a", "J45", "J456", ["J45"], ["J456"]),
        ("b", "X99", "X999", ["X99", "J45"], ["X999", "J456"]),
        ("c", "E14", "E148", ["E99", "E67", "E14"], ["E999", "E678", "E148"]),
        ("d", "G40", "G401", ["G40"], ["G401"]),
        ("e", "N13", "N134", ["N13"], ["N134"]),
        ("f", None, None, None, None),
    ]
    assert matching(spark, "no_exclusions_group", data, ARRAYS) == "acd"


def test_rule_influenza_pneumonia(spark):
    data = [
        ("a", "J10", "J100", ["J10"], None), ("b", "J10", "J100", ["J10", "D57"], None),
        ("c", "D57", "D570", ["D57", "J10"], None), ("d", "J18", "J188", ["J18"], None),
        ("e", "J15", "J157", ["J15", "L19", "K23"], None),
        ("f", "J15", "J157", ["J15", "L19", "K23", "D57"], None),
        ("g", None, None, [None], None),
        # a NULL entry and no hit: whether D57 was recorded is unknown
        ("h", "J10", "J100", ["J10", None], None),
    ]
    assert matching(spark, "influenza_pneumonia", data, ARRAYS) == "ade"


def test_rule_copd(spark):
    data = [
        ("a", "J45", None, ["J45"], None), ("b", "J20", None, ["X99", "J45"], None),
        ("c", "J20", None, ["J20", "J11", "J43"], None),
        ("d", "G40", None, ["J20", "J11", "J43"], None),
        ("e", "J20", None, ["J20", "K81", "J47", "Z76"], None),
        ("f", "J47", None, ["J47"], None), ("g", "None", None, ["None"], None),
    ]
    assert matching(spark, "copd", data, ARRAYS) == "cef"


def test_rule_heart_failure(spark):
    data = [
        ("a", "I11", "I110", "F23"), ("b", "I50", "I506", "K01"), ("c", "J81", "J816", "K71"),
        ("d", "J81", "J816", "V19"), ("e", None, None, None), ("f", "I50", "I500", None),
    ]
    assert matching(spark, "congestive_heart_failure", data, PROCEDURES) == "ad"


def test_rule_hypertension(spark):
    data = [
        ("a", "I10", "I100", "F23"), ("b", "I50", "I506", "K44"), ("c", "J81", "J816", "K50"),
        ("d", "I11", "I119", "V19"), ("e", "I10", "I108", "K69"), ("f", None, None, None),
    ]
    assert matching(spark, "hypertension", data, PROCEDURES) == "ad"


def test_rule_cellulitis(spark):
    data = [
        ("a", "L03", "L034", "Z23"), ("b", "L03", "L034", "A12"), ("c", "L08", "L080", "U50"),
        ("d", "L08", "L085", "V19"), ("e", "L08", "L088", "X67"), ("f", "L03", "L088", "S12"),
        ("g", "B11", "L980", "U40"), ("h", None, None, None), ("i", "L08", "L081", "X01"),
        ("j", "L08", "L081", "S43"), ("k", "L03", "L034", "S46"),
    ]
    assert matching(spark, "cellulitis", data, PROCEDURES) == "acegk"


def episode(**changes):
    base = {
        "GPPRAC": "A1", "EPIKEY": 1, "ADMIDATE": date(2000, 5, 1), "ADMIMETH": "21",
        "EPISTAT": "3", "EPIORDER": 1, "EPITYPE": "1", "STARTAGE": 40, "MYDOB": "051960",
        "SEX": "1", "MAINSPEF": "100", "FAE_EMERGENCY": 1, "DIAG_3_01": "J45",
        "DIAG_3_CONCAT": "J45,J45", "DIAG_4_01": "J459", "DIAG_4_CONCAT": "J459",
        "OPERTN_3_01": "Z23",
    }
    return {**base, **changes}


def episodes(spark, *changes):
    from ratesmith.sources.scans import EPISODE_TYPES

    schema = ", ".join(f"{n} {t}" for n, t in EPISODE_TYPES.items())
    data = [tuple(episode(**c)[n] for n in EPISODE_TYPES) for c in changes]
    return spark.createDataFrame(data, schema)


def test_validity_of_episodes(spark, rows):
    table = episodes(
        spark, {"EPIKEY": 1}, {"EPIKEY": 2, "ADMIDATE": date(2001, 1, 1)},
        {"EPIKEY": 3, "STARTAGE": 121}, {"EPIKEY": 4, "SEX": "9"}, {"EPIKEY": 5, "EPISTAT": "1"},
        {"EPIKEY": 6, "EPITYPE": "2"}, {"EPIKEY": 7, "EPIORDER": 2},
        {"EPIKEY": 8, "ADMIMETH": "11"}, {"EPIKEY": 9, "MYDOB": None},
        {"EPIKEY": 10, "MAINSPEF": "501"},
        {"EPIKEY": 11, "STARTAGE": 96, "SEX": "2", "ADMIMETH": "2D"},
    )
    kept = cohort.valid_episodes(table, "2000-04-01", "2000-12-31")
    assert rows(kept, "EPIKEY", "SEX", "STARTAGE") == [(1, "MALE", "40"), (11, "FEMALE", "95+")]


def test_disjunction_equals_union_of_rules(spark, rows):
    table = episodes(
        spark, {"EPIKEY": 1}, {"EPIKEY": 1}, {"EPIKEY": 2, "DIAG_3_01": "X99", "DIAG_4_01": "X999"},
        # two rules at once: kept once
        {"EPIKEY": 3, "DIAG_3_01": "J20", "DIAG_4_01": "J209", "DIAG_3_CONCAT": "J20,J43",
         "DIAG_4_CONCAT": "J209,E101"},
        {"EPIKEY": 4, "DIAG_3_01": "I10", "DIAG_4_01": "I10", "OPERTN_3_01": None},
        {"EPIKEY": 5, "DIAG_3_01": "L03", "DIAG_4_01": "L034", "OPERTN_3_01": None,
         "DIAG_4_CONCAT": "L034,E101"},
    )
    found = cohort.select_cohort(table, "2000-04-01", "2000-12-31", "2000-12-01")
    valid = cohort.valid_episodes(cohort.codes_to_arrays(table), "2000-04-01", "2000-12-31")
    united = None
    for name in RULES:
        part = cohort.matching(valid, RULES, name)
        united = part if united is None else united.unionByName(part)
    assert rows(found.drop("RPSD", "RPED", "RP_month_start")) == rows(united.distinct())
    assert rows(found, "EPIKEY") == [(1,), (3,), (5,)]
    assert found.first().RP_month_start == date(2000, 12, 1)


def test_odd_characters_in_rules_and_relations(spark):
    odd = ["a\\nb", "it's", 'q"`', "?", "${x}"]
    df = spark.createDataFrame([(v, [v]) for v in odd] + [("a\nb", ["a\nb"])], "code string, codes array<string>")
    assert df.where(cohort.Listed(("code",), tuple(odd)).predicate()).count() == len(odd)
    assert df.where(cohort.Overlaps("codes", tuple(odd)).predicate()).count() == len(odd)
    table = reference.inline_table(spark, ["place", "code"], [[str(i), v] for i, v in enumerate(odd)])
    assert {(r.place, r.code) for r in table.collect()} == {(str(i), v) for i, v in enumerate(odd)}


def test_every_list_entry_counts(spark):
    df = spark.range(6)
    assert [r.id for r in filters.keep_listed(df, "id", ["+5", "1.0", " 2", "03", "0.5"]).orderBy("id").collect()] == [1, 2, 3, 5]
    assert [r.id for r in filters.keep_between(df, "id", ["0.5", "3"]).orderBy("id").collect()] == [1, 2, 3]
    assert filters.drop_listed(df, "id", ["x", "01"]).count() == 5
    with pytest.raises(ValueError):
        filters.keep_between(df, "id", ["x", "3"])
