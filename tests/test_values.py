from datetime import date

from pyspark.sql import functions as F

from ratesmith.functions import bands, values


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_codes_keep_blanks_and_nulls(spark):
    assert one(spark, values.code_set(F.lit("J45,J45, J45,,"))) == ["J45", " J45", ""]
    assert one(spark, values.code_set(F.lit(None).cast("string"))) is None


def test_sex_names(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,), ("9",)], "code string")
    named = [r.v for r in df.select(values.sex_name(F.col("code")).alias("v")).collect()]
    assert named == ["MALE", "FEMALE", "UNKNOWN", "UNKNOWN"]


def test_top_coded_age_is_text(spark):
    df = spark.createDataFrame([(1,), (95,), (100,), (-1,)], "age int")
    coded = [r.v for r in df.select(bands.age_text(F.col("age")).alias("v")).collect()]
    assert coded == ["1", "95+", "95+", "-1"]


def test_dates_in_two_formats(spark):
    df = spark.createDataFrame(
        [("2022-01-01",), ("20220101",), ("2022-13-01",), (None,), ("soon",)], "t string"
    )
    parsed = [r.v for r in df.select(values.parse_date(F.col("t")).alias("v")).collect()]
    assert parsed == [date(2022, 1, 1), date(2022, 1, 1), None, None, None]


def test_suppression(spark):
    given = ["0", "1", "7", "-7", "8", "12", "13", "-8", "1003", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    shown = df.orderBy("i").select(values.suppress_small_count(F.col("v")).alias("s")).collect()
    assert [r.s for r in shown] == ["0", "*", "*", "*", "10", "10", "15", "-10", "1005", "0"]


def test_relabel_passes_others_through(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    out = [r.v for r in df.select(values.relabel(F.col("v"), {"a": "A"}).alias("v")).collect()]
    assert out == ["A", "b", None]
    same = [r.v for r in df.select(values.relabel(F.col("v"), {"a": "a"}).alias("v")).collect()]
    assert same == ["a", "b", None]


def test_large_sums_keep_their_digits(spark):
    assert one(spark, values.whole_number_text(F.lit(12345678.0))) == "12345678"
    assert one(spark, values.whole_number_text(F.lit(2.5))) == "3"


def test_percent_change(spark):
    assert one(spark, values.percent_change(F.lit(110), F.lit(100))) == 10.0
    assert one(spark, values.percent_change(F.lit(1), F.lit(0))) is None


def test_code_expansion():
    codes = values.expand_codes("E", [10, 11], 9)
    assert codes[:2] == ["E100", "E101"] and codes[-1] == "E118" and len(codes) == 18


def test_age_reference(spark, rows):
    table = bands.age_reference(spark)
    assert table.count() == 240
    assert table.select("SEX", "AGE").distinct().count() == 192
    assert table.select("AGE_FIVE_YEAR").distinct().count() == 40
    assert table.select("AGE_TEN_YEAR").distinct().count() == 20
    found = {r.ORIGINAL: tuple(r)[1:] for r in table.collect()}
    assert found["FEMALE_71_72"] == (
        "FEMALE", "71", "FEMALE_71_72", "FEMALE_70_74", "FEMALE_70_79")
    assert found["MALE_119_120"] == ("MALE", "95+", "MALE_95+", "MALE_95+", "MALE_90+")
    assert found["MALE_92_93"] == ("MALE", "92", "MALE_92_93", "MALE_90_94", "MALE_90+")
    assert set(found) == set(bands.age_key_names())
    # the rule on names and the rule on columns agree
    for name, row in found.items():
        parsed = bands.parse_age_key(name)
        assert [bands.band_name(*parsed, width) for width in (1, 5, 10)] == list(row[2:])
    assert sorted({row[3] for row in found.values()}) == sorted(bands.band_names())


def test_unknown_ages_have_no_band(spark):
    df = spark.createDataFrame(
        [("MALE", "7"), ("MALE", "95+"), ("MALE", "96"), ("MALE", "07"), ("UNKNOWN", "7"),
         ("MALE", "-1"), ("MALE", None), (None, "7"), ("FEMALE", "94")], "s string, a string")
    found = [r.b for r in df.select(
        bands.band_of_age_text(F.col("s"), F.col("a")).alias("b")).collect()]
    assert found == ["MALE_5_9", "MALE_95+", None, None, None, None, None, None, "FEMALE_90_94"]
    assert bands.parse_age_key("MALE_120_121") is None
    assert bands.parse_age_key("MALE_3_5") is None
    assert bands.parse_age_key("male_3_4") == ("MALE", 3)
