"""Synthetic episode tables of any size, with one row per row of a key table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith.functions import templates as t
from ratesmith.functions.synth import Draws

_CODE = t.any_of("EGHIJLNORX") + t.repeat(t.digit(), 3, 3)
_PROCEDURE = t.any_of("AKSXZ") + t.repeat(t.digit(), 2, 2)


def synthetic_episodes(keys: DataFrame, key: str, practices: int, seed: int = 0) -> DataFrame:
    """Episodes with the columns and types of an episode table, drawn from the key of each row.

    The rows stay where the keys are: no shuffle, and the same values in every run.
    """
    draws = Draws(key, seed=seed)
    first, second = _CODE.column(draws), _CODE.column(draws)
    columns = {
        "GPPRAC": draws.integer(1, practices).cast("string"),
        "EPIKEY": F.col(key).cast("bigint"),
        "ADMIDATE": F.date_add(F.lit("1999-04-01").cast("date"), draws.integer(0, 730)),
        "ADMIMETH": draws.choice(["21", "23", "24", "28", "2A", "2B", "2C", "2D", "11", "12"]),
        "EPISTAT": draws.weighted({"3": 0.9, "1": 0.1}),
        "EPIORDER": draws.weighted({1: 0.8, 2: 0.2}),
        "EPITYPE": draws.weighted({"1": 0.9, "2": 0.1}),
        "STARTAGE": draws.integer(0, 110),
        "MYDOB": F.concat(
            F.lpad(draws.integer(1, 12).cast("string"), 2, "0"),
            draws.integer(1890, 2000).cast("string"),
        ),
        "SEX": draws.weighted({"1": 0.49, "2": 0.49, "9": 0.02}),
        "MAINSPEF": draws.choice(["100", "300", "430", "501", "560", "610", "420"]),
        "FAE_EMERGENCY": draws.weighted({1: 0.7, 0: 0.3}),
        "code_1": first,
        "code_2": second,
        "OPERTN_3_01": F.when(draws.uniform() < 0.9, _PROCEDURE.column(draws)),
    }
    rows = keys.select(*[column.alias(name) for name, column in columns.items()])
    short = [F.substring(name, 1, 3) for name in ("code_1", "code_2")]
    return rows.select(
        "GPPRAC", "EPIKEY", "ADMIDATE", "ADMIMETH", "EPISTAT", "EPIORDER", "EPITYPE",
        "STARTAGE", "MYDOB", "SEX", "MAINSPEF", "FAE_EMERGENCY",
        short[0].alias("DIAG_3_01"),
        F.concat_ws(",", *short).alias("DIAG_3_CONCAT"),
        F.col("code_1").alias("DIAG_4_01"),
        F.concat_ws(",", "code_1", "code_2").alias("DIAG_4_CONCAT"),
        "OPERTN_3_01",
    )
