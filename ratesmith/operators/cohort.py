"""Rule-driven selection of event cohorts.

A rule is plain data made of the small vocabulary below and reads as one predicate. All
rules of a cohort become one disjunction, so the episodes are scanned once: a row belongs to the
union of the rules' rows exactly if the disjunction is true, also where some rules are NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.functions.bands import age_text
from ratesmith.functions.period import as_date
from ratesmith.functions.values import code_set, sex_name
from ratesmith.operators.filters import drop_listed, keep_between, keep_listed, keep_period


@dataclass(frozen=True)
class Listed:
    """The value of any of the columns, or its first `length` characters, is in the list."""

    columns: tuple[str, ...]
    codes: tuple[str, ...]
    length: int | None = None

    def predicate(self) -> Column:
        values = [
            F.col(name) if self.length is None else F.substring(name, 1, self.length)
            for name in self.columns
        ]
        return reduce(or_, [value.isin(list(self.codes)) for value in values])


@dataclass(frozen=True)
class Overlaps:
    """Some entry of an array column is in the list."""

    array: str
    codes: tuple[str, ...]

    def predicate(self) -> Column:
        return F.arrays_overlap(self.array, F.array(*map(F.lit, self.codes)))


@dataclass(frozen=True)
class Every:
    parts: tuple

    def predicate(self) -> Column:
        return reduce(and_, [part.predicate() for part in self.parts])


@dataclass(frozen=True)
class Some:
    parts: tuple

    def predicate(self) -> Column:
        return reduce(or_, [part.predicate() for part in self.parts])


@dataclass(frozen=True)
class Without:
    part: object

    def predicate(self) -> Column:
        return ~self.part.predicate()


MAIN_DIAGNOSIS = ("DIAG_3_01", "DIAG_4_01")
PROCEDURE = ("OPERTN_3_01",)


def _main(codes: list[str], columns: tuple[str, ...] = MAIN_DIAGNOSIS) -> Listed:
    return Listed(columns, tuple(codes))


def _no_procedure(codes: list[str], length: int | None = None) -> Without:
    return Without(Listed(PROCEDURE, tuple(codes), length))


CONDITION_RULES: Mapping[str, object] = {
    "no_exclusions_group": Some((
        _main(c.NO_EXCLUSION_CODES),
        Overlaps("DIAG_4_CONCAT", tuple(c.DIABETES_CODES)),
    )),
    "cellulitis": Every((
        _main(c.CELLULITIS_CODES),
        _no_procedure(c.SKIN_PROCEDURES_1, 1),
        _no_procedure(c.SKIN_PROCEDURES_2, 2),
        _no_procedure(c.SKIN_PROCEDURES_3),
    )),
    "influenza_pneumonia": Every((
        _main(c.FLU_PNEUMONIA_CODES),
        Without(Overlaps("DIAG_3_CONCAT", tuple(c.SICKLE_CELL))),
    )),
    "hypertension": Every((_main(c.HYPERTENSION_CODES), _no_procedure(c.CARDIAC_PROCEDURES))),
    "congestive_heart_failure": Every((
        _main(c.HEART_FAILURE_CODES),
        _no_procedure(c.CARDIAC_PROCEDURES),
    )),
    "copd": Some((
        _main(c.COPD_CODES, ("DIAG_3_01",)),
        Every((
            _main(c.COPD_TRIGGER, ("DIAG_3_01",)),
            Overlaps("DIAG_3_CONCAT", tuple(c.COPD_CODES)),
        )),
    )),
}


def codes_to_arrays(episodes: DataFrame) -> DataFrame:
    """The two concatenated code lists as arrays of distinct codes."""
    return episodes.withColumns(
        {name: code_set(F.col(name)) for name in ("DIAG_3_CONCAT", "DIAG_4_CONCAT")}
    )


def valid_episodes(episodes: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Finished first emergency episodes of the period, with sex named and age top-coded."""
    kept = keep_period(episodes, "ADMIDATE", start, end)
    kept = keep_between(kept, "STARTAGE", c.AGE_LIMITS)
    for column, values in {
        "SEX": c.SEX_CODES,
        "EPISTAT": c.FINISHED_STATUS,
        "EPITYPE": c.ORDINARY_TYPE,
        "EPIORDER": c.FIRST_EPISODE,
        "ADMIMETH": c.EMERGENCY_METHODS,
    }.items():
        kept = keep_listed(kept, column, values)
    kept = drop_listed(kept, "MYDOB", c.INVALID_BIRTH_MONTHS)
    kept = drop_listed(kept, "MAINSPEF", c.EXCLUDED_SPECIALTIES)
    return kept.withColumns(
        {"SEX": sex_name(F.col("SEX")), "STARTAGE": age_text(F.col("STARTAGE"))}
    )


def matching(episodes: DataFrame, rules: Mapping[str, object], name: str) -> DataFrame:
    """Rows of one named rule."""
    return episodes.where(rules[name].predicate())


def matching_any(episodes: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Rows of at least one rule, in a single scan."""
    return episodes.where(Some(tuple(rules.values())).predicate())


def cohort_rows(
    episodes: DataFrame,
    start: date | str,
    end: date | str,
    month_start: date | str,
    rules: Mapping[str, object] = CONDITION_RULES,
) -> DataFrame:
    """Valid episodes that satisfy some rule, stamped with their period; copies are kept.

    Enough for counts that de-duplicate on their own, and free of shuffles.
    """
    valid = valid_episodes(codes_to_arrays(episodes), start, end)
    return matching_any(valid, rules).withColumns({
        "RPSD": F.lit(as_date(start)),
        "RPED": F.lit(as_date(end)),
        "RP_month_start": F.lit(as_date(month_start)),
    })


def select_cohort(
    episodes: DataFrame,
    start: date | str,
    end: date | str,
    month_start: date | str,
    rules: Mapping[str, object] = CONDITION_RULES,
) -> DataFrame:
    """Distinct rows of the cohort.

    The full rows are the grouping key, so a practice with very many episodes is spread over
    all tasks and exact copies collapse before the shuffle.
    """
    return cohort_rows(episodes, start, end, month_start, rules).dropDuplicates()
