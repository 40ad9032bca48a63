"""Small fixed lookups as relations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith import constants as c


def inline_table(
    spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[str]]
) -> DataFrame:
    """A few rows of text as a relation whose size the optimiser knows."""
    values = [list(row) for row in rows]
    if not values:
        return spark.createDataFrame([], ", ".join(f"{name} string" for name in columns))
    texts = {f"t{r}_{i}": text for r, row in enumerate(values) for i, text in enumerate(row)}
    body = ", ".join(
        "(" + ", ".join(f":t{r}_{i}" for i in range(len(columns))) + ")" for r in range(len(values))
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS rows({', '.join(columns)})", args=texts)


def attribute_mapping(spark: SparkSession) -> DataFrame:
    """Indicator and attribute identifiers with their descriptions."""
    columns = ["Indicator_description", "Indicator", "Attribute_description", "Attribute_ID"]
    return inline_table(spark, columns, c.ATTRIBUTES)


def attribute_codes(mapping: DataFrame) -> DataFrame:
    """Indicator of each attribute, once per pair although some pairs have two descriptions."""
    return mapping.select(
        F.col("Indicator").alias("DATA_REFERENCE_IDENTIFIER"),
        F.col("Attribute_ID").alias("ATTRIBUTE_IDENTIFIER"),
    ).distinct()


def with_attribute_ids(
    rows: DataFrame, mapping: DataFrame, description: str = "FRIENDLY_IDENTIFIER"
) -> DataFrame:
    """Identifiers looked up by description, or a fixed text where there are none."""
    codes = mapping.select(
        F.col("Attribute_description").alias(description),
        F.col("Indicator").alias("DATA_REFERENCE_IDENTIFIER"),
        F.col("Attribute_ID").alias("ATTRIBUTE_IDENTIFIER"),
    ).dropDuplicates([description])
    found = rows.join(codes, description, "left")
    return found.withColumns({
        name: F.coalesce(name, F.lit(c.ATTRIBUTE_MISSING))
        for name in ("DATA_REFERENCE_IDENTIFIER", "ATTRIBUTE_IDENTIFIER")
    })


def code_relation(spark: SparkSession, codes: list[str]) -> DataFrame:
    """A code list of the rules as a relation."""
    return inline_table(spark, ["code"], [[code] for code in codes])
