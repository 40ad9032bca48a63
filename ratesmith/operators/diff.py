"""Comparison of tables as distributed jobs that return the differences.

Exact comparison stacks both sides and adds them up per row value, so equal rows meet by hash and
copies collapse before the shuffle. Approximate comparison adds up numbers per key, row counts and
two 64-bit hashes, in which equal rows cancel, and fetches values only for the keys that are left.
Nothing is collected. No result rows means equal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratesmith.sources.reference import inline_table


class SchemaMismatch(ValueError):
    """The two tables cannot be compared row by row."""


class DifferencesFound(AssertionError):
    """Two tables that should be equal are not."""


def assert_none(differences: DataFrame, shown: int = 20) -> None:
    """Fail if a comparison found anything, and show some of it."""
    found = differences.take(shown)
    if found:
        raise DifferencesFound("\n".join(map(str, found)))


def _plain(dtype: T.DataType) -> str:
    """Type text without nullability."""
    return dtype.simpleString()


def schema_differences(
    left: DataFrame, right: DataFrame, ignore_nullable: bool = True, ignore_order: bool = False
) -> list[tuple[str, str, str]]:
    """(field, left, right) for every field that differs; an absent field reads 'missing'.

    The second field of one name is listed as `name#2`, and so on.
    """

    def fields(df: DataFrame) -> dict[str, str]:
        described = {}
        for position, (name, field) in enumerate(zip(_unique(df.columns), df.schema)):
            text = _plain(field.dataType) if ignore_nullable else (
                f"{field.dataType.json()} {'null' if field.nullable else 'not null'}"
            )
            described[name] = text if ignore_order else f"{position + 1}: {text}"
        return described

    ours, theirs = fields(left), fields(right)
    names = list(ours) + [name for name in theirs if name not in ours]
    pairs = [(name, ours.get(name, "missing"), theirs.get(name, "missing")) for name in names]
    return [pair for pair in pairs if pair[1] != pair[2]]


def _unique(names: Sequence[str]) -> list[str]:
    """Names in order, the second and later uses of one numbered."""
    seen: Counter[str] = Counter()
    listed = []
    for name in names:
        seen[name] += 1
        listed.append(name if seen[name] == 1 else f"{name}#{seen[name]}")
    return listed


def _walk(dtype: T.DataType, path: str, nullable: bool) -> list[tuple[str, str, bool]]:
    """(path, type, nullable) of a type and of everything inside it."""
    if isinstance(dtype, T.StructType):
        inside = [row for name, field in zip(_unique(dtype.fieldNames()), dtype)
                  for row in _walk(field.dataType, f"{path}.{name}" if path else name, field.nullable)]
        return ([(path, "struct", nullable)] if path else []) + inside
    if isinstance(dtype, T.ArrayType):
        return [(path, "array", nullable), *_walk(dtype.elementType, f"{path}[]", dtype.containsNull)]
    if isinstance(dtype, T.MapType):
        return [(path, "map", nullable), *_walk(dtype.keyType, f"{path}{{key}}", False),
                *_walk(dtype.valueType, f"{path}{{value}}", dtype.valueContainsNull)]
    return [(path, dtype.simpleString(), nullable)]


def tree_differences(
    left: DataFrame, right: DataFrame, ignore_nullable: bool = True, ignore_order: bool = True
) -> list[tuple[str, str, str]]:
    """(path, left, right) for every place of the schemas, nested ones too, that differs.

    Paths read `s.x` for a field of a struct, `a[]` for the elements of an array, `m{key}` and
    `m{value}` for those of a map. With order, fields differ where they stand at different places.
    """

    def places(df: DataFrame) -> dict[str, str]:
        found = {}
        for number, (path, kind, nullable) in enumerate(_walk(df.schema, "", False)):
            text = kind if ignore_nullable else f"{kind} {'null' if nullable else 'not null'}"
            found[path] = text if ignore_order else f"{number + 1}: {text}"
        return found

    ours, theirs = places(left), places(right)
    paths = list(ours) + [path for path in theirs if path not in ours]
    return [(path, ours.get(path, "missing"), theirs.get(path, "missing")) for path in paths
            if ours.get(path) != theirs.get(path)]


def tree_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places of the schemas that differ, with the number of rows each side holds."""
    found = tree_differences(left, right)
    report = inline_table(left.sparkSession, ["path", "left_type", "right_type"], found)
    left_rows, right_rows = (df.agg(F.count("*").alias("n")).scalar() for df in (left, right))
    return report.withColumns({"left_rows": left_rows, "right_rows": right_rows})


def schema_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fields that differ in name or type, with the number of values each side holds in them."""
    found = schema_differences(left, right, ignore_order=True)
    report = inline_table(left.sparkSession, ["field", "left_type", "right_type"], found)

    def counts(df: DataFrame, name: str) -> DataFrame:
        mine = [field for field, *_ in found if field in df.columns]
        cells = [F.struct(F.lit(f).alias("field"), F.count(f).alias(name)) for f in mine]
        cells = cells or [F.struct(F.lit(None).cast("string").alias("field"),
                                   F.count(F.lit(1)).alias(name))]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    return (
        report.join(counts(left, "left_values"), "field", "left")
        .join(counts(right, "right_values"), "field", "left")
        .fillna(0, ["left_values", "right_values"])
    )


def _signed(left: DataFrame, right: DataFrame) -> DataFrame:
    ours = left.withColumns({"left_rows": F.lit(1), "right_rows": F.lit(0)})
    theirs = right.withColumns({"left_rows": F.lit(0), "right_rows": F.lit(1)})
    return ours.unionByName(theirs)


def row_differences(left: DataFrame, right: DataFrame, ignore_columns_order: bool = True,
                    ignore_nullable: bool = True) -> DataFrame:
    """Rows whose number of copies differs, with the copies on either side.

    Row order has no meaning; NaN equals NaN and NULL equals NULL.
    """
    problems = schema_differences(left, right, ignore_nullable, ignore_columns_order)
    if problems:
        raise SchemaMismatch(str(problems))
    left, right = left.toDF(*_unique(left.columns)), right.toDF(*_unique(right.columns))
    return (
        _signed(left, right)
        .groupBy(*left.columns)
        .agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
        .where(F.col("left_rows") != F.col("right_rows"))
    )


def _has_nan(value: Column, dtype: T.DataType) -> Column | None:
    """Whether a value holds NaN anywhere; None for types that cannot."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.coalesce(F.isnan(value), F.lit(False))
    if isinstance(dtype, T.StructType):
        parts = [_has_nan(value[field.name], field.dataType) for field in dtype]
        found = None
        for part in parts:
            found = part if found is None or part is None else found | part
        return found
    if isinstance(dtype, T.ArrayType) and _has_nan(F.lit(0.0), dtype.elementType) is not None:
        return F.coalesce(F.exists(value, lambda item: _has_nan(item, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.MapType):
        return _has_nan(F.map_values(value), T.ArrayType(dtype.valueType))
    return None


def table_differences(
    left: DataFrame,
    right: DataFrame,
    transforms: Sequence[Callable[[DataFrame], DataFrame]] = (),
    ignore_nullable: bool = False,
    ignore_column_order: bool = False,
    allow_nan_equality: bool = False,
) -> DataFrame:
    """Differing rows of two tables after the same transforms of both.

    Unless NaN may equal NaN, every row that holds one, at any depth, counts as different. The
    order of rows has no meaning.
    """
    for transform in transforms:
        left, right = transform(left), transform(right)
    differing = row_differences(left, right, ignore_column_order, ignore_nullable)
    if allow_nan_equality:
        return differing
    columns = _unique(left.columns)
    flags = [flag for name, field in zip(columns, left.schema)
             if (flag := _has_nan(F.col(f"`{name}`"), field.dataType)) is not None]
    if not flags:
        return differing
    some = flags[0]
    for flag in flags[1:]:
        some = some | flag
    sides = _signed(left.toDF(*columns), right.toDF(*_unique(right.columns)))
    return sides.groupBy(*columns).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")).where(
        (F.col("left_rows") != F.col("right_rows")) | some)


def _close(left: Column, right: Column, dtype: T.DataType, precision: float) -> Column:
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return left.eqNullSafe(right)
    near = F.coalesce(F.abs(left - right) <= precision, F.lit(False))
    return left.eqNullSafe(right) | near


def approximate_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], precision: float
) -> DataFrame:
    """Keys whose rows differ by more than the precision in a float, or at all in other columns.

    The keys must identify a row. A key with several rows on a side is reported as
    'repeated key', one that is absent on a side as 'missing'.
    """
    problems = schema_differences(left, right, ignore_order=True)
    if problems:
        raise SchemaMismatch(str(problems))
    values = [name for name in left.columns if name not in keys]
    hashes = [F.bit_xor(F.xxhash64(F.lit(salt), *values)).alias(f"hash_{salt}") for salt in (1, 2)]
    counted = (
        _signed(left, right)
        .groupBy(*keys)
        .agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"), *hashes)
    )
    single = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    # the hashes of two equal rows cancel
    apart = (F.col("hash_1") != 0) | (F.col("hash_2") != 0)
    repeated = F.when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), F.lit("repeated key"))
    unpaired = counted.where(~single).select(
        *keys, "left_rows", "right_rows", repeated.otherwise("missing").alias("difference"))
    changed = counted.where(single & apart).select(*keys)

    def rows(df: DataFrame, side: str) -> DataFrame:
        return df.select(*(F.col(name).alias(f"{side}_key_{i}") for i, name in enumerate(keys)),
                         F.struct(*values).alias(f"{side}_row"))

    def same_key(side: str) -> Column:
        condition = F.lit(True)
        for i, name in enumerate(keys):
            condition = condition & F.col(name).eqNullSafe(F.col(f"{side}_key_{i}"))
        return condition

    differing = F.array_compact(F.array(*[
        F.when(
            ~_close(F.col(f"left_row.{name}"), F.col(f"right_row.{name}"),
                    left.schema[name].dataType, precision),
            F.lit(name),
        )
        for name in values
    ]))
    paired = changed.join(rows(left, "left"), same_key("left")).join(rows(right, "right"), same_key("right"))
    one = F.lit(1).cast("bigint")
    moved = paired.withColumn("fields", differing).where(F.size("fields") > 0).select(
        *keys, one.alias("left_rows"), one.alias("right_rows"), F.concat_ws(",", "fields").alias("difference"))
    return unpaired.unionByName(moved)


def column_differences(
    df: DataFrame, first: str, second: str, precision: float | None = None
) -> DataFrame:
    """Rows in which two columns differ; NULL equals NULL.

    With a precision, numbers are equal if they differ by less than it.
    """
    same = F.col(first).eqNullSafe(F.col(second))
    if precision is not None:
        near = F.abs(F.col(first) - F.col(second)) < precision
        both = F.col(first).isNull() & F.col(second).isNull()
        same = both | F.coalesce(near, F.lit(False))
    return df.where(~same)


def tables_match(
    left: DataFrame, right: DataFrame, left_out: Sequence[str] = (), ignored: str = "CREATED_AT"
) -> DataFrame:
    """Differences of two published tables, apart from their stamps and some attributes."""
    kept = right.where(~F.col("ATTRIBUTE_IDENTIFIER").isin(list(left_out))) if left_out else right
    return row_differences(left.drop(ignored), kept.drop(ignored))
