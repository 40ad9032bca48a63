"""Helpers the corpus operators share."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.sources.workspace import staged

ROW = "row_number"
FILE_ROWS_BITS = 40
#: The white space the operators know: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns (all by default) and a unique row number.

    The numbers hold for one evaluation only; stage what is used twice.
    """
    kept = docs.select(*columns) if columns else docs
    return kept.withColumn(ROW, F.monotonically_increasing_id())


def numbered_documents(docs: DataFrame) -> DataFrame:
    """Whole documents with row numbers that every evaluation repeats, so that decisions can be joined.

    A stored table's rows are numbered by file and place in the file, and are not written again. The
    numbers of its files, one row per file, are all that is broadcast. Other frames are written once.
    """
    place = _place_in_file(docs)
    if place is None:
        return staged(numbered(docs), "documents")
    at, path, number = (_free(docs, name) for name in ("place_in_file", "path_of_file", "number_of_file"))
    located = docs.select("*", place.alias(at))
    order = Window.orderBy(path)  # one row per file
    files = staged(located.select(F.col(f"{at}.file_path").alias(path)).distinct().select(
        path, (F.row_number().over(order) - 1).cast("long").alias(number)), "files")
    return located.join(F.broadcast(files), F.col(f"{at}.file_path") == F.col(path)).select(
        *(docs[name] for name in docs.columns if name != ROW),
        (F.shiftleft(F.col(number), FILE_ROWS_BITS) + F.col(f"{at}.row_index")).alias(ROW))


def _free(docs: DataFrame, name: str) -> str:
    """The name, or one made from it that no column has."""
    while name in docs.columns:
        name += "_"
    return name


def _place_in_file(docs: DataFrame) -> Column | None:
    """File and row of a plain scan of stored rows; None for anything else."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        metadata = docs.metadataColumn("_metadata")
        place = F.struct(metadata["file_path"].alias("file_path"), metadata["row_index"].alias("row_index"))
        docs.select(place)
        return place
    except AnalysisException:
        return None


def rows_kept(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose row number is in `kept`, without the number."""
    return documents.join(kept.select(ROW), ROW, "left_semi").drop(ROW)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: Column, salt: int, parts: int) -> Column:
    """crc32 of an id as text, modulo `parts`."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == salt


LETTERS = re.compile(r"[^\W\d_]")
