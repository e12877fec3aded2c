"""Join keys, composite ids and years recovered from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The year patterns the source jobs applies.
#   resource url + name -> year of a published dataset (0 when absent)
#   landed file base name -> first four digits
#   landed file path -> folder written as year_YYYY
RESOURCE_YEAR_PATTERN = r"(20\d{2})"
FILE_NAME_YEAR_PATTERN = r"(\d{4})"
FOLDER_YEAR_PATTERN = r"year_(\d{4})"


def norm_key(c: Column | str) -> Column:
    """Join key for area names: trimmed (spaces only) and lower-cased."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c))


def composite_key(*parts: Column | str, sep: str = "-") -> Column:
    """``a-b`` style id; null when any part is null.

    ``concat_ws`` alone skips null parts silently (``NULL, 2015`` would give
    ``"2015"`` and collide across areas), so a null part rejects the key.
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.concat_ws(sep, *[c.cast("string") for c in cols]))


def first_year(text: Column, pattern: str) -> Column:
    """First capture group of ``pattern`` as int, null when it does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")


def resource_year(url: Column | str, name: Column | str) -> Column:
    """Year of a catalog resource from ``"<url> <name>"``; 0 when none."""
    url = F.col(url) if isinstance(url, str) else url
    name = F.col(name) if isinstance(name, str) else name
    text = F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(name, F.lit("")))
    return F.coalesce(first_year(text, RESOURCE_YEAR_PATTERN), F.lit(0))


def year_from_file(file_name: Column, file_path: Column,
                   name_pattern: str = FILE_NAME_YEAR_PATTERN,
                   folder_pattern: str = FOLDER_YEAR_PATTERN) -> Column:
    """Fallback year for files without a year column: base name, then folder."""
    return F.coalesce(first_year(file_name, name_pattern),
                      first_year(file_path, folder_pattern))
