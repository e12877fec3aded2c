"""Flattening nested landing documents (price histories, site addresses)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from barrio.functions.casts import col_or_null, typed_null
from barrio.functions.keys import composite_key, norm_key
from barrio.operators.dedupe import keep_one
from barrio.operators.normalize import rename_first_present

# Price-history entry fields -> formatted columns.
PRICE_METRICS: tuple[tuple[str, str], ...] = (
    ("PerMeter", "price_per_meter"),
    ("Amount", "total_amount"),
    ("usedAmount", "used_amount"),
    ("diffAmount", "diff_amount"),
    ("diffPerMeter", "diff_price_per_meter"),
)
AREA_NAME_SPELLINGS = ("neigh_name ", "neigh_name")


def _entry_fields(df: DataFrame, array_col: str) -> set[str]:
    dtype = df.schema[array_col].dataType
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return set(dtype.elementType.fieldNames())
    return set()


def format_prices(docs: DataFrame, last_year: int | Column | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Landing price documents -> one typed row per (area, year).

    P1 area-name spelling, F1 watermark (``year > last_year``; a column
    allows one watermark per document), G1 inner explode (null or empty
    histories vanish), P2 typed field extraction, D3 ``_id = area-year``.
    The watermark is applied to the array *before* the explode, where the
    generated rows cannot take a pushed filter.  ``keep`` names document
    columns carried onto every row (e.g. the file of origin).
    """
    df = rename_first_present(docs, AREA_NAME_SPELLINGS, "neighborhood_name")
    fields = _entry_fields(df, "info")
    info = F.col("info")
    if last_year is not None:
        bound = last_year if isinstance(last_year, Column) else F.lit(last_year)
        info = F.filter(info, lambda e: e["year"].try_cast("int") > bound)
    flat = df.select("*", F.explode(info).alias("_e"))

    def field(name: str) -> Column:
        return flat["_e"][name] if name in fields else typed_null("string")

    out = flat.select(
        col_or_null(flat, "_id", "int").alias("neighborhood_id"),
        col_or_null(flat, "district_id", "int").alias("district_id"),
        col_or_null(flat, "district_name", "string").alias("district_name"),
        col_or_null(flat, "neighborhood_name", "string").alias("neighborhood_name"),
        field("year").try_cast("int").alias("year"),
        *[field(src).try_cast("double").alias(dst) for src, dst in PRICE_METRICS],
        *[flat[k] for k in keep],
    )
    if last_year is not None:
        out = out.filter(F.col("year").isNotNull())
    return out.withColumn("_id", composite_key("neighborhood_id", "year"))


def flatten_addresses(docs: DataFrame) -> DataFrame:
    """G2 + P9: one row per (site, address); sites without any address are
    kept with a null area.  ``name`` becomes ``entity_name``."""
    df = docs
    if "addresses" in df.columns:
        df = (df.withColumn("_addr", F.explode_outer("addresses"))
                .withColumn("neighborhood_name", F.col("_addr")["neighborhood_name"])
                .drop("addresses", "_addr"))
    return rename_first_present(df, ("name",), "entity_name")


def format_sites(docs: DataFrame) -> DataFrame:
    """Landing site documents -> one row per ``register_id``: flattened, then
    D2 keeps the lowest normalized area name (nulls last) per site."""
    df = flatten_addresses(docs)
    area = "neighborhood_name" if "neighborhood_name" in df.columns else "addresses_neighborhood_name"
    return keep_one(df, ["register_id"], [norm_key(F.col(area))])
