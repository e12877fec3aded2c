"""Nested documents whose fields drift, read as VARIANT.

Documents are parsed once, whatever their shape.  ``schema_of_variant_agg``
tells in one aggregate which paths occur at all; of the spellings a field may
have, those that occur are tried in order.  Values are cast as they are met
(a number written as text is a number, what cannot be cast is null), so
documents with renamed, missing and retyped fields flatten to the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, VariantType

from barrio.functions.keys import composite_key

# Spellings of the fields of price documents and their entries.
DOCUMENT_FIELDS: dict[str, tuple[Sequence[str], str]] = {
    "neighborhood_id": (("_id", "id"), "int"),
    "district_id": (("district_id",), "int"),
    "district_name": (("district_name",), "string"),
    "neighborhood_name": (("neigh_name ", "neigh_name"), "string"),
}
ENTRIES = ("info", "history")
ENTRY_FIELDS: dict[str, tuple[Sequence[str], str]] = {
    "year": (("year", "Year"), "int"),
    "price_per_meter": (("PerMeter", "per_meter"), "double"),
    "total_amount": (("Amount", "amount"), "double"),
    "used_amount": (("usedAmount", "used_amount"), "double"),
    "diff_amount": (("diffAmount", "diff_amount"), "double"),
    "diff_price_per_meter": (("diffPerMeter", "diff_per_meter"), "double"),
}


def shape(documents: DataFrame, column: str) -> StructType:
    """The merged schema of all documents (one row on the driver)."""
    found = documents.agg(F.schema_of_variant_agg(column)).first()[0]
    if found is None or not found.startswith("OBJECT"):
        return StructType()
    dtype = DataType.fromDDL(found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING"))
    return dtype if isinstance(dtype, StructType) else StructType()


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def field(value: Column | str, spellings: Sequence[str], present: set[str], dtype: str) -> Column:
    """The first of the spellings that a document has, cast; null if none."""
    # numbers may be written as text: what is no number is tried as such
    tries = []
    for name in spellings:
        if name in present:
            got = F.try_variant_get(value, _path(name), dtype)
            tries.append(got if dtype == "string" else F.coalesce(
                got, F.try_variant_get(value, _path(name), "string").try_cast(dtype)))
    return F.coalesce(*tries) if tries else F.lit(None).cast(dtype)


def _names(dtype: object) -> set[str]:
    return set(dtype.fieldNames()) if isinstance(dtype, StructType) else set()


def flatten_variants(documents: DataFrame, column: str = "value") -> DataFrame:
    """Price documents (JSON text in ``column``) -> one row per (area, year)."""
    # what is no object (a list, a bare value, broken text) is no document
    parsed = (documents.select(F.try_parse_json(column).alias("d"))
              .where(F.startswith(F.schema_of_variant("d"), F.lit("OBJECT"))).checkpoint(eager=True))
    top = shape(parsed, "d")
    arrays = [n for n in ENTRIES if n in _names(top)]
    entry: set[str] = set()
    drifting = False
    for n in arrays:
        kind = top[n].dataType
        if isinstance(kind, ArrayType):
            entry |= _names(kind.elementType)
            drifting |= isinstance(kind.elementType, VariantType)
        drifting |= isinstance(kind, VariantType)
    if drifting:                 # entries of unlike types: any spelling may occur
        entry = {n for spellings, _ in ENTRY_FIELDS.values() for n in spellings}
    present = _names(top)
    head = [field("d", spellings, present, t).alias(name) for name, (spellings, t) in DOCUMENT_FIELDS.items()]
    lists = [F.try_variant_get("d", _path(n), "array<variant>") for n in arrays]
    if not lists:
        lists = [F.lit(None).cast("array<variant>")]
    each = parsed.select(*head, F.explode(F.coalesce(*lists)).alias("e"))
    out = each.select(*DOCUMENT_FIELDS, *[field("e", spellings, entry, t).alias(name)
                                          for name, (spellings, t) in ENTRY_FIELDS.items()])
    return out.withColumn("_id", composite_key("neighborhood_id", "year"))
