"""Schema normalization for files whose headers drift from year to year.

Header mapping is decided per *file schema* on the driver (it is metadata:
one list of column names per header group) and applied as one ``select``,
so the data itself never leaves the executors.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.functions.casts import col_or_null, quoted
from barrio.functions.keys import FILE_NAME_YEAR_PATTERN, FOLDER_YEAR_PATTERN, first_year

# Incident header spellings -> canonical column.  Tried in this
# order; the first spelling contained in the stripped header wins
# (case-sensitive).  The accent-less spellings are how accented headers
# look after a wrong-encoding read.
INCIDENT_HEADERS: tuple[tuple[str, str], ...] = (
    ("Numero_expedient", "expedient_id"),
    ("Nmero d'expedient", "expedient_id"),
    ("Número d'expedient", "expedient_id"),
    ("Nmero d expedient", "expedient_id"),
    ("NK Any", "year"),
    ("NK_Any", "year"),
    ("Any", "year"),
    ("Codi_districte", "district_id"),
    ("Codi districte", "district_id"),
    ("Nom_districte", "district_name"),
    ("Nom districte", "district_name"),
    ("Codi_barri", "neighborhood_id"),
    ("Codi barri", "neighborhood_id"),
    ("Nom_barri", "neighborhood_name"),
    ("Nom barri", "neighborhood_name"),
    ("Numero_victimes", "num_victims"),
    ("Nmero de vctimes", "num_victims"),
    ("Numero_morts", "num_deaths"),
    ("Numero_lesionats_lleus", "num_minor_injuries"),
    ("Numero_lesionats_greus", "num_serious_injuries"),
)

# Canonical incident columns and their types (typed nulls when absent).
INCIDENT_TYPES: dict[str, str] = {
    "expedient_id": "string", "year": "int", "district_id": "int",
    "district_name": "string", "neighborhood_id": "int", "neighborhood_name": "string",
    "num_victims": "bigint", "num_deaths": "bigint", "num_minor_injuries": "bigint",
    "num_serious_injuries": "bigint",
}


def fold_accents(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text)
                   if not unicodedata.combining(ch))


def _match(header: str, mapping: Sequence[tuple[str, str]]) -> str | None:
    return next((target for key, target in mapping if key in header), None)


def header_plan(columns: Iterable[str], mapping: Sequence[tuple[str, str]] = INCIDENT_HEADERS
                ) -> tuple[list[tuple[str, str]], list[str]]:
    """(source, target) pairs for ``select`` plus the dropped source names.

    P3: first mapping key contained in the stripped header; when none hits,
    the accent-folded header is tried against accent-folded keys (fixes
    ``Número`` read through the wrong code page).  P4: a second column that
    maps to an already-taken target is dropped.  P5: unmapped headers keep
    their text with spaces -> ``_`` and quotes removed, suffixed on clashes.
    """
    folded = [(fold_accents(k), v) for k, v in mapping]
    plan: list[tuple[str, str | None]] = []
    taken: set[str] = set()
    dropped: list[str] = []
    for c in columns:
        clean = c.strip()
        target = _match(clean, mapping) or _match(fold_accents(clean), folded)
        if target is None:
            plan.append((c, None))
        elif target in taken:
            dropped.append(c)
        else:
            taken.add(target)
            plan.append((c, target))
    out: list[tuple[str, str]] = []
    used = set(taken)
    for src, target in plan:
        if target is None:
            base = src.strip().replace(" ", "_").replace("'", "")
            name, k = base, 2
            while name in used:
                name, k = f"{base}_{k}", k + 1
            used.add(name)
            target = name
        out.append((src, target))
    return out, dropped


def normalize_headers(df: DataFrame, mapping: Sequence[tuple[str, str]] = INCIDENT_HEADERS) -> DataFrame:
    """Apply ``header_plan`` as one projection (unknown columns are kept)."""
    plan, _ = header_plan(df.columns, mapping)
    return df.select(*[F.col(quoted(src)).alias(dst) for src, dst in plan])


def rename_first_present(df: DataFrame, candidates: Sequence[str], target: str) -> DataFrame:
    """Rename the first candidate present (exact spelling first, so the
    trailing-space variant wins when both exist); no-op when none is."""
    for cand in candidates:
        if cand in df.columns:
            return df.withColumnRenamed(cand, target)
    return df


def with_year(df: DataFrame, file_name: Column | None = None, file_path: Column | None = None,
              year_col: str = "year", name_pattern: str | None = FILE_NAME_YEAR_PATTERN,
              folder_pattern: str | None = FOLDER_YEAR_PATTERN) -> DataFrame:
    r"""Keep a present year column (cast), else recover the year from the
    file base name, then from the folder.  Decided per schema, not per row.

    Pass ``name_pattern=None`` for writer-named files (``part-00000-...``),
    whose digits are not years, and ``folder_pattern=r"year=(\d{4})"`` for
    Hive-style folders.
    """
    if year_col in df.columns:
        return df.withColumn(year_col, F.col(quoted(year_col)).try_cast("int"))
    fname = file_name if file_name is not None else F.col("_metadata.file_name")
    fpath = file_path if file_path is not None else F.col("_metadata.file_path")
    options = []
    if name_pattern:
        options.append(first_year(fname, name_pattern))
    if folder_pattern:
        options.append(first_year(fpath, folder_pattern))
    year = F.coalesce(*options) if len(options) > 1 else (options[0] if options else F.lit(None).cast("int"))
    return df.withColumn(year_col, year)


def conform(df: DataFrame, types: Mapping[str, str] = INCIDENT_TYPES, keep_extra: bool = True) -> DataFrame:
    """Every canonical column present and typed (``try_cast``; typed
    null when absent), followed by the extra columns when ``keep_extra``."""
    cols = [col_or_null(df, name, dtype).alias(name) for name, dtype in types.items()]
    if keep_extra:
        cols += [F.col(quoted(c)) for c in df.columns if c not in types]
    return df.select(*cols)


def union_flexible(frames: Sequence[DataFrame], types: Mapping[str, str] | None = None) -> DataFrame:
    """Union files whose columns differ, by name; a column missing from
    one side is null there.  Shared columns named in ``types`` are cast
    (``try_cast``) first so the union does not widen them to string."""
    if not frames:
        raise ValueError("no frames")
    types = dict(types or {})
    cast = [df.select(*[(F.col(quoted(c)).try_cast(types[c]) if c in types else F.col(quoted(c))).alias(c)
                        for c in df.columns]) for df in frames]
    out = cast[0]
    for df in cast[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
