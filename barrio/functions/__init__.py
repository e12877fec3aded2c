"""Column expressions shared by the operators (all JVM-side built-ins)."""

from barrio.functions.casts import col_or_null, quoted, typed_null
from barrio.functions.dates import antiquity_years
from barrio.functions.keys import (composite_key, first_year, norm_key,
                                   resource_year, year_from_file)
from barrio.functions.noise import hash32, jitter, py_round, uniform

__all__ = [
    "antiquity_years", "col_or_null", "composite_key", "first_year", "hash32", "jitter",
    "norm_key", "py_round", "quoted", "resource_year", "typed_null", "uniform",
    "year_from_file",
]
