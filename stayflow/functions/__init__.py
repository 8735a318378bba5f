"""Column-level helpers; every one compiles to built-in Catalyst expressions."""

from stayflow.functions.expr import (
    boundary_diff,
    day_diff,
    flag,
    hours_from_minutes,
    min_text,
    ntz,
    status_ok,
    typed_null,
    year_of,
)

__all__ = ["boundary_diff", "day_diff", "flag", "hours_from_minutes", "min_text", "ntz", "status_ok",
           "typed_null", "year_of"]
