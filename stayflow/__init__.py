"""stayflow: ICU-stay cohorts and their clinical extracts as Spark DataFrame plans.

Layout
------
``sources``    where base tables, inline configuration and outputs live
``functions``  Column-level helpers (boundary date differences, typed NULLs, flags)
``operators``  generic DataFrame operators (lookups, semi/anti joins, stay building,
               hierarchy expansion, code linkage, coverage reports)
``plans``      the user-level extracts (cohort, hospital, ICU, conditions, labs,
               flowsheets, medications, department helpers)
``streaming``  (intentionally empty: the extracts are batch snapshots)
"""

from stayflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
