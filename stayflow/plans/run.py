"""Run every extract for one study and write the files.

The cohort is published once (parquet in the shared checkpoint folder) and every
extract reads it back, like the reference's session-global cohort table; the
medication chain materialises its own reused intermediates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayflow.plans.cohort import all_encounters
from stayflow.plans.departments import flowsheet_catalog
from stayflow.plans.extracts import conditions, hospital, icu, interventions, labs, vitals
from stayflow.plans.medications import cohort_orders, medication_chain, medications_v1
from stayflow.session import run_folder
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.config import StudyConfig
from stayflow.sources.sinks import materialize, write_extract

# File names of the extracts, after the study's prefix.
FILE_NAMES = {
    "cohort": "all_encounters",
    "hospital": "hospital",
    "icu": "icu",
    "conditions": "conditions",
    "labs": "labs",
    "vitals": "vital_signs",
    "interventions": "interventions",
    "medications_v1": "medications_legacy",
    "medications": "medications",
    "med_hierarchy": "med_hierarchy",
    "med_links": "med_links",
}


def extracts(src: SourceCatalog, cfg: StudyConfig) -> dict[str, DataFrame]:
    """All extract DataFrames, keyed by name (the cohort is published first)."""
    cohort = materialize(all_encounters(src, cfg), "all_enc")
    orders = cohort_orders(src, cohort)
    out = {
        "cohort": cohort,
        "hospital": hospital(src, cohort).orderBy("pid"),
        "icu": icu(cohort),
        "conditions": conditions(src, cohort),
        "labs": labs(src, cohort),
        "vitals": vitals(src, cohort, cfg),
        "interventions": interventions(src, cohort, cfg),
        "medications_v1": medications_v1(src, cohort, orders),
        "flowsheet_catalog": flowsheet_catalog(src, cohort),
    }
    out.update(medication_chain(src, cohort, orders))
    return out


def write_all(src: SourceCatalog, out_dir: str, cfg: StudyConfig,
              fmt: str = "csv") -> dict[str, str]:
    """Write every extract under ``out_dir``; returns name -> path. The run's intermediates
    lie in a folder of their own, which is removed at the end."""
    paths = {}
    with run_folder(src.spark):
        for name, df in extracts(src, cfg).items():
            file = cfg.file_prefix + FILE_NAMES.get(name, name)
            paths[name] = write_extract(df, file, out_dir, fmt=fmt)
    return paths
