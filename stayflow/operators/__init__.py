"""Generic DataFrame operators the extracts are composed of."""

from stayflow.operators.coverage import coverage_summary, coverage_waterfall, unmatched_ids
from stayflow.operators.hierarchy import expand_hierarchy
from stayflow.operators.joins import (
    classify, duplicate_keys, exclude, key_set, lookup, reduce_dimension, restrict_to,
    within_interval, within_unit_window)
from stayflow.operators.linkage import (
    best_code, class_links_shared, link_codes, link_rows, unpivot_ids)
from stayflow.operators.merge import listagg_sorted, tagged_rows, tagged_union
from stayflow.operators.stays import (
    build_stays, encounter_bounds, flag_bridges, hot_keys, mark_edges, mark_runs, pair_edges,
    stay_hours, stay_steps)
from stayflow.operators.stays_chunked import assign_chunks, build_stays_chunked

__all__ = [
    "assign_chunks", "best_code", "build_stays", "build_stays_chunked", 
    "class_links_shared", "classify", "coverage_summary", "coverage_waterfall",
    "duplicate_keys", "encounter_bounds", "exclude", "expand_hierarchy", "flag_bridges",
    "hot_keys", "key_set", "link_codes", "link_rows", "listagg_sorted", "lookup",
    "mark_edges", "mark_runs", "pair_edges", "reduce_dimension", "restrict_to", "stay_hours",
    "stay_steps", "tagged_rows", "tagged_union", "unmatched_ids", "unpivot_ids",
    "within_interval", "within_unit_window",
]
