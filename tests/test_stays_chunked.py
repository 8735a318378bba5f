"""The chunked (hot-encounter) stay plan must give exactly the plain plan's stays."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stayflow.operators.stays import build_stays
from stayflow.operators.stays_chunked import assign_chunks
from tests.test_stays import CASES, ORDER, events_frame

COLS = ["enc", "event_id", "dept_grp", "HOSP_ADMIT_DT", "HOSP_DC_DT", "VISIT_IN_DT", "OUT_DT",
        "IN_YEAR", "ICU_LOS_HRS"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def test_golden_cases_chunked(spark):
    ev = events_frame(spark, CASES)
    plain = build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time")
    chunked = build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time",
                          hot_threshold=0, chunk_rows=2)
    assert _rows(chunked) == _rows(plain)


def test_chunks_are_bounded_and_ordered(spark):
    rows = [(1, i, i) for i in range(1, 1001)] + [(2, i * 10, i) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "k long, seq long, id long")
    c = assign_chunks(df, "k", ["seq", "id"], 100, rows_per_task=250).collect()
    sizes = {}
    for r in c:
        sizes[r["__chunk"]] = sizes.get(r["__chunk"], 0) + 1
    assert max(sizes.values()) <= 100 and len(sizes) >= 10     # bounded chunks
    by_key = sorted((r.k, r.seq, r["__chunk"]) for r in c)
    for a, b in zip(by_key, by_key[1:]):
        if a[0] == b[0]:
            assert a[2] <= b[2]                                 # chunks follow the order


GROUPS = ["PICU", "CICU", "PERIOP", "OTHER"]
event = st.tuples(st.sampled_from(["In", "Out"]), st.sampled_from(GROUPS),
                  st.integers(min_value=0, max_value=90))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.lists(event, min_size=1, max_size=25), min_size=1, max_size=3),
       st.integers(min_value=1, max_value=4))
def test_random_chunked_equals_plain(spark, encounters, chunk_rows):
    base, rows, eid = datetime(2020, 1, 1), [], 0
    for enc, evs in enumerate(encounters):
        t = 0
        for pos, (d, g, gap) in enumerate(evs):
            t += gap
            eid += 1
            rows.append((enc, pos + 1, eid, d, g, base + timedelta(minutes=t)))
    df = spark.createDataFrame(rows, "enc long, seq long, event_id long, dir string, "
                                     "dept_grp string, effective_time timestamp_ntz")
    order = ["seq", "dir", "event_id"]
    plain = build_stays(df, "enc", order, "dept_grp", "dir", "effective_time")
    chunked = build_stays(df, "enc", order, "dept_grp", "dir", "effective_time",
                          hot_threshold=3, chunk_rows=chunk_rows)
    assert _rows(chunked) == _rows(plain)


@pytest.mark.parametrize("upto", ["bounds", "bridges", "runs", "edges", "pairs"])
def test_each_step_chunked_equals_plain(spark, upto):
    from stayflow.operators.stays import stay_steps
    ev = events_frame(spark, CASES)
    plain = stay_steps(ev, "enc", ORDER, "dept_grp", "dir", "effective_time", upto)
    chunked = stay_steps(ev, "enc", ORDER, "dept_grp", "dir", "effective_time", upto,
                         hot_threshold=0, chunk_rows=2)
    cols = sorted(plain.columns)
    assert sorted(chunked.columns) == cols
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r[c] for c in cols) for r in chunked.collect()), key=key) == \
        sorted((tuple(r[c] for c in cols) for r in plain.collect()), key=key)


def test_bursty_order_values_are_split(spark):
    # 1000 events in one narrow burst plus 10 spread far apart: equal-width ranges
    # would put the burst in one chunk; counted fine buckets split it
    rows = [(1, 10_000_000 + i, i) for i in range(1000)] + \
           [(1, i * 1_000_000_000, 5000 + i) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "k long, seq long, id long")
    c = assign_chunks(df, "k", ["seq", "id"], 100, rows_per_task=200) \
        .groupBy("__chunk").count().collect()
    assert max(r["count"] for r in c) <= 100 and len(c) >= 10


def test_null_sequence_numbers(spark):
    from datetime import datetime as dt
    rows = [(1, None, 1, "In", "PICU", dt(2020, 1, 1, 8)),
            (1, 1, 2, "Out", "PICU", dt(2020, 1, 1, 9)),
            (1, 2, 3, "In", "CICU", dt(2020, 1, 1, 9)),
            (1, 3, 4, "Out", "CICU", dt(2020, 1, 1, 12)),
            (1, None, 5, "In", "OTHER", dt(2020, 1, 1, 7))]
    df = spark.createDataFrame(rows, "enc long, seq long, event_id long, dir string, "
                                     "dept_grp string, effective_time timestamp_ntz")
    order = ["seq", "dir", "event_id"]
    plain = build_stays(df, "enc", order, "dept_grp", "dir", "effective_time")
    chunked = build_stays(df, "enc", order, "dept_grp", "dir", "effective_time",
                          hot_threshold=0, chunk_rows=1)
    assert _rows(chunked) == _rows(plain)


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.lists(st.tuples(st.sampled_from(["In", "Out", None]),
                                   st.sampled_from(["PICU", "CICU", "PERIOP", "CATH", "OTHER", None]),
                                   st.sampled_from([0, 40, 90, None])), min_size=1, max_size=30),
                min_size=1, max_size=3),
       st.integers(min_value=1, max_value=5))
def test_random_steps_with_nulls_and_a_unit_that_is_a_bridge(spark, encounters, chunk_rows):
    """NULL groups, directions and times, and a bridge group (CATH) that also holds stays."""
    from stayflow.operators.stays import stay_steps
    base, rows, eid = datetime(2020, 1, 1), [], 0
    for enc, evs in enumerate(encounters):
        t = 0
        for pos, (d, g, gap) in enumerate(evs):
            t += gap or 0
            eid += 1
            rows.append((enc or None, pos, eid, d, g, None if gap is None else base + timedelta(minutes=t)))
    df = spark.createDataFrame(rows, "enc long, seq long, event_id long, dir string, "
                                     "dept_grp string, effective_time timestamp_ntz")
    for upto in ("bridges", "runs", "edges", "pairs"):
        plain, chunked = (stay_steps(df, "enc", ["seq", "event_id"], "dept_grp", "dir", "effective_time", upto,
                                     bridge_groups=("PERIOP", "CATH"), chunk_rows=chunk_rows, **hot)
                          for hot in ({}, {"hot_threshold": 0}))
        cols = plain.columns
        assert sorted(map(str, chunked.select(*cols).collect())) == sorted(map(str, plain.collect()))


def test_segments_are_written_once(spark, monkeypatch):
    from stayflow.operators import stays_chunked
    written = []
    kept = stays_chunked.materialize
    monkeypatch.setattr(stays_chunked, "materialize", lambda df, name: written.append(name) or kept(df, name))
    ev = events_frame(spark, CASES)
    out = stays_chunked.build_stays_chunked(ev, "enc", ORDER, "dept_grp", "dir", "effective_time", 2)
    assert written == ["stays-segments", "stays-contexts"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1       # the segments, for all steps together
