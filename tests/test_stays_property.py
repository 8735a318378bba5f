"""Property test: build_stays against a direct per-encounter fold in Python.

The fold re-states the stay rules on a Python list (test-only reference): bridge
pairs are adjacent In->Out rows of a bridge group; runs are consecutive remaining
rows of one group; unit runs with >= 2 rows form stays from their first to their
last event time.
"""

from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stayflow.operators.stays import build_stays

GROUPS = ["PICU", "CICU", "PERIOP", "OTHER"]
BASE = datetime(2020, 1, 1)


def fold(events):
    """events: list of (seq, dir, grp, minutes) sorted by (seq, dir, position)."""
    n = len(events)
    bridge = [False] * n
    for i in range(n):
        _, d, g, _ = events[i]
        if g != "PERIOP":
            continue
        if i > 0 and events[i - 1][2] == "PERIOP" and events[i - 1][1] == "In" and d == "Out":
            bridge[i] = True
        if i + 1 < n and events[i + 1][2] == "PERIOP" and events[i + 1][1] == "Out" and d == "In":
            bridge[i] = True
    kept = [e for e, b in zip(events, bridge) if not b]
    same = [i > 0 and kept[i - 1][2] == kept[i][2] for i in range(len(kept))]
    units = [(e, s) for e, s in zip(kept, same) if e[2] not in ("PERIOP", "OTHER")]
    edges = []
    for j, (e, s) in enumerate(units):
        vin = e[3] if not s else None
        nxt_same = units[j + 1][1] if j + 1 < len(units) else False
        vout = e[3] if not nxt_same else None
        if vin is not None or vout is not None:
            edges.append((e, vin, vout))
    stays = []
    for j, (e, vin, vout) in enumerate(edges):
        out = edges[j + 1][2] if vout is None and j + 1 < len(edges) else None
        if vin is not None and out is not None and out - vin >= 30:
            stays.append((e[2], vin, out))
    return stays


event = st.tuples(st.sampled_from(["In", "Out"]), st.sampled_from(GROUPS),
                  st.integers(min_value=0, max_value=90))


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.lists(event, min_size=1, max_size=12), min_size=1, max_size=6))
def test_matches_fold(spark, encounters):
    rows, expected = [], []
    eid = 0
    for enc, evs in enumerate(encounters):
        t, ordered = 0, []
        for pos, (d, g, gap) in enumerate(evs):
            t += gap                       # times follow the sequence
            eid += 1
            rows.append((enc, pos + 1, eid, d, g, BASE + timedelta(minutes=t)))
            ordered.append((pos + 1, d, g, t))
        expected += [(enc, g, i, o) for g, i, o in fold(ordered)]
    df = spark.createDataFrame(rows, "enc long, seq long, eid long, dir string, grp string, "
                                     "t timestamp_ntz")
    got = build_stays(df, "enc", ["seq", "dir", "eid"], "grp", "dir", "t").collect()
    got = sorted((r.enc, r.grp, int((r.VISIT_IN_DT - BASE).total_seconds() // 60),
                  int((r.OUT_DT - BASE).total_seconds() // 60)) for r in got)
    assert got == sorted(expected)
    for r in build_stays(df, "enc", ["seq", "dir", "eid"], "grp", "dir", "t").collect():
        assert r.ICU_LOS_HRS >= Decimal("0.5") and r.OUT_DT >= r.VISIT_IN_DT
