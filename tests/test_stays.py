"""Golden traces for build_stays (FIXTURES.md section 3) and step-level checks."""

from datetime import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayflow.operators.stays import build_stays, encounter_bounds

A, TI, TO, D = "Admission", "Transfer In", "Transfer Out", "Discharge"
DIR = {A: "In", TI: "In", TO: "Out", D: "Out"}


def t(hms: str) -> dt:
    return dt.strptime("2020-01-01 " + hms if len(hms) > 5 else "2020-01-01 " + hms + ":00",
                       "%Y-%m-%d %H:%M:%S")


# enc -> list of (type, group, time[, seq]); seq defaults to position.
CASES = {
    1: [(A, "OTHER", "08:00"), (TO, "OTHER", "09:00"), (TI, "PICU", "09:00"),
        (TO, "PICU", "15:00"), (TI, "OTHER", "15:00"), (D, "OTHER", "20:00")],
    2: [(A, "PICU", "08:00"), (TO, "PICU", "10:00"), (TI, "PERIOP", "10:00"),
        (TO, "PERIOP", "12:00"), (TI, "PICU", "12:00"), (D, "PICU", "18:00")],
    3: [(A, "PICU", "08:00"), (TO, "PICU", "10:00"), (TI, "OTHER", "10:00"),
        (TO, "OTHER", "12:00"), (TI, "PICU", "12:00"), (D, "PICU", "18:00")],
    4: [(A, "PICU", "08:00")],
    5: [(A, "PICU", "08:00:59"), (D, "PICU", "08:30:00")],
    6: [(A, "PICU", "08:00:00"), (D, "PICU", "08:29:59")],
    7: [(A, "PICU", "08:00"), (TO, "PICU", "10:00"), (TI, "CICU", "10:00"), (D, "CICU", "18:00")],
    8: [(A, "PICU", "08:00"), (TO, "PICU", "10:00"), (TI, "PERIOP", "10:00"),
        (TI, "PICU", "12:00"), (D, "PICU", "18:00")],
    9: [(A, "PICU", "08:00"), (TO, "PICU", "10:00"), (TI, "PERIOP", "10:00"),
        (TO, "PERIOP", "11:00"), (TI, "PERIOP", "11:00"), (TO, "PERIOP", "12:00"),
        (TI, "PICU", "12:00"), (D, "PICU", "18:00")],
    10: [(A, "PICU", "08:00"), (TI, "OTHER", "10:00"), (TO, "OTHER", "12:00"),
         (TI, "PICU", "12:00"), (D, "PICU", "18:00")],
    11: [(A, "PICU", "08:00", 1), (D, "PICU", "18:00", 1)],
    12: [(A, "PICU", "08:00"), (TI, "PICU", "09:00")],
}

EXPECTED = {  # enc -> sorted [(group, in, out, hours)]
    1: [("PICU", "09:00", "15:00", "6.000000")],
    2: [("PICU", "08:00", "18:00", "10.000000")],
    3: [("PICU", "08:00", "10:00", "2.000000"), ("PICU", "12:00", "18:00", "6.000000")],
    4: [],
    5: [("PICU", "08:00:59", "08:30:00", "0.500000")],
    6: [],
    7: [("PICU", "08:00", "10:00", "2.000000"), ("CICU", "10:00", "18:00", "8.000000")],
    8: [("PICU", "08:00", "10:00", "2.000000"), ("PICU", "12:00", "18:00", "6.000000")],
    9: [("PICU", "08:00", "18:00", "10.000000")],
    10: [("PICU", "12:00", "18:00", "6.000000")],
    11: [("PICU", "08:00", "18:00", "10.000000")],
    12: [("PICU", "08:00", "09:00", "1.000000")],
}

SCHEMA = "enc long, seq long, event_id long, event_type string, dept_grp string, " \
         "dir string, effective_time timestamp_ntz"
ORDER = ["seq", "dir", "event_id"]


def events_frame(spark, cases):
    rows, eid = [], 0
    for enc, evs in cases.items():
        for i, ev in enumerate(evs):
            typ, grp, tm = ev[:3]
            seq = ev[3] if len(ev) > 3 else i + 1
            eid += 1
            rows.append((enc, seq, eid, typ, grp, DIR[typ], t(tm)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def stays(spark):
    ev = events_frame(spark, CASES)
    return build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time").collect()


@pytest.mark.parametrize("enc", sorted(CASES))
def test_golden_trace(stays, enc):
    got = sorted(
        (r.dept_grp, r.VISIT_IN_DT, r.OUT_DT, r.ICU_LOS_HRS) for r in stays if r.enc == enc)
    want = sorted((g, t(i), t(o), Decimal(h)) for g, i, o, h in EXPECTED[enc])
    assert sorted(got, key=lambda x: x[1]) == sorted(want, key=lambda x: x[1])


def test_hospital_bounds(spark):
    ev = events_frame(spark, {1: CASES[1], 11: CASES[11]})
    got = {(r.enc, r.HOSP_ADMIT_DT, r.HOSP_DC_DT)
           for r in encounter_bounds(ev, "enc", ORDER, "effective_time").collect()}
    assert got == {(1, t("08:00"), t("20:00")), (11, t("08:00"), t("18:00"))}


def test_window_excludes_boundary(spark):
    ev = events_frame(spark, {2: CASES[2]})
    edge = build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time",
                       window=(t("08:00"), t("23:00")))
    inside = build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time",
                         window=(t("07:59"), t("23:00")))
    assert edge.count() == 0 and inside.count() == 1


def test_input_order_irrelevant(spark):
    ev = events_frame(spark, CASES)
    a = build_stays(ev, "enc", ORDER, "dept_grp", "dir", "effective_time")
    b = build_stays(ev.orderBy(F.rand(7)).repartition(5), "enc", ORDER, "dept_grp", "dir",
                    "effective_time")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_one_exchange(spark):
    ev = events_frame(spark, CASES)
    plan = build_stays(ev, "enc", ORDER, "dept_grp", "dir",
                       "effective_time")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1, plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
