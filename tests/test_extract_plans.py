"""P4-P7 and P17 on the clinical fixture."""

from datetime import datetime as dt

import pytest

from stayflow.operators.joins import within_interval
from stayflow.plans.cohort import all_encounters
from stayflow.plans.departments import flowsheet_catalog
from stayflow.plans.extracts import conditions, interventions, labs, vitals
from tests.clinical_fixtures import CFG, catalog


@pytest.fixture(scope="module")
def src(spark):
    return catalog(spark)


@pytest.fixture(scope="module")
def cohort(src):
    return all_encounters(src, CFG).cache()


def test_conditions(src, cohort):
    got = {(r.hid, r.code, r.recorded, r.abatement): r for r in conditions(src, cohort).collect()}
    d0401, d0403 = dt(2020, 4, 1), dt(2020, 4, 3)
    assert set(got) == {
        (1002, "A41.9", d0401, d0401), (1002, "J45.909", d0401, d0401),
        (1003, "S72.001A", dt(2020, 5, 1), None), (1002, "A41.9", d0401, d0403),
        (1002, "S72.001A", d0401, d0403), (1008, "A41.9", dt(2020, 6, 1, 7), dt(2020, 6, 1, 7))}
    both = got[(1002, "J45.909", d0401, d0401)]
    assert (both.source, both.isPrimary) == ("ENC_DX", "Y")        # Q8; 'Y' survives NULL
    open_ = got[(1003, "S72.001A", dt(2020, 5, 1), None)]
    assert (open_.abatementBoolean, open_.source, open_.isPrimary) == ("0", "PROB_LIST", "Y")
    bill = got[(1002, "A41.9", d0401, d0403)]
    assert (bill.source, bill.isPrimary, bill.abatementBoolean) == ("BILLING", None, "1")
    assert bill.recorded_Anonymized == 1752 and bill.abatement_Anonymized == 1754
    assert bill.nomenclature == "ICD10" and bill.codeText == "Sepsis" and bill.pid == "P2"


def test_labs(src, cohort):
    got = {(r.hid, r.value): r for r in labs(src, cohort).collect()}
    assert set(got) == {(1002, "7.4"), (1002, "140"), (1003, "POS"), (1003, "7.3")}
    a = got[(1002, "7.4")]
    assert (a.nomenclature, a.code, a.NAME) == ("LONIC CODE", "11558-4", "pH of Blood")
    assert (a.sampleTime_Anonymized, a.resultTime_Anonymized, a.orderTime_Anonymized) == \
        (2700, 3600, 1800)
    b = got[(1002, "140")]
    assert (b.nomenclature, b.code, b.units, b.sampleTime) == ("LONIC CODE", "2951-2",
                                                               "mmol/L", None)
    c = got[(1003, "POS")]
    assert (c.nomenclature, c.code, c.NAME) == ("COMPONENT CODE", "503", "Culture")
    d = got[(1003, "7.3")]  # second order table is reached only through the first
    assert (d.code, d.sampleTime, d.orderTime) == ("501", None, None)


def test_vitals(src, cohort):
    rows = vitals(src, cohort, CFG).collect()
    got = sorted((r.hid, r.code, r.value) for r in rows)
    assert got == [(1002, "F1", "120"), (1002, "F1", "98"), (1003, "F2", "97"),
                   (1008, "F4", "110"), (1008, "F4", "111"), (1008, "F4", "50")]
    by = {r.value: r for r in rows}
    assert by["98"].startTime_Anonymized == 151405200
    assert by["50"].startTime_Anonymized == -172022400       # measured before birth
    assert (by["98"].source, by["98"].name, by["98"].units) == ("Device", "Pulse Ox", "%")
    assert by["97"].source is None


def test_interventions_patient_missing(src, cohort):
    rows = interventions(src, cohort, CFG).collect()
    assert [(r.pid, r.hid, r.code, r.startTime_Anonymized) for r in rows] == \
        [(None, 1005, "F3", None)]


def test_flowsheet_catalog(src, cohort):
    got = [(r.FLO_MEAS_ID, r.OCCURANCES) for r in flowsheet_catalog(src, cohort).collect()]
    assert got[0] == ("8", 3)                                # most frequent first
    assert dict(got) == {"8": 3, "10": 1, "99": 1, "77": 1}


def test_within_interval_counts_overlaps(spark):
    pts = spark.createDataFrame([(1, dt(2020, 1, 1, 10))], "k long, t timestamp_ntz")
    iv = spark.createDataFrame([(1, dt(2020, 1, 1, 9), dt(2020, 1, 1, 11)),
                                (1, dt(2020, 1, 1, 10), dt(2020, 1, 1, 12)),
                                (1, dt(2020, 1, 1, 11), dt(2020, 1, 1, 12)),
                                (2, dt(2020, 1, 1, 9), dt(2020, 1, 1, 12))],
                               "k2 long, a timestamp_ntz, b timestamp_ntz")
    assert within_interval(pts, iv, {"k": "k2"}, "t", "a", "b").count() == 2   # Q16


def test_least_name_in_linguistic_order(spark):
    from stayflow.functions.expr import min_text
    rows = [(1, "Banana"), (1, "apple"), (1, None), (2, None), (3, "Äpfel"), (3, "äpfel"), (3, "apfelz"),
            (4, "Apple"), (4, "apple")]
    df = spark.createDataFrame(rows, "k int, n string")
    found = df.groupBy("k").agg(min_text("n", "UNICODE").alias("u"), min_text("n", "UTF8_BINARY").alias("b"))
    assert found.schema["u"].dataType.simpleString() == "string"
    assert {r.k: (r.u, r.b) for r in found.collect()} == {
        1: ("apple", "Banana"), 2: (None, None), 3: ("äpfel", "apfelz"), 4: ("apple", "Apple")}
    assert df.limit(0).agg(min_text("n", "UNICODE")).first()[0] is None
