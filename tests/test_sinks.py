"""Sinks: CSV round trip, overwrite, publish/materialise, and the full run."""

import os
import tempfile
from datetime import datetime

from stayflow.plans.run import write_all
from stayflow.sources.catalog import SourceCatalog, normalize
from stayflow.sources.sinks import materialize, publish, read_extract, write_extract
from tests.clinical_fixtures import CFG, catalog

SCHEMA = "id long, txt string, t timestamp_ntz"


def test_csv_round_trip(spark):
    rows = [(1, 'say "hi", then go', datetime(2020, 1, 2, 3, 4, 5)), (2, None, None), (3, "", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = tempfile.mkdtemp(prefix="stayflow-csv-")
    path = write_extract(df, "x", out, single_file=True)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path))
                   if f.endswith(".csv"))
    assert '"say ""hi"", then go"' in text           # RFC-4180 quoting
    assert "NULL" in text and "2020-01-02 03:04:05" in text
    back = sorted(read_extract(spark, path, SCHEMA).collect())
    assert back == sorted(df.collect())


def test_overwrite_and_publish(spark):
    out = tempfile.mkdtemp(prefix="stayflow-pub-")
    p = os.path.join(out, "t")
    publish(spark.range(5), p)
    assert publish(spark.range(3), p).count() == 3
    m = materialize(spark.range(4), "unit-test")
    assert m.count() == 4 and "stayflow-unit-test" in m.inputFiles()[0]


def test_catalog_names(spark):
    assert normalize("Clarity..ORDER_PROC") == "ORDER_PROC"
    assert normalize("CLARITY..zc_lab_status") == "ZC_LAB_STATUS"
    d = tempfile.mkdtemp(prefix="stayflow-src-")
    spark.range(2).write.parquet(os.path.join(d, "PATIENT.parquet"))
    src = SourceCatalog(spark, parquet_dir=d)
    assert src.table("Clarity..patient").count() == 2


def test_write_all(spark):
    out = tempfile.mkdtemp(prefix="stayflow-run-")
    paths = write_all(catalog(spark), out, CFG)
    assert {"cohort", "hospital", "med_links", "med_coverage_summary"} <= set(paths)
    for p in paths.values():
        assert any(f.endswith(".csv") for f in os.listdir(p))


def test_config_from_dict():
    from stayflow.sources.config import config_from_dict
    cfg = config_from_dict({
        "start": "2020-01-01", "end": "2020-12-31T00:00:00",
        "units": [{"group": "PICU", "dept_id": 100, "open_date": "2019-01-01",
                   "close_date": "2021-01-01"},
                  {"group": "PERIOP", "dept_id": "900", "open_date": "2019-01-01",
                   "close_date": "2021-01-01"}],
        "vital_ids": [{"flo_id": 10, "display_name": "SpO2"}],
        "hot_encounter_events": None})
    assert cfg.units[0].dept_id == "100" and cfg.vital_ids[0].flo_id == "10"
    assert cfg.start == datetime(2020, 1, 1) and cfg.hot_encounter_events is None
    cfg.validate()


def test_cli_writes_extracts(spark):
    import json as _json
    from stayflow.__main__ import main
    d = tempfile.mkdtemp(prefix="stayflow-cli-src-")
    src = catalog(spark)
    for name, df in src._tables.items():
        df.write.parquet(os.path.join(d, name + ".parquet"))
    conf = os.path.join(d, "study.json")
    with open(conf, "w") as fh:
        _json.dump({"start": "2020-01-01", "end": "2020-12-31",
                    "units": [{"group": u.group, "dept_id": u.dept_id,
                               "open_date": str(u.open_date), "close_date": str(u.close_date)}
                              for u in CFG.units]}, fh)
    out = tempfile.mkdtemp(prefix="stayflow-cli-out-")
    main(["--parquet-dir", d, "--out", out, "--config", conf, "--format", "parquet"])
    cohort = spark.read.parquet(os.path.join(out, "all_encounters"))
    assert cohort.count() == 6
