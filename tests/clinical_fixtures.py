"""A small, invented clinical database covering the cases of FIXTURES.md section 4.

Units: PICU = department 100, CICU = 200 (open 2020-01-01 .. 2020-06-30),
PERIOP = 900; department 500 is an ordinary ward (group OTHER).
Study window: 2020-01-01 .. 2020-12-31 (exclusive).
"""

from __future__ import annotations

from datetime import date, datetime

from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.config import MeasureId, StudyConfig, UnitWindow

CFG = StudyConfig(
    start=datetime(2020, 1, 1), end=datetime(2020, 12, 31),
    units=(UnitWindow("PICU", "100", date(2019, 1, 1), date(2021, 1, 1)),
           UnitWindow("CICU", "200", date(2020, 1, 1), date(2020, 6, 30)),
           UnitWindow("PERIOP", "900", date(2019, 1, 1), date(2021, 1, 1))),
    vital_ids=(MeasureId("10", "PULSE OXIMETRY"), MeasureId("8", "PULSE")),
    intervention_ids=(MeasureId("77", "VENT"),),
    network_departments=("PICU NORTH",),
    department_patterns=("%NORTH%", "%WARD%"),
)


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


A, D, TI, TO = "1", "2", "3", "4"   # event type codes
ORIG, CANC = "1", "2"               # event subtype codes

# enc -> (patient, [(seq, type, subtype, dept, time)])
ENCOUNTERS = {
    1001: ("P1", [(1, A, ORIG, 500, "2020-03-01 08:00"), (2, TO, ORIG, 500, "2020-03-01 09:00"),
                  (3, TI, ORIG, 100, "2020-03-01 09:00"), (4, TO, ORIG, 100, "2020-03-01 15:00"),
                  (5, TI, ORIG, 500, "2020-03-01 15:00"), (6, D, ORIG, 500, "2020-03-01 20:00")]),
    # operating-room trip bridged: one PICU stay 08-18
    1002: ("P2", [(1, A, ORIG, 100, "2020-04-01 08:00"), (2, TO, ORIG, 100, "2020-04-01 10:00"),
                  (3, TI, ORIG, 900, "2020-04-01 10:00"), (4, TO, ORIG, 900, "2020-04-01 12:00"),
                  (5, TI, ORIG, 100, "2020-04-01 12:00"), (6, D, ORIG, 100, "2020-04-01 18:00")]),
    # two stays (PICU 08-10, CICU 12-18); patient dies (disposition 20)
    1003: ("P3", [(1, A, ORIG, 100, "2020-05-01 08:00"), (2, TO, ORIG, 100, "2020-05-01 10:00"),
                  (3, TI, ORIG, 500, "2020-05-01 10:00"), (4, TO, ORIG, 500, "2020-05-01 12:00"),
                  (5, TI, ORIG, 200, "2020-05-01 12:00"), (6, D, ORIG, 200, "2020-05-01 18:00")]),
    # NULL subtype on the only admission: never seeded
    1004: ("P4", [(1, A, None, 100, "2020-05-02 08:00"), (2, D, ORIG, 100, "2020-05-02 18:00")]),
    # canceled admission ignored; seeded by the transfer in; stay 09-18
    1005: ("P5", [(1, A, CANC, 100, "2020-05-03 08:00"), (2, TI, ORIG, 100, "2020-05-03 09:00"),
                  (3, D, ORIG, 100, "2020-05-03 18:00")]),
    # admission exactly at the study start: excluded (bounds are exclusive)
    1006: ("P6", [(1, A, ORIG, 100, "2020-01-01 00:00"), (2, D, ORIG, 100, "2020-01-01 12:00")]),
    # CICU after its close date: not seeded
    1007: ("P7", [(1, A, ORIG, 200, "2020-08-01 08:00"), (2, D, ORIG, 200, "2020-08-01 12:00")]),
    # single stay ending with the hospital stay; patient dies in the unit
    1008: ("P8", [(1, A, ORIG, 100, "2020-06-01 08:00"), (2, D, ORIG, 100, "2020-06-02 08:00")]),
}

DISPOSITION = {1001: "1", 1002: "1", 1003: "20", 1005: None, 1008: "20"}

SCHEMAS = {
    "CLARITY_ADT": "EVENT_ID long, PAT_ENC_CSN_ID long, PAT_ID string, EFFECTIVE_TIME "
                   "timestamp_ntz, EVENT_TIME timestamp_ntz, SEQ_NUM_IN_ENC long, EVENT_TYPE_C "
                   "string, EVENT_SUBTYPE_C string, DEPARTMENT_ID long, ROOM_ID long, "
                   "PAT_CLASS_C string",
    "PATIENT": "PAT_ID string, PAT_LAST_NAME string, PAT_FIRST_NAME string, PAT_MRN_ID string, "
               "BIRTH_DATE timestamp_ntz, SEX_C string",
    "PAT_ENC": "PAT_ENC_CSN_ID long, PAT_ID string, HSP_ACCOUNT_ID long, "
               "HOSP_ADMSN_TIME timestamp_ntz",
    "PAT_ENC_HSP": "PAT_ENC_CSN_ID long, PAT_ID string, INPATIENT_DATA_ID long, "
                   "DISCH_DISP_C string",
    "CLARITY_DEP": "DEPARTMENT_ID long, DEPARTMENT_NAME string, REV_LOC_ID long, "
                   "ADT_UNIT_TYPE_C string, LICENSED_BEDS string, IS_PERIOP_DEP_YN string",
    "CLARITY_LOC": "LOC_ID long, LOC_NAME string, RECORD_STATUS string",
    "ED_ROOM_INFO": "ROOM_ID long, ROOM_NAME string",
    "PATIENT_RACE": "PAT_ID string, PATIENT_RACE_C string",
    "ETHNIC_BACKGROUND": "PAT_ID string, ETHNIC_BKGRND_C string",
    "PAT_ENC_DX": "PAT_ENC_CSN_ID long, CONTACT_DATE timestamp_ntz, DX_ID long, "
                  "PRIMARY_DX_YN string",
    "PAT_ENC_HOSP_PROB": "PAT_ENC_CSN_ID long, PROBLEM_LIST_ID long, PRINCIPAL_PROB_YN string",
    "PROBLEM_LIST": "PROBLEM_LIST_ID long, NOTED_DATE timestamp_ntz, RESOLVED_DATE "
                    "timestamp_ntz, DX_ID long",
    "HSP_ACCOUNT": "HSP_ACCOUNT_ID long, ADM_DATE_TIME timestamp_ntz, LAST_INTRM_BILL_DT "
                   "timestamp_ntz",
    "HSP_ACCT_DX_LIST": "HSP_ACCOUNT_ID long, DX_ID long",
    "F_ED_ENCOUNTERS": "PAT_ENC_CSN_ID long, ED_DISPOSITION_DTTM timestamp_ntz, "
                       "PRIMARY_DX_ID long, PRIMARY_DX_ED_YN string",
    "CLARITY_EDG": "DX_ID long, DX_NAME string, CURRENT_ICD10_LIST string",
    "ORDER_RESULTS": "ORDER_PROC_ID long, PAT_ENC_CSN_ID long, COMPONENT_ID long, "
                     "COMPON_LNC_ID long, RESULT_TIME timestamp_ntz, ORD_VALUE string",
    "ORDER_PROC": "ORDER_PROC_ID long, ORDER_TIME timestamp_ntz",
    "ORDER_PROC_2": "ORDER_PROC_ID long, SPECIMN_TAKEN_TIME timestamp_ntz",
    "CLARITY_COMPONENT": "COMPONENT_ID long, NAME string, LOINC_CODE string, DFLT_UNITS string",
    "LNC_DB_MAIN": "RECORD_ID long, LNC_CODE string, LNC_FULL_NAM string",
    "IP_FLWSHT_MEAS": "FSD_ID string, FLO_MEAS_ID string, RECORDED_TIME timestamp_ntz, "
                      "MEAS_VALUE string, DOCUMENTATION_SOURCE_C string",
    "IP_FLWSHT_REC": "FSD_ID string, INPATIENT_DATA_ID long",
    "IP_FLO_GP_DATA": "FLO_MEAS_ID string, FLO_MEAS_NAME string, DISP_NAME string, UNITS string",
    "MAR_ADMIN_INFO": "ORDER_MED_ID long, LINE long, TAKEN_TIME timestamp_ntz, SAVED_TIME "
                      "timestamp_ntz, SIG string, INFUSION_RATE string, MAR_DURATION string, "
                      "MAR_ACTION_C string, ROUTE_C string, REASON_C string, "
                      "MAR_TIME_SOURCE_C string, MAR_INF_RATE_UNIT_C string, DOSE_UNIT_C "
                      "string, MAR_DURATION_UNIT_C string, MAR_ADMIN_DEPT_ID long",
    "ORDER_MED": "ORDER_MED_ID long, PAT_ID string, PAT_ENC_CSN_ID long, MEDICATION_ID long, "
                 "DESCRIPTION string, DISPLAY_NAME string, ORDER_STATUS_C string",
    "ORDER_MEDINFO": "ORDER_MED_ID long, DISPENSABLE_MED_ID long",
    "CLARITY_MEDICATION": "MEDICATION_ID long, NAME string, ROUTE string, THERA_CLASS_C string, "
                          "PHARM_CLASS_C string, PHARM_SUBCLASS_C string, SIMPLE_GENERIC_C "
                          "string",
    "RXNORM_CODES": "MEDICATION_ID long, RXNORM_CODE string, RXNORM_CODE_LEVEL_C string, "
                    "RXNORM_TERM_TYPE_C string",
    "RX_MED_INGRED_ID": "MEDICATION_ID long, INGRED_ID long, LINE int",
    "RX_MED_MIX_COMPON": "MEDICATION_ID long, DRUG_ID long, LINE int, TYPE_C string",
    "DRUG_PRODUCTION": "MEDICATION_ID long, DRUG_PRODUCTION_ID long, LINE int",
    "CLARITY_NDC_CODES": "MEDICATION_ID long, NDC_CODE string, LINE int",
    "RX_NDC": "NDC_CODE string, RAW_NDC_CODE string",
}

CATEGORY_KEYS = {  # code -> NAME category tables (some carry INTERNAL_ID)
    "ZC_EVENT_TYPE": ("EVENT_TYPE_C", [(A, "Admission"), (D, "Discharge"), (TI, "Transfer In"),
                                       (TO, "Transfer Out"), ("5", "Census")]),
    "ZC_EVENT_SUBTYPE": ("EVENT_SUBTYPE_C", [(ORIG, "Original"), (CANC, "Canceled")]),
    "ZC_DISCH_DISP": ("DISCH_DISP_C", [("1", "Home"), ("20", "Expired")]),
    "ZC_SEX": ("RCPT_MEM_SEX_C", [("1", "Female"), ("2", "Male")]),
    "ZC_PATIENT_RACE": ("PATIENT_RACE_C", [("1", "White"), ("2", "Asian"), ("3", "Black")]),
    "ZC_ETHNIC_BKGRND": ("ETHNIC_BKGRND_C", [("1", "Hispanic"), ("2", "Not Hispanic")]),
    "ZC_FLO_DOC_SRC": ("DOCUMENTATION_SOURCE_C", [("1", "Device"), ("2", "Manual")]),
    "ZC_ADT_UNIT_TYPE": ("ADT_UNIT_TYPE_C", [("1", "ICU"), ("2", "WARD")]),
    "ZC_MAR_TIME_SRC": ("MAR_TIME_SRC_C", [("1", "Scanned")]),
    "ZC_MAR_RSN": ("REASON_C", [("1", "Pain")]),
    "ZC_ORDER_STATUS": ("ORDER_STATUS_C", [("2", "Sent"), ("5", "Completed")]),
    "ZC_INGRED_TYPE": ("DISP_CTYPE_C", [("1", "Base"), ("2", "Additive")]),
    "ZC_RXNORM_CODE_LEVEL": ("RXNORM_CODE_LEVEL_C", [("1", "Ingredient"), ("2", "Product")]),
    "ZC_RXNORM_TERM_TYPE": ("RXNORM_TERM_TYPE_C", [("1", "IN"), ("2", "BN"), ("3", "SCD")]),
}
CODED_CATEGORIES = {  # with INTERNAL_ID
    "ZC_MAR_RSLT": ("RESULT_C", [("1", "Given", "101"), ("2", "Held", "102")]),
    "ZC_ADMIN_ROUTE": ("MED_ROUTE_C", [("1", "Oral", "201"), ("2", "IV", "202")]),
    "ZC_MED_UNIT": ("DISP_QTYUNIT_C", [("1", "mg", "301"), ("2", "mL/hr", "302")]),
    "ZC_MED_DURATION_UN": ("MED_DURATION_UN_C", [("1", "Minutes", "401")]),
    "ZC_THERA_CLASS": ("THERA_CLASS_C", [("T1", "Analgesic", "501")]),
    "ZC_PHARM_CLASS": ("PHARM_CLASS_C", [("P1", "Opioid", "601")]),
    "ZC_PHARM_SUBCLASS": ("PHARM_SUBCLASS_C", [("S1", "Opioid agonist", "701")]),
    "ZC_SIMPLE_GENERIC": ("SIMPLE_GENERIC_C", [("G1", "Morphine", "801")]),
}


def rows() -> dict[str, list[tuple]]:
    r: dict[str, list[tuple]] = {k: [] for k in SCHEMAS}
    eid = 0
    for enc, (pat, events) in ENCOUNTERS.items():
        for seq, typ, sub, dept, t in events:
            eid += 1
            r["CLARITY_ADT"].append((eid, enc, pat, ts(t), ts(t), seq, typ, sub, dept,
                                     dept * 10, "1"))
        # encounter 1005's inpatient record points at a patient missing from PATIENT
        r["PAT_ENC_HSP"].append((enc, "PX" if enc == 1005 else pat, enc + 50000,
                                 DISPOSITION.get(enc)))
        r["PAT_ENC"].append((enc, pat, enc + 70000, ts(events[0][4])))
    for i, pat in enumerate(["P1", "P2", "P3", "P4", "P5", "P6", "P7", "P8"]):
        r["PATIENT"].append((pat, f"Last{i}", f"First{i}", f"MRN{i}",
                             ts("2015-06-15 00:00"), "1" if i % 2 else "2"))
    r["CLARITY_DEP"] = [(100, "PICU NORTH", 1, "1", "12", "N"), (200, "CICU", 1, "1", None, None),
                        (500, "WARD 5", 2, "2", "0", "N"), (900, "OR", 3, None, None, "Y"),
                        (600, "CLOSED WARD", 4, "2", "4", "N")]
    r["CLARITY_LOC"] = [(1, "MAIN", "1"), (2, "ANNEX", None), (3, "SURGERY", "0"),
                        (4, "OLD", "0")]
    r["ED_ROOM_INFO"] = [(1000, "PICU-1"), (2000, "CICU-2"), (5000, "W-5"), (9000, "OR-9")]
    r["PATIENT_RACE"] = [("P3", "3"), ("P3", "1"), ("P2", "2")]
    r["ETHNIC_BACKGROUND"] = [("P3", "2")]
    # diagnoses: encounter 1002 has the same (dx, start, end) from two sources
    r["PAT_ENC_DX"] = [(1002, ts("2020-04-01 00:00"), 11, "Y"), (1002, ts("2020-04-01 00:00"),
                                                                 12, "N"),
                       (1003, ts("2020-05-01 00:00"), None, "Y"),
                       (9999, ts("2020-05-01 00:00"), 11, "Y")]
    r["PAT_ENC_HOSP_PROB"] = [(1002, 1, "Y"), (1003, 2, "Y")]
    r["PROBLEM_LIST"] = [(1, ts("2020-04-01 00:00"), ts("2020-04-01 00:00"), 12),
                         (2, ts("2020-05-01 00:00"), None, 13)]
    r["HSP_ACCOUNT"] = [(71002, ts("2020-04-01 00:00"), ts("2020-04-03 00:00"))]
    r["HSP_ACCT_DX_LIST"] = [(71002, 11), (71002, 13)]
    r["F_ED_ENCOUNTERS"] = [(1008, ts("2020-06-01 07:00"), 11, "Y"),
                            (1008, ts("2020-06-01 07:30"), 12, "N")]
    r["CLARITY_EDG"] = [(11, "Sepsis", "A41.9"), (12, "Asthma", "J45.909"),
                        (13, "Fracture", "S72.001A")]
    # labs: LOINC via result, via component only, via neither; one result w/o order
    r["ORDER_RESULTS"] = [(1, 1002, 501, 9001, ts("2020-04-01 09:00"), "7.4"),
                          (2, 1002, 502, None, ts("2020-04-01 10:00"), "140"),
                          (3, 1003, 503, None, ts("2020-05-01 09:00"), "POS"),
                          (4, 1003, 501, None, ts("2020-05-01 09:30"), "7.3"),
                          (5, 7777, 501, 9001, ts("2020-05-01 09:30"), "7.1")]
    r["ORDER_PROC"] = [(1, ts("2020-04-01 08:30")), (2, ts("2020-04-01 08:40")),
                       (3, ts("2020-05-01 08:50"))]
    r["ORDER_PROC_2"] = [(1, ts("2020-04-01 08:45")), (4, ts("2020-05-01 09:00"))]
    r["CLARITY_COMPONENT"] = [(501, "pH", None, "pH"), (502, "Sodium", "2951-2", "mmol/L"),
                              (503, "Culture", None, None)]
    r["LNC_DB_MAIN"] = [(9001, "11558-4", "pH of Blood")]
    # flowsheets: id in list / not in list / no record / no patient / pre-birth
    r["IP_FLWSHT_MEAS"] = [("F1", "10", ts("2020-04-01 09:00"), "98", "1"),
                           ("F1", "8", ts("2020-04-01 09:00"), "120", "2"),
                           ("F1", "99", ts("2020-04-01 09:00"), "x", "1"),
                           ("F2", "10", ts("2020-05-01 11:00"), "97", None),
                           ("F9", "10", ts("2020-05-01 11:00"), "90", "1"),
                           ("F3", "77", ts("2020-05-03 10:00"), "ON", "2"),
                           ("F4", "10", ts("2010-01-01 00:00"), "50", "1"),
                           ("F4", "8", ts("2020-06-01 08:00"), "110", "1"),
                           ("F4", "8", ts("2020-06-02 08:00"), "111", "1")]
    r["IP_FLWSHT_REC"] = [("F1", 51002), ("F2", 51003), ("F3", 51005), ("F4", 51008)]
    r["IP_FLO_GP_DATA"] = [("10", "SpO2", "Pulse Ox", "%"), ("8", "Pulse", "Pulse", "bpm"),
                           ("77", "Vent", "Ventilation", None)]
    # medications
    r["ORDER_MED"] = [(1, "P2", 1002, 10, "MORPHINE INJ", "Morphine", "2"),
                      (2, "P3", 1003, 20, "ACETAMINOPHEN", "Tylenol", "5"),
                      (3, "P3", 1003, 30, "MIX", "Mix", "5"),
                      (4, "P9", 8888, 10, "OUTSIDE", "Outside", "5"),
                      (5, "P5", 1005, 40, "NO DISPENSE", "Nothing", "5")]
    r["ORDER_MEDINFO"] = [(1, 10), (2, 20), (3, 30), (4, 10)]
    adm = "2020-04-01 09:00"
    r["MAR_ADMIN_INFO"] = [
        (1, 1, ts(adm), ts(adm), "2", "5", "30", "1", "2", "1", "1", "2", "1", "1", 100),
        (1, 1, ts(adm), ts(adm), "2", "5", "30", "1", "2", "1", "1", "2", "1", "1", 100),
        (2, 1, ts("2020-05-01 09:00"), ts("2020-05-01 09:01"), "500", None, None, "2", "1",
         None, None, None, "1", None, 200),
        (3, 1, ts("2020-05-01 10:00"), ts("2020-05-01 10:00"), "1", None, None, "1", "2",
         None, None, None, None, None, 200),
        (4, 1, ts("2020-05-01 10:00"), ts("2020-05-01 10:00"), "1", None, None, "1", "2",
         None, None, None, None, None, 200),
        (5, 1, ts("2020-05-03 10:00"), ts("2020-05-03 10:00"), "1", None, None, "1", "1",
         None, None, None, None, None, 100),
    ]
    # 10 morphine (direct RxNorm: term type 3 beats 1; a level-2 row with the same type
    # re-enters after the join-back), 20 acetaminophen (no direct code; its ingredient
    # 21 has one), 30 mixture (component 31 -> ingredient 32; production 33 ->
    # component 34; nothing links), 21 -> 22 ingredient of ingredient, 22 -> 23 (third
    # level, must not appear)
    r["CLARITY_MEDICATION"] = [(10, "MORPHINE", "IV", "T1", "P1", "S1", "G1"),
                               (20, "ACETAMINOPHEN", "PO", "T1", None, "S9", None),
                               (30, "MIXTURE", "IV", None, None, None, None),
                               (21, "APAP INGRED", "PO", None, None, None, None)]
    r["RXNORM_CODES"] = [(10, "7052", "1", "1"), (10, "1730193", "1", "3"),
                         (10, "9999999", "2", "3"), (10, "1111", "1", None),
                         (21, "161", "1", "1"), (40, None, "1", "1")]
    r["RX_MED_INGRED_ID"] = [(20, 21, 1), (21, 22, 1), (22, 23, 1), (31, 32, 1)]
    r["RX_MED_MIX_COMPON"] = [(30, 31, 1, "1"), (33, 34, 2, "3")]
    r["DRUG_PRODUCTION"] = [(30, 33, 1)]
    r["CLARITY_NDC_CODES"] = [(10, "0409-1890", 1), (20, "NO-RAW", 1)]
    r["RX_NDC"] = [("0409-1890", "00409189001")]
    return r


def catalog(spark) -> SourceCatalog:
    tables = {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in rows().items()}
    for name, (key, vals) in CATEGORY_KEYS.items():
        tables[name] = spark.createDataFrame(vals, f"{key} string, NAME string")
    for name, (key, vals) in CODED_CATEGORIES.items():
        tables[name] = spark.createDataFrame(vals, f"{key} string, NAME string, "
                                                   f"INTERNAL_ID string")
    return SourceCatalog(spark, tables=tables)
