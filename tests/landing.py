"""A small landing zone with the dirt the rules look for."""

from __future__ import annotations

import csv
from pathlib import Path

from dqlake.plans.schemas import FEEDS, MASTERS

MASTER_ROWS = {
    "dim_institution": [("INST-1", "General", "Boston", "USA", "NA"), (" inst-2 ", "Charite", "Berlin", "Germany", "EU")],
    "dim_sponsor": [("SP-1", "Acme", "Pharma", "USA", "Boston")],
    "dim_product": [("PRD-1", "SP-1", "P1", "Drug", "a", "small", "x", "ACTIVE"),
                    ("PRD-999", "-", "P9", "Placebo", "-", "-", "-", "ACTIVE")],
    "ref_country_region": [("USA", "North America"), ("Germany", "Europe"), ("FRANCE", "Europe")],
    "ref_geography": [("Boston", "USA", "US East"), ("BOSTON", "usa", "US East")],
    "dim_site": [("101-001", "101", "INST-1", "A", "USA", "boston ", "Dr X", "20", "2026-01-05", "active"),
                 ("101-002", "101", "INST-2", "B", "germany", "Berlin", "Dr Y", "10", "bad", "active"),
                 ("102-001", "102", "INST-2", "C", "Spain", "Madrid", "Dr Z", "x", "2026-02-01", "Closed")],
    "dim_study": [("101", "Alpha", "PR-1", "onc", "II", "D001", "SP-1", "50", "2026-01-01", "2027-01-01", "open", "1"),
                  (" 102", "Beta", "PR-2", "onc", "III", "D002", "SP-1", "50", "2026-01-01", "2027-01-01", "open", "1")],
    "dim_study_arm": [("101", "A", "Active", "PRD-1", "test", "10", "mg", "daily", "50"),
                      ("101", "b ", "Placebo", "PRD-999", "control", "0", "mg", "daily", "50"),
                      ("102", "A", "Active", "PRD-1", "test", "10", "mg", "daily", "90")],
    "ref_diagnosis": [(f"D00{i}", f"Condition {i}") for i in range(1, 10)],
    "ref_lab_test": [("GLUC", "Glucose", "mg/dL", "70", "100"), ("HGB", "Haemoglobin", "g/dL", "12", "16")],
    "ref_severity": [("Mild", "MILD", "1"), ("MILD", "MILD", "1"), ("1", "MILD", "1"), ("SEVERE", "SEVERE", "3")],
    "ref_sex": [(v, "M") for v in ("m", "M", "MALE", "Male", "1")] + [(v, "F") for v in ("f", "F", "FEMALE", "2")],
    "ref_unit": [("GLUC", "mg/dL", "mg/dL", "1"), ("GLUC", "MG/DL", "mg/dL", "1"), ("GLUC", "mmol/L", "mg/dL", "18"),
                 ("HGB", "g/dL", "g/dL", "1"), ("HGB", "g/L", "g/dL", "0.1")],
}


def subject(id, study="101", site="101-001", screen="2026-01-10", enrol="2026-01-20", status="ENROLLED",
            age="40", sex="M", dx="D001", arm="A", rand="2026-01-21", consent="2026-01-10", gone="", why=""):
    return (id, study, site, screen, enrol, status, age, sex, dx, arm, rand, consent, gone, why)


FEED_ROWS = {
    ("subjects", "20260825"): [
        subject(" s-1 "), subject("S-2", sex="2"), subject("S-3", status="SCREENING", enrol="", arm="", rand=""),
        subject("", age="41"), subject("S-5", study="", site="S8888"), subject("S-6", age="16"),
        subject("S-7", consent="2026-02-01"), subject("S-8", sex="unknown"), subject("S-9", site="102-001"),
    ],
    # S-1 unchanged, S-2 completes.
    ("subjects", "20260827"): [subject("S-1"), subject("S-2", sex="f", status="completed")],
    ("subjects", "bad"): [subject("S-10")],
    ("visits", "20260826"): [
        ("V-1", "s-1", "101", "101-001", "Baseline", "1", "2026-01-20", "Done", "0"),
        ("V-2", "S-1", "101", "101-001", "Week 4", "2", "", "missed", "n/a"),
        ("V-3", "S-2", "101", "101-001", "Baseline", "1", "", "COMPLETED", "0"),
        ("V-4", "S-404", "101", "101-001", "Baseline", "1", "2026-01-20", "?", "0"),
        ("V-5", "S-2", "102", "101-002", "Baseline", "1", "2026-01-20", "Rescheduled", "3"),
    ],
    ("lab_results", "20260826"): [
        ("L-1", "S-1", "101", "V-1", "gluc", "Glucose", "5", "mmol/L", "3", "6", "N", "20-JAN-2026", "lab a"),
        ("L-2", "S-1", "101", "V-1", "GLUC", "Glucose", "60", "MG/DL", "70", "100", "N", "20-JAN-2026", "lab a"),
        ("L-3", "S-1", "101", "V-1", "HGB", "Hb", "high", "g/L", "120", "160", "", "20-JAN-2026", "lab a"),
        ("L-4", "S-2", "101", "V-1", "XXX", "?", "1", "u", "", "", "Y", "2026-01-20", "lab a"),
        ("L-5", "S-1", "101", "V-3", "HGB", "Hb", "140", "g/L", "", "", "Y", "20-JAN-2026", "lab b"),
    ],
    ("adverse_events", "20260826"): [
        ("AE-1", "S-1", "101", "101-001", "Headache", "Nervous", "mild", "YES", "2026-02-01", "2026-01-01", "recovered", "no", "none"),
        ("AE-2", "S-2", "101", "101-001", "Stroke", "Nervous", "Severe", "n", "2026-02-01", "", "fatal", "no", "none"),
        ("AE-3", "S-2", "101", "101-001", "Pain", "-", "GRADE 4", "1", "01-FEB-2026", "", "", "no", "none"),
        ("AE-4", "S-2", "101", "102-001", "Pain", "-", "", "?", "", "", "", "no", "none"),
    ],
}

# The controlled delivery: three subjects go through, two are rejected by a named rule.
GOLDEN = [
    subject("101-001-DEMO06", age="33"), subject("101-001-DEMO07", age="46"),
    subject("101-001-DEMO08", age="31", status="SCREENING", enrol="", arm="", rand=""),
    subject("101-001-DEMO09", age="16"), subject("101-001-DEMO10", age="50", status="ACTIVE"),
]
GOLDEN_REJECTED = {"101-001-DEMO09": "age_out_of_range", "101-001-DEMO10": "invalid_subject_status"}

# An older delivery that arrives last: S-2 was first seen screening.
LATE = [subject("S-2", sex="F", status="SCREENING", enrol="", arm="", rand="")]


def write_csv(root: Path, folder: str, name: str, columns, data) -> None:
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    with open(path / name, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(data)


def deliver(root: Path, feed: str, stamp: str, data) -> None:
    spec = FEEDS[feed]
    write_csv(root, spec.folder, f"{feed}_{stamp}.csv", spec.columns, data)


def write_landing(root: Path) -> None:
    for name, data in MASTER_ROWS.items():
        spec = MASTERS[name]
        folder, name = spec.folder.rsplit("/", 1)
        if not name.endswith(".csv"):
            folder, name = spec.folder, f"{name}_20260907.csv"
        write_csv(root, folder, name, spec.columns, data)
    for (feed, stamp), data in FEED_ROWS.items():
        deliver(root, feed, stamp, data)
