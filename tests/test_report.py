from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import at, day
from pyspark.sql import functions as F

import __spark_entry__ as entry
from carelens.functions import blank_to_null
from carelens.plans import baseline, report, rules
from carelens.plans.report_columns import BLANK_COLUMNS, DATE_COLUMNS, REPORT_COLUMNS

END = "2024-06-30"
SCHEMA = """uuid string, State string, LGA string, FaciityName string, PatientHospitalNo string,
PatientUniqueID string, Sex string, DOB date, EnrollmentDate timestamp_ntz, TransferInStatus string,
ARTStartDate timestamp_ntz, LastPickupDate timestamp_ntz, DaysOfARVRefil int,
LastPickupDatePreviousQuarter timestamp_ntz, DrugDurationPreviousQuarter int,
InitialRegimenLine string, InitialRegimen string, CurrentRegimenLine string, CurrentRegimen string,
PregnancyStatus string, `CurrentViralLoad(c/ml)` double, ViralLoadReportedDate string,
LastViralLoadDate date, LastDateOfSampleCollection date, CurrentWeight_Kg double,
LastINHDispensedDate timestamp_ntz, OTZStartDate string, CurrentARTStatus string,
PatientOutcomeDate timestamp_ntz, CauseOfDeath string, OtherCauseOfDeath string,
DiscontinuedCareReason string, DateReturnedToCare timestamp_ntz, ARTStatusPreviousQuarter string,
PatientOutcomeDatePreviousQuarter timestamp_ntz, PreviousARTStatus string,
PreviousARTStatusDate timestamp_ntz, BiometricCaptured string, BiometricCaptureDate date"""
NAMES = [f.strip().rsplit(" ", 1)[0].strip("`") for f in SCHEMA.replace("\n", " ").split(",")]
BASE_SCHEMA = """LGA string, Facility string, `Hospital Number` string, `Unique ID` string,
`Patient ID` string, `Months of ARV Refill` double, `Last Pickup Date (yyyy-mm-dd)` date,
`Current ART Status` string, `Current Viral Load (c/ml)` double,
`Date of Current Viral Load (yyyy-mm-dd)` date,
`Date of Viral Load Sample Collection (yyyy-mm-dd)` date, `Case Manager` string,
`ART Enrollment Setting` string, `Date Commenced DMOC (yyyy-mm-dd)` date, `Type of DMOC` string,
`Date of Return of DMOC Client to Facility (yyyy-mm-dd)` date,
`Date of TPT Start (yyyy-mm-dd)` date, `TPT Type` string,
`TPT Completion date (yyyy-mm-dd)` date"""
BASE_NAMES = [f.strip().rsplit(" ", 1)[0].strip("`") for f in BASE_SCHEMA.replace("\n", " ").split(",")]


def lines(spark, *rows):
    full = [{"uuid": f"u{i}", "PatientHospitalNo": str(i), "LGA": "L", "FaciityName": "F",
             "CurrentARTStatus": "Active", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in full], SCHEMA)


def base(spark, *rows):
    full = [{"LGA": "L", "Facility": "F", "Unique ID": None, **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in BASE_NAMES) for r in full], BASE_SCHEMA)


def reported(spark, *rows, **options):
    out = report.programme_report(lines(spark, *rows), END, **options)
    return [r.asDict() for r in out.orderBy("`S/No.`").collect()]


def test_columns(spark):
    df = report.programme_report(lines(spark, {}), END)
    assert df.columns == [h for _, h in REPORT_COLUMNS] and len(df.columns) == 66
    assert len(BLANK_COLUMNS) == 34 and len(DATE_COLUMNS) == 23
    kinds = dict(df.dtypes)
    headings = dict(REPORT_COLUMNS)
    assert all(kinds[headings[c]] == "date" for c in DATE_COLUMNS)


def test_active_patient(spark):
    row, = reported(spark, {"LastPickupDate": at("2024-05-03"), "DaysOfARVRefil": 30, "Sex": "M",
                            "InitialRegimenLine": "Child 2nd line ARV regimen"})
    assert row["Sex"] == "Male" and row["Months of ARV Refill"] == 1.0
    assert row["Regimen Line at ART Start"] == "Peds.2nd.Line"
    assert row["Date of Current ART Status (yyyy-mm-dd)"] == day("2024-05-03")
    assert row["IIT Chance (%)"] == pytest.approx(28 / 29)
    assert row["Date calculated (yyyy-mm-dd)"] == day("2024-07-01")
    assert row["S/No."] == 1


def test_lost_patient(spark):
    row, = reported(spark, {"LastPickupDate": at("2024-01-01"), "DaysOfARVRefil": 30,
                            "CurrentARTStatus": "LTFU"})
    assert row["Current ART Status"] == "IIT"
    assert row["Date of Current ART Status (yyyy-mm-dd)"] == day("2024-02-29")
    assert row["IIT Chance (%)"] is None


def test_restart_wins_over_transfer(spark):
    row, other = reported(
        spark,
        {"DateReturnedToCare": at("2024-06-01"), "TransferInStatus": "Transfer in with records",
         "PreviousARTStatus": "Active"},
        {"TransferInStatus": "Transfer in with records", "LastPickupDate": at("2024-06-02")})
    assert row["Current ART Status"] == "Active-Restart"
    assert row["Date of Current ART Status (yyyy-mm-dd)"] == day("2024-06-01")
    assert row["Status at Registration"] == "ART Transfer In"
    assert row["Previous ART Status"] == "Active-Transfer In"
    assert other["Current ART Status"] == "Active-Transfer In"


def test_new_patient(spark):
    row, = reported(spark, {"LastPickupDate": at("2024-06-02"), "ARTStartDate": at("2024-06-02"),
                            "EnrollmentDate": at("2024-05-30")})
    assert row["Previous ART Status"] == "HIV+ non ART"
    assert row["Confirmed Date of Previous ART Status (yyyy-mm-dd)"] == day("2024-05-30")


def test_blank_return_date_is_missing(spark):
    df = lines(spark, {}).withColumn("DateReturnedToCare", F.lit(""))
    row = report.programme_report(df, END).first()
    assert row["Current ART Status"] == "Active"


def test_viral_load_date_is_the_newer_one(spark):
    found = reported(
        spark,
        {"ViralLoadReportedDate": "03-May-2024", "LastViralLoadDate": day("2024-04-01"), "CurrentViralLoad(c/ml)": 1000.0},
        {"ViralLoadReportedDate": "unknown", "LastViralLoadDate": day("2024-04-01"), "CurrentViralLoad(c/ml)": 1001.0},
        {"CurrentViralLoad(c/ml)": 5.0})
    dates = [r["Date of Current Viral Load (yyyy-mm-dd)"] for r in found]
    assert dates == [day("2024-05-03"), day("2024-04-01"), None]
    assert [r["Viral Load Indication"] for r in found] == ["Routine - Routine", "Targeted - Post EAC", None]


def test_capture_flag_is_reported_as_validity(spark):
    row, = reported(spark, {"BiometricCaptured": "Yes"})
    assert row["Valid Biometrics Enrolled?"] == "Yes"


def test_quarter_status_source(spark):
    row, = reported(spark, {"ARTStatusPreviousQuarter": "LTFU", "LastPickupDatePreviousQuarter": at("2024-01-01"),
                            "DrugDurationPreviousQuarter": 30, "PreviousARTStatus": "Active"},
                    status_source="previous_quarter")
    assert row["Previous ART Status"] == "IIT"
    assert row["Confirmed Date of Previous ART Status (yyyy-mm-dd)"] == day("2024-02-29")


def test_serial_numbers_follow_the_hospital_number(spark):
    found = reported(spark, {"PatientHospitalNo": "b"}, {"PatientHospitalNo": None}, {"PatientHospitalNo": "a"})
    assert [(r["S/No."], r["Hospital Number"]) for r in found] == [(1, None), (2, "a"), (3, "b")]


def merged(spark, line, earlier, **options):
    df = report.programme_report_with_baseline(lines(spark, *line), base(spark, *earlier), END, **options)
    return [r.asDict() for r in df.orderBy("`S/No.`").collect()]


def test_baseline_value_needs_a_value_but_the_date_does_not(spark):
    row, = merged(
        spark, [{"PatientHospitalNo": "1", "LastViralLoadDate": day("2024-01-01"), "CurrentViralLoad(c/ml)": 50.0}],
        [{"Hospital Number": "1", "Date of Current Viral Load (yyyy-mm-dd)": day("2024-02-01")}])
    assert row["Current Viral Load (c/ml)"] == 50.0
    assert row["Date of Current Viral Load (yyyy-mm-dd)"] == day("2024-02-01")


def test_baseline_value_fills_a_missing_date_even_with_nothing(spark):
    row, = merged(
        spark, [{"PatientHospitalNo": "1", "CurrentViralLoad(c/ml)": 50.0}],
        [{"Hospital Number": "1", "Date of Current Viral Load (yyyy-mm-dd)": day("2024-02-01")}])
    assert row["Current Viral Load (c/ml)"] is None


def test_newer_baseline_wins_and_columns_are_taken(spark):
    row, = merged(
        spark,
        [{"PatientHospitalNo": "001", "LastViralLoadDate": day("2024-01-01"), "CurrentViralLoad(c/ml)": 50.0,
          "LastINHDispensedDate": at("2024-01-01"), "LastDateOfSampleCollection": day("2024-05-01")}],
        [{"Hospital Number": "1", "Current Viral Load (c/ml)": 2000.0, "Patient ID": "P7", "Case Manager": "CM",
          "Date of Current Viral Load (yyyy-mm-dd)": day("2024-02-01"),
          "Date of Viral Load Sample Collection (yyyy-mm-dd)": day("2024-02-01"),
          "Date of TPT Start (yyyy-mm-dd)": day("2024-03-01"), "TPT Type": "3HP"}])
    assert (row["Current Viral Load (c/ml)"], row["Viral Load Indication"]) == (2000.0, "Targeted - Post EAC")
    assert row["Date of Viral Load Sample Collection (yyyy-mm-dd)"] == day("2024-05-01")
    assert row["Date of TPT Start (yyyy-mm-dd)"] == day("2024-03-01")
    assert (row["Patient id"], row["Case Manager"], row["TPT Type"]) == ("P7", "CM", "3HP")


def test_zeros_are_stripped_on_one_side_only(spark):
    row, = merged(spark, [{"PatientHospitalNo": "001"}], [{"Hospital Number": "001", "Case Manager": "CM"}])
    assert row["Case Manager"] is None


def test_repeated_keys_never_match(spark):
    listed = [{"PatientHospitalNo": "1"}, {"PatientHospitalNo": "01"}, {"PatientHospitalNo": "2"}]
    earlier = [{"Hospital Number": "1", "Case Manager": "a"}, {"Hospital Number": "2", "Case Manager": "b"},
               {"Hospital Number": "2", "Case Manager": "c"}]
    assert [r["Case Manager"] for r in merged(spark, listed, earlier)] == [None, None, None]


def test_lost_patient_stays_lost_unless_asked(spark):
    line = [{"PatientHospitalNo": "1", "CurrentARTStatus": "LTFU", "LastPickupDate": at("2024-05-20"),
             "DaysOfARVRefil": 10}]
    earlier = [{"Hospital Number": "1", "Current ART Status": "Active", "Months of ARV Refill": None,
                "Last Pickup Date (yyyy-mm-dd)": day("2024-06-01")}]
    assert merged(spark, line, earlier)[0]["Current ART Status"] == "IIT"
    again, = merged(spark, line, earlier, reactivate_from_baseline=True)
    assert again["Current ART Status"] == "Active(A)"
    assert again["IIT Chance (%)"] == pytest.approx(31 / 29)


def test_an_emitted_report_is_a_baseline(spark):
    first = report.programme_report(lines(spark, {"PatientHospitalNo": "1"}), END)
    again = report.programme_report_with_baseline(lines(spark, {"PatientHospitalNo": "1"}), first, END)
    assert again.count() == 1


def test_empty_baseline_changes_nothing(spark):
    rows = [{"LastPickupDate": at("2024-05-03"), "DaysOfARVRefil": 30, "CurrentViralLoad(c/ml)": 7.0,
             "LastViralLoadDate": day("2024-01-01")}, {"CurrentARTStatus": "LTFU"}]
    plain = reported(spark, *rows)
    assert merged(spark, rows, []) == plain


def test_separator_keeps_keys_apart(spark):
    line = [{"LGA": "ab", "FaciityName": "c", "PatientHospitalNo": "1"}]
    earlier = [{"LGA": "a", "Facility": "bc", "Hospital Number": "1", "Case Manager": "CM"}]
    assert merged(spark, line, earlier)[0]["Case Manager"] == "CM"
    assert merged(spark, line, earlier, key_sep="|")[0]["Case Manager"] is None


STATUS = """LastPickupDate timestamp_ntz, CurrentARTStatus string, PreviousLastPickupDate timestamp_ntz,
PreviousDaysOfARVRefil int, LastPickupDatePreviousQuarter timestamp_ntz, DrugDurationPreviousQuarter int,
PatientOutcomePreviousQuarter string, PatientOutcomeDatePreviousQuarter timestamp_ntz,
DateReturnedToCare timestamp_ntz"""


def statuses(spark, **values):
    names = [f.strip().rsplit(" ", 1)[0] for f in STATUS.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], STATUS)


@pytest.mark.parametrize(("values", "expected"), [
    ({"LastPickupDatePreviousQuarter": at("2024-02-01"), "DrugDurationPreviousQuarter": 30}, "Active"),
    ({"LastPickupDatePreviousQuarter": at("2024-01-31"), "DrugDurationPreviousQuarter": 30}, "LTFU"),
    ({"LastPickupDatePreviousQuarter": at("2024-02-01")}, "LTFU"),
    ({"LastPickupDatePreviousQuarter": at("2024-02-01"), "PatientOutcomePreviousQuarter": "Death"}, "Death"),
    ({}, None)])
def test_quarter_status(spark, values, expected):
    row = rules.quarter_status(statuses(spark, **values), "2024-06-30").first()
    assert row["ARTStatusPreviousQuarter"] == expected


def test_return_to_care_needs_an_active_patient(spark):
    values = {"LastPickupDate": at("2024-06-01"), "PreviousLastPickupDate": at("2024-01-01"),
              "PreviousDaysOfARVRefil": 30}
    back = rules.returned_to_care(statuses(spark, CurrentARTStatus="Active", **values)).first()
    lost = rules.returned_to_care(statuses(spark, CurrentARTStatus="LTFU", **values)).first()
    assert (back["DateReturnedToCare"], lost["DateReturnedToCare"]) == (at("2024-06-01"), None)


def test_unknown_refill_of_the_baseline_is_fifteen_days(spark):
    rows = base(spark, {"Hospital Number": "1", "Last Pickup Date (yyyy-mm-dd)": day("2024-05-17")},
                {"Hospital Number": "2", "Last Pickup Date (yyyy-mm-dd)": day("2024-05-16")},
                {"Hospital Number": "3", "Last Pickup Date (yyyy-mm-dd)": day("2024-06-16"),
                 "Current ART Status": "Dead"})
    found = baseline.revalidate(rows, "2024-06-30").orderBy("`Hospital Number`").collect()
    assert [r["status"] for r in found] == ["Active", "Inactive", "Inactive"]


def test_blank_cells(spark):
    df = spark.createDataFrame([("", "x", 1)], "`a b` string, c string, n int")
    assert blank_to_null(df).first() == (None, "x", 1)
    assert dt.date(2024, 1, 1) == day("2024-01-01")


def test_a_list_is_shuffled_once_to_meet_the_earlier_report(spark):
    """Keys alone look for earlier rows; the columns of the list move once, by their number."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = entry.queries()["programme_report_repeated"](spark, "/root/testdata/sf0.001")
    shape = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"hashpartitioning\(S/N\.#\d+L, \d+\)", shape)) == 1
    assert len(re.findall(r"hashpartitioning\(__(?:key|lettered)#", shape)) == 3
    assert "coalesce(__k" not in shape
