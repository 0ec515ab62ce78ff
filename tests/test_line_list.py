from __future__ import annotations

import pytest
from conftest import Clinic, at, day, rows_of
from pyspark.sql import functions as F

from carelens.plans.biometrics import biometric_status
from carelens.plans.line_list import LINE_LIST_COLUMNS, line_list
from carelens.plans.report import programme_report
from carelens.plans.tracking import pivot_tracking

START, END, NOW = "2024-04-01", "2024-06-30", "2024-06-30"


def listed(clinic, **options):
    return line_list(clinic.tables(), START, END, NOW, **options)


def one(clinic, **options):
    found = listed(clinic, **options).collect()
    assert len(found) == 1
    return found[0]


def test_columns_and_plain_patient(clinic):
    clinic.patient(1, "0012", gender="M")
    clinic.pickup(1, "2024-01-10", 30)
    clinic.pickup(1, "2024-03-01", 60)
    clinic.pickup(1, "2024-06-05", 30)
    df = listed(clinic)
    assert df.columns == list(LINE_LIST_COLUMNS)
    row = df.first()
    assert row["CurrentARTStatus"] == "Active"
    assert row["LastPickupDate"] == at("2024-06-05")
    assert row["LastVisitDate"] == "05-Jun-2024"
    assert (row["DaysOfARVRefil"], row["DrugDurationPreviousQuarter"]) == (30, 60)
    assert row["LastPickupDatePreviousQuarter"] == at("2024-03-01")
    assert row["ARTStatusPreviousQuarter"] == "Active"
    assert row["Next_Visit_Date"] == "05-Jul-2024" and row["Days_To_Schedule"] == 5
    assert row["Appointment_Status"] == "Active With Drugs"
    # 2024-03-01 + 60 + 29 = 2024-05-29, before the last pickup: the patient came back.
    assert row["PreviousARTStatus"] == "LTFU"
    assert row["PreviousARTStatusDate"] == at("2024-05-29")
    assert row["DateReturnedToCare"] == at("2024-06-05")


def test_observations_on_the_end_date_after_midnight_do_not_count(clinic):
    clinic.patient(1, "1")
    clinic.pickup(1, "2024-05-01", 30)
    clinic.pickup(1, "2024-06-30 09:00", 90)
    row = one(clinic)
    assert row["LastPickupDate"] == at("2024-05-01") and row["DaysOfARVRefil"] == 30


def test_patients_without_listed_observations_are_dropped(clinic):
    clinic.patient(1, "1")
    clinic.patient(2, "2")
    clinic.patient(3, "3", voided=1)
    clinic.obs(1, 160540, "2024-01-01", coded=1)
    clinic.obs(2, 5089, "2024-01-01", number=50.0)
    clinic.obs(3, 5089, "2024-01-01", number=50.0)
    assert one(clinic)["PatientHospitalNo"] == "2"


def test_columns_outside_the_list_stay_empty(clinic):
    clinic.patient(1, "1")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    clinic.obs(1, 160554, "2024-01-01", instant="2020-01-01")
    clinic.obs(1, 160534, "2024-01-01", instant="2020-01-01")
    row = one(clinic)
    assert row["HIVConfirmedDate"] is None and row["DateTransferredIn"] is None


def test_ties_take_the_largest_name(clinic):
    clinic.patient(1, "1")
    clinic.name(1, "A line")
    clinic.name(2, "B line")
    clinic.name(2, "C ligne", locale="fr")
    clinic.name(2, "D line", preferred=0)
    clinic.obs(1, 165708, "2024-01-01", coded=2)
    clinic.obs(1, 165708, "2024-05-01", coded=2)
    clinic.obs(1, 165708, "2024-05-01", coded=1)
    row = one(clinic)
    assert (row["CurrentRegimenLine"], row["InitialRegimenLine"]) == ("B line", "B line")
    assert row["LastPickupDate"] is None and row["LastVisitDate"] == "01-May-2024"


def test_initial_regimen_is_the_largest_of_the_first_answers(clinic):
    clinic.patient(1, "1")
    for code, name in ((1, "a"), (2, "b"), (3, "z")):
        clinic.name(code, name)
    clinic.obs(1, 164506, "2024-01-01", coded=1)
    clinic.obs(1, 164506, "2024-02-01", coded=3)
    clinic.obs(1, 164513, "2024-02-01", coded=2)
    assert one(clinic)["InitialRegimen"] == "b"


def test_current_regimen_needs_a_named_answer_on_a_regimen_visit(clinic):
    clinic.patient(1, "1")
    clinic.name(1, "one")
    clinic.name(2, "two")
    clinic.encounter(10, 1, "2024-01-01", form=27, kind=13)
    clinic.encounter(11, 1, "2024-05-01", form=27, kind=12)
    clinic.encounter(12, 1, "2024-05-02", form=99, kind=13, voided=1)
    clinic.obs(1, 164506, "2024-01-01", coded=1, encounter=10)
    clinic.obs(1, 164506, "2024-02-01", coded=77, encounter=10)
    clinic.obs(1, 164506, "2024-05-01", coded=2, encounter=11)
    clinic.obs(1, 164506, "2024-05-02", coded=2, encounter=12)
    assert one(clinic)["CurrentRegimen"] == "one"


def test_pickup_must_be_on_a_live_pharmacy_visit(clinic):
    clinic.patient(1, "1")
    clinic.encounter(10, 1, "2024-05-01", form=27, voided=1)
    clinic.obs(1, 165708, "2024-05-01", encounter=10)
    row = one(clinic)
    assert row["LastPickupDate"] is None and row["LastVisitDate"] == "01-May-2024"


def test_refill_uses_the_last_inserted_group(clinic):
    clinic.patient(1, "1")
    for when, days in (("2024-03-01", 10), ("2024-02-01", 20), ("2024-05-01", 30)):
        clinic.pickup(1, when, days)
    row = one(clinic)
    assert (row["DaysOfARVRefil"], row["DrugDurationPreviousQuarter"]) == (30, 20)
    # Previous pickup 2024-03-01, but the days are those of the group inserted last.
    assert row["PreviousARTStatus"] == "LTFU"
    assert row["PreviousARTStatusDate"] == at("2024-04-19")


def test_missing_refill_reads_as_lost(clinic):
    clinic.patient(1, "1")
    clinic.pickup(1, "2024-06-29", None)
    row = one(clinic)
    assert (row["CurrentARTStatus"], row["Appointment_Status"]) == ("LTFU", "LTFU")
    assert row["Days_To_Schedule"] is None


def test_recorded_reason_wins(clinic):
    clinic.patient(1, "1")
    clinic.name(5, "Death")
    clinic.pickup(1, "2024-06-20", 90)
    clinic.obs(1, 165470, "2024-06-21", coded=5)
    row = one(clinic)
    assert row["CurrentARTStatus"] == "Death" and row["DateReturnedToCare"] is None


def test_viral_load_date_disappears_with_a_later_result(clinic):
    clinic.patient(1, "1")
    clinic.patient(2, "2")
    for pid in (1, 2):
        clinic.obs(pid, 856, "2024-05-01", number=20.0)
        clinic.obs(pid, 165414, "2024-05-02", instant="2024-05-03 08:00")
    clinic.obs(2, 856, "2024-08-01", number=5000.0)
    first, second = rows_of(listed(clinic), "PatientHospitalNo")
    assert first["LastViralLoadDate"] == day("2024-05-01") and second["LastViralLoadDate"] is None
    assert second["CurrentViralLoad(c/ml)"] == 20.0
    assert first["ViralLoadReportedDate"] == "03-May-2024"


def test_reported_date_needs_a_viral_load(clinic):
    clinic.patient(1, "1")
    clinic.obs(1, 165414, "2024-05-02", instant="2024-05-03")
    assert one(clinic)["ViralLoadReportedDate"] is None


def test_sample_date_counts_deleted_rows(clinic):
    clinic.patient(1, "1")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    clinic.obs(1, 159951, "2024-01-01", instant="2024-01-05")
    clinic.obs(1, 159951, "2024-02-01", instant="2024-02-05 10:00", voided=1)
    clinic.obs(1, 159951, "2024-08-01", instant="2024-08-05")
    assert one(clinic)["LastDateOfSampleCollection"] == day("2024-02-05")


def test_age_at_start(clinic):
    clinic.patient(1, "1", birthdate=day("2020-01-15"))
    clinic.patient(2, "2", birthdate=day("2000-01-15"))
    clinic.patient(3, "3")
    clinic.obs(1, 159599, "2024-01-01", instant="2023-01-15")
    clinic.obs(2, 159599, "2024-01-01", instant="2023-01-14")
    clinic.obs(3, 5089, "2024-01-01", number=1.0)
    found = [(r["AgeAtStartOfARTYears"], r["AgeAtStartOfARTMonths"])
             for r in rows_of(listed(clinic), "PatientHospitalNo")]
    assert found == [(0, 36), (22, None), (None, None)]


def test_dtg_columns(clinic):
    clinic.patient(1, "1")
    clinic.name(165681, "TDF-3TC-DTG")
    clinic.name(7, "other")
    clinic.obs(1, 164506, "2023-01-01", coded=165681)
    clinic.obs(1, 164506, "2024-01-01", coded=165681)
    clinic.obs(1, 164513, "2024-02-01", coded=7)
    clinic.obs(1, 999999, "2022-07-04 10:00", coded=166187)
    row = one(clinic)
    assert row["DTGFirstPickUp"] == "TDF-3TC-DTG"
    assert row["DateofFirstDTGPickup"] == "04/07/2022"


def test_tpt_needs_the_dispensed_answer(clinic):
    clinic.patient(1, "1")
    clinic.patient(2, "2")
    clinic.obs(1, 165727, "2024-01-01", coded=1679)
    clinic.obs(2, 165727, "2024-01-01", coded=1679)
    clinic.obs(2, 165727, "2024-02-01", coded=1)
    found = rows_of(listed(clinic), "PatientHospitalNo")
    assert [r["LastINHDispensedDate"] for r in found] == [at("2024-01-01"), None]


def test_shared_and_missing_hospital_numbers_merge(clinic):
    clinic.patient(1, "77")
    clinic.patient(2, "77")
    clinic.patient(3)
    clinic.patient(4)
    for pid, weight in ((1, 40.0), (2, 60.0), (3, 10.0), (4, 20.0)):
        clinic.obs(pid, 5089, "2024-01-01", number=weight)
    found = rows_of(listed(clinic), "CurrentWeight_Kg")
    assert [(r["PatientHospitalNo"], r["uuid"], r["CurrentWeight_Kg"]) for r in found] == [
        (None, None, 20.0), ("77", "uuid-1", 60.0)]


def test_columns_that_do_not_merge_are_of_one_person(clinic):
    clinic.patient(1, "77", gender="M", birthdate=day("1990-01-01"))
    clinic.patient(2, "77", gender="F", birthdate=day("1970-01-01"))
    clinic.add("person_name", person_id=1, given_name="Zed", family_name="One")
    clinic.add("person_name", person_id=2, given_name="Ann", family_name="Two")
    # Person 1 came twice without a refill at the first visit, person 2 has one.
    clinic.add("encounter", encounter_id=1, patient_id=1, form_id=27, encounter_type=13)
    clinic.obs(1, 165708, "2024-01-10", encounter=1)
    clinic.obs(1, 165708, "2024-05-10", encounter=1)
    clinic.pickup(2, "2024-02-01", 30)
    clinic.pickup(2, "2024-06-01", 60)
    row = one(clinic)
    assert (row["uuid"], row["Sex"], row["DOB"], row["Patient_Name"]) == (
        "uuid-1", "M", day("1990-01-01"), "Zed One")
    # Without a refill of the same person there is no interruption date.
    assert row["PreviousARTStatusDate"] is None and row["PreviousARTStatus"] == "LTFU"
    assert row["LastPickupDatePreviousQuarter"] == at("2024-01-10")
    assert row["DrugDurationPreviousQuarter"] is None
    assert row["LastPickupDate"] == at("2024-06-01")


def test_biometrics_of_a_shared_number_are_of_one_patient(clinic):
    clinic.patient(1, "77")
    clinic.patient(2, "77")
    clinic.add("patient_program", patient_id=2, program_id=1, date_enrolled=at("2020-02-03"))
    clinic.add("biometricinfo", patient_Id=2, date_created=at("2024-02-01"), template="Zz", new_template=None)
    clinic.add("global_property", property="facility_datim_code", property_value="X1")
    row = biometric_status(clinic.tables()).collect()[0]
    assert (row["uuid"], row["EnrollmentDate"], row["BiometricCaptured"], row["ValidCapture"], row["DatimCode"]) == (
        "uuid-1", None, "No", "", "X1")


def test_two_hospital_numbers_make_two_rows(clinic):
    clinic.patient(1, "77")
    clinic.add("patient_identifier", patient_id=1, identifier="88", identifier_type=5, uuid="second")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    assert sorted(r["uuid"] for r in listed(clinic).collect()) == ["second", "uuid-1"]


def test_identifiers_can_be_compared_as_the_database_does(clinic):
    clinic.patient(1, "ab1")
    clinic.patient(2, "AB1 ")
    for pid in (1, 2):
        clinic.obs(pid, 5089, "2024-01-01", number=50.0)
    assert listed(clinic).count() == 2
    assert one(clinic, normalise_ids=True)["PatientHospitalNo"] == "ab1"


def tracked_clinic(clinic):
    clinic.patient(1, "1")
    clinic.name(1, "Death")
    clinic.name(2, "Transferred out")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    clinic.encounter(10, 1, "2024-04-10", form=13, creator=8)
    clinic.encounter(11, 1, "2024-05-10", form=13, creator=9)
    clinic.obs(1, 165470, "2024-03-30", coded=2, encounter=10)
    clinic.obs(1, 165470, "2024-05-10", coded=1, encounter=11)
    clinic.obs(1, 165469, "2024-03-30", instant="2024-03-29", encounter=10)
    clinic.obs(1, 165915, "2024-05-10", text="fever", encounter=11, voided=1)
    clinic.add("users", user_id=8, person_id=80)
    clinic.add("person_name", person_id=80, given_name="Nurse", family_name="Joy")
    return clinic


def test_tracking_takes_the_largest_reason(clinic):
    row = pivot_tracking(tracked_clinic(clinic).tables(), START, END).first()
    assert row["ReasonForTermination"] == "Transferred out"
    assert row["PatientOutcomePreviousQuarter"] == "Transferred out"
    assert row["PatientOutcomeDatePreviousQuarter"] == at("2024-03-30")
    assert row["DateOfTermination"] == at("2024-03-29")
    assert row["OtherCauseOfDeath"] == "fever"
    assert row["EnteredBy"] == "Nurse Joy" and row["MarkAsDeseased"] == ""
    assert row["TrackerTerminationDate"] == at("2024-04-10")


def test_tracking_visit_and_its_author_are_of_one_encounter(clinic):
    clinic = tracked_clinic(clinic)
    clinic.add("users", user_id=9, person_id=90)
    clinic.add("person_name", person_id=90, given_name="Aide", family_name="Ann")
    row = pivot_tracking(clinic.tables(), START, END).first()
    assert (row["TrackerTerminationDate"], row["EnteredBy"]) == (at("2024-04-10"), "Nurse Joy")
    listed_row = one(clinic)
    assert (listed_row["DateOfTermination"], listed_row["EnteredBy"]) == (at("2024-04-10"), "Nurse Joy")


def test_deleted_patients_share_the_row_of_the_first_visit(clinic):
    for pid in (1, 2):
        clinic.patient(pid, str(pid), voided=1)
    clinic.encounter(20, 1, "2024-05-02", form=13)
    clinic.encounter(21, 2, "2024-05-01", form=13)
    row = pivot_tracking(clinic.tables(), START, END).collect()
    assert [(r["patient_id"], r["uuid"], r["HospID"], r["TrackerTerminationDate"]) for r in row] == [
        (None, "uuid-2", "2", at("2024-05-01"))]


def test_tracking_reaches_the_line_list(clinic):
    row = one(tracked_clinic(clinic))
    assert row["PatientOutcome"] == "Transferred out"
    assert row["ARTStatusPreviousQuarter"] == "Transferred out"
    assert row["PreviousARTStatus"] == "Transferred out"
    assert row["PreviousARTStatusDate"] == at("2024-03-30")


def test_dead_in_the_window_is_tracked_without_a_visit_form(clinic):
    clinic.patient(1, "1", dead=1, death_date=at("2024-05-05"))
    clinic.patient(2, "2", dead=1, death_date=at("2023-05-05"))
    clinic.patient(3, "3", voided=1)
    for pid in (1, 2, 3):
        clinic.encounter(pid, pid, "2020-01-01", form=27)
    clinic.encounter(31, 3, "2024-05-01", form=13)
    found = rows_of(pivot_tracking(clinic.tables(), START, END), "patient_id")
    assert [(r["patient_id"], r["MarkAsDeseased"]) for r in found] == [(1, "Dead"), (None, "")]


def test_biometrics(clinic):
    for pid, number in ((1, "1"), (2, "2"), (3, "3"), (4, None)):
        clinic.patient(pid, number)
    clinic.add("biometricinfo", patient_Id=1, date_created=at("2024-02-01 08:00"), template="Rk1Sa",
               new_template=b"Rk1Sb")
    clinic.add("biometricinfo", patient_Id=1, date_created=at("2024-01-01 08:00"), template="Rk1Sa",
               new_template=None)
    clinic.add("biometricinfo", patient_Id=2, date_created=at("2024-02-01"), template="Rk1Sa",
               new_template=b"nope")
    clinic.add("biometricverificationinfo", patient_Id=1, date_created=at("2024-03-04"), recapture_count=2,
               fingerPosition="L", imageQuality=70)
    found = rows_of(biometric_status(clinic.tables()), "PatientHospitalNo")
    assert [(r["BiometricCaptured"], r["ValidCapture"]) for r in found] == [
        ("Yes", "Yes"), ("Yes", "No"), ("No", "")]
    assert found[0]["BiometricCaptureDate"] == day("2024-01-01")
    assert (found[0]["RecaptureDate"], found[0]["RecaptureCount"]) == ("04-Mar-2024", 2)


def test_entry_point_is_of_all_time(clinic):
    clinic.patient(1, "1")
    clinic.name(1, "OPD")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    clinic.obs(1, 160540, "2025-01-01", coded=1)
    assert one(clinic)["CareEntryPoint"] == "OPD"


def test_entry_point_counts_everybody_with_the_number(clinic):
    """Also patients that are not listed; soft-deleted ones have no number."""
    for code, name in ((1, "ANC"), (2, "OPD"), (3, "TB")):
        clinic.name(code, name)
    clinic.patient(1, "7")
    clinic.patient(2, "7", gender="M")
    clinic.patient(3, "7", voided=1)
    clinic.patient(4)
    clinic.patient(5, "9")
    clinic.obs(1, 5089, "2024-01-01", number=50.0)
    clinic.obs(1, 160540, "2024-01-01", coded=1)
    clinic.obs(2, 160540, "2025-01-01", coded=2)
    clinic.obs(3, 160540, "2024-01-01", coded=3)
    clinic.obs(3, 5089, "2024-01-01", number=90.0)
    clinic.obs(4, 5089, "2024-01-01", number=60.0)
    clinic.obs(5, 160540, "2024-01-01", coded=1)
    found = rows_of(listed(clinic), "PatientHospitalNo")
    assert [(r["PatientHospitalNo"], r["CareEntryPoint"], r["Sex"], r["CurrentWeight_Kg"]) for r in found] == [
        ("7", "OPD", "F", 50.0), (None, "TB", "F", 60.0)]


def test_refills_of_the_latest_previous_and_quarter_group(clinic):
    """Deleted groups count before the latest pickup, children by the smallest live id."""
    clinic.patient(1, "1")
    first = clinic.pickup(1, "2024-02-01", 30)
    clinic.obs(1, 159368, "2024-02-01", number=99.0, group=first)
    late = clinic.obs(1, 162240, "2024-02-10", voided=1)
    clinic.obs(1, 159368, "2024-02-10", number=11.0, group=late, voided=1)
    clinic.obs(1, 159368, "2025-01-01", number=12.4, group=late)
    clinic.pickup(1, "2024-06-05", 60)
    clinic.pickup(1, "2024-07-05", 70)
    row = one(clinic)
    assert (row["DaysOfARVRefil"], row["DrugDurationPreviousQuarter"]) == (60, 30)
    # 2024-02-01 + 12 + 29 is long before the pickup of June: the group of the deleted row decided.
    assert row["PreviousARTStatusDate"] == at("2024-03-13")


def test_several_facilities_at_once(spark):
    def fill(clinic, site, weight):
        clinic.patient(1, "1", facility=site)
        clinic.pickup(1, "2024-05-01", 30, encounter=5, facility=site)
        clinic.add("encounter", encounter_id=5, patient_id=1, form_id=27, encounter_type=13,
                   encounter_datetime=at("2024-05-01"), facility=site)
        clinic.obs(1, 5089, "2024-05-01", number=weight, facility=site)
        clinic.add("global_property", property="facility_datim_code", property_value=f"code-{site}",
                   facility=site)
        clinic.next_obs = 0  # ids start again at every facility

    both = Clinic(spark, site="facility")
    fill(both, "a", 40.0)
    fill(both, "b", 60.0)
    found = rows_of(listed(both, site="facility"), "facility")
    assert [(r["facility"], r["DatimCode"], r["CurrentWeight_Kg"], r["DaysOfARVRefil"]) for r in found] == [
        ("a", "code-a", 40.0, 30), ("b", "code-b", 60.0, 30)]
    alone = Clinic(spark, site="facility")
    fill(alone, "a", 40.0)
    assert listed(alone, site="facility").collect()[0] == listed(both, site="facility").filter(
        "facility = 'a'").collect()[0]


def test_rows_without_a_number_are_ordered_by_facility(spark):
    both = Clinic(spark, site="facility")
    for site, name in (("b", "Alpha"), ("a", "Beta")):
        for pid, hospital in ((1, None), (2, "5")):
            both.patient(pid, hospital, facility=site)
            both.obs(pid, 5089, "2024-05-01", number=50.0, facility=site)
        both.add("global_property", property="Facility_Name", property_value=name, facility=site)
    found = rows_of(programme_report(listed(both, site="facility"), END), "S/No.")
    assert [(r["S/No."], r["Facility"], r["Hospital Number"]) for r in found] == [
        (1, "Alpha", None), (2, "Alpha", "5"), (3, "Beta", None), (4, "Beta", "5")]


def test_older_version_has_no_previous_status_date(clinic):
    clinic.patient(1, "1")
    clinic.pickup(1, "2024-01-01", 30)
    clinic.pickup(1, "2024-05-01", 30)
    row = one(clinic, previous_status_date=False)
    assert row["PreviousARTStatus"] == "LTFU" and row["PreviousARTStatusDate"] is None


@pytest.mark.parametrize("earlier", ["2024-05-15", "2024-03-01"])
def test_an_earlier_end_date_never_moves_dates_later(clinic, earlier):
    clinic.patient(1, "1")
    for when in ("2024-01-01", "2024-02-20", "2024-04-11", "2024-06-01"):
        clinic.pickup(1, when, 30)
    late = one(clinic)
    early = line_list(clinic.tables(), START, earlier, NOW).first()
    for name in ("LastPickupDate", "LastPickupDatePreviousQuarter"):
        assert early[name] is None or early[name] <= late[name]


def test_row_count_is_the_number_of_hospital_numbers(spark):
    from carelens.bindings.tables import NOW as TODAY
    from carelens.bindings.tables import PICKUP_END, clinical_tables
    from carelens.bindings.tables import START as OPEN
    from carelens.plans.concepts import LISTED

    t = clinical_tables(spark, "/root/testdata/sf0.001")
    seen = t["obs"].filter((F.col("voided") == 0) & (F.col("obs_datetime") <= F.lit(PICKUP_END).cast("date"))
                           & F.col("concept_id").isin(*LISTED)).select(F.col("person_id").alias("patient_id"))
    people = t["patient"].filter("voided = 0").join(seen, "patient_id", "left_semi")
    numbers = t["patient_identifier"].filter("identifier_type = 5 and voided = 0")
    expected = people.join(numbers, "patient_id", "left").select("identifier").distinct().count()
    assert line_list(t, OPEN, PICKUP_END, TODAY).count() == expected


def test_spellings_of_a_number_keep_what_each_part_knows(clinic):
    for pid, spelling in ((1, "ab1"), (2, "AB1 ")):
        clinic.patient(pid, hospital=spelling)
        clinic.pickup(pid, "2024-05-01", 30)
    clinic.name(1, "Outpatient")
    clinic.obs(2, 160540, "2024-01-01", coded=1)
    clinic.add("patient_program", patient_id=1, program_id=1, date_enrolled=at("2020-02-03"))
    rows = listed(clinic, normalise_ids=True).collect()
    assert len(rows) == 1
    # The entry point is the largest of both persons, the enrolment that of the first.
    assert rows[0].CareEntryPoint == "Outpatient" and rows[0].EnrollmentDate == at("2020-02-03")
