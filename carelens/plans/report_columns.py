"""Column lists of the programme report (fixed values)."""

# What a report reads of a line list.
READ_COLUMNS = (
    "uuid", "State", "LGA", "FaciityName", "PatientHospitalNo", "PatientUniqueID", "Sex", "DOB",
    "EnrollmentDate", "TransferInStatus", "ARTStartDate", "LastPickupDate", "DaysOfARVRefil",
    "LastPickupDatePreviousQuarter", "DrugDurationPreviousQuarter", "InitialRegimenLine",
    "InitialRegimen", "CurrentRegimenLine", "CurrentRegimen", "PregnancyStatus",
    "CurrentViralLoad(c/ml)", "ViralLoadReportedDate", "LastViralLoadDate",
    "LastDateOfSampleCollection", "CurrentWeight_Kg", "LastINHDispensedDate", "OTZStartDate",
    "CurrentARTStatus", "PatientOutcomeDate", "CauseOfDeath", "OtherCauseOfDeath",
    "DiscontinuedCareReason", "DateReturnedToCare", "ARTStatusPreviousQuarter",
    "PatientOutcomeDatePreviousQuarter", "PreviousARTStatus", "PreviousARTStatusDate",
    "BiometricCaptured", "BiometricCaptureDate",
)

# Line-list column, report heading, in report order.
REPORT_COLUMNS: tuple[tuple[str, str], ...] = (
    ("S/N.", "S/No."),
    ("State", "State"),
    ("LGA", "LGA"),
    ("FaciityName", "Facility"),
    ("Patient id", "Patient id"),
    ("PatientHospitalNo", "Hospital Number"),
    ("PatientUniqueID", "Unique ID"),
    ("Household Unique No", "Household Unique No"),
    ("Received OVC Service?", "Received OVC Service?"),
    ("Sex", "Sex"),
    ("CurrentWeight_Kg", "Current Weight (Kg)"),
    ("DOB", "Date of Birth (yyyy-mm-dd)"),
    ("ARTStartDate", "ART Start Date (yyyy-mm-dd)"),
    ("LastPickupDate", "Last Pickup Date (yyyy-mm-dd)"),
    ("DaysOfARVRefil", "Months of ARV Refill"),
    ("LastINHDispensedDate", "Date of TPT Start (yyyy-mm-dd)"),
    ("TPT Type", "TPT Type"),
    ("TPT Completion date (yyyy-mm-dd)", "TPT Completion date (yyyy-mm-dd)"),
    ("InitialRegimenLine", "Regimen Line at ART Start"),
    ("InitialRegimen", "Regimen at ART Start"),
    ("CurrentRegimenLine", "Current Regimen Line"),
    ("CurrentRegimen", "Current ART Regimen"),
    ("Date of Regimen Switch/ Substitution (yyyy-mm-dd)",
     "Date of Regimen Switch/ Substitution (yyyy-mm-dd)"),
    ("PregnancyStatus", "Pregnancy Status"),
    ("Date of Full Disclosure (yyyy-mm-dd)", "Date of Full Disclosure (yyyy-mm-dd)"),
    ("OTZStartDate", "Date Enrolled on OTZ (yyyy-mm-dd)"),
    ("Number of Support Group (OTZ Club) meeting attended",
     "Number of Support Group (OTZ Club) meeting attended"),
    ("Number of OTZ Modules completed", "Number of OTZ Modules completed"),
    ("Date of Viral Load Sample Collection (yyyy-mm-dd)",
     "Date of Viral Load Sample Collection (yyyy-mm-dd)"),
    ("CurrentViralLoad(c/ml)", "Current Viral Load (c/ml)"),
    ("Date of Current Viral Load (yyyy-mm-dd)", "Date of Current Viral Load (yyyy-mm-dd)"),
    ("ViralLoadIndication", "Viral Load Indication"),
    ("VL Result After VL Sample Collection (c/ml)",
     "VL Result After VL Sample Collection (c/ml)"),
    ("Date of VL Result After VL Sample Collection (yyyy-mm-dd)",
     "Date of VL Result After VL Sample Collection (yyyy-mm-dd)"),
    ("Status at Registration", "Status at Registration"),
    ("EnrollmentDate", "Date of Enrollment/Transfer-In (yyyy-mm-dd)"),
    ("PreviousARTStatus", "Previous ART Status"),
    ("PreviousARTStatusDate", "Confirmed Date of Previous ART Status (yyyy-mm-dd)"),
    ("CurrentARTStatus", "Current ART Status"),
    ("PatientOutcomeDate", "Date of Current ART Status (yyyy-mm-dd)"),
    ("RTT", "RTT"),
    ("If Dead, Cause of Dead", "If Dead, Cause of Dead"),
    ("VA Cause of Dead", "VA Cause of Dead"),
    ("If Transferred out, new facility", "If Transferred out, new facility"),
    ("Reason for Transfer-Out / IIT / Stooped Treatment",
     "Reason for Transfer-Out / IIT / Stooped Treatment"),
    ("ART Enrollment Setting", "ART Enrollment Setting"),
    ("Date Commenced DMOC (yyyy-mm-dd)", "Date Commenced DMOC (yyyy-mm-dd)"),
    ("Type of DMOC", "Type of DMOC"),
    ("Date of Return of DMOC Client to Facility (yyyy-mm-dd)",
     "Date of Return of DMOC Client to Facility (yyyy-mm-dd)"),
    ("Date of Commencement of EAC (yyyy-mm-dd)", "Date of Commencement of EAC (yyyy-mm-dd)"),
    ("Number of EAC Sessions Completed", "Number of EAC Sessions Completed"),
    ("Date of 3rd EAC Completion (yyyy-mm-dd)", "Date of 3rd EAC Completion (yyyy-mm-dd)"),
    ("Date of Extended EAC Completion (yyyy-mm-dd)",
     "Date of Extended EAC Completion (yyyy-mm-dd)"),
    ("Date of Repeat Viral Load - Post EAC VL Sample Collected (yyyy-mm-dd)",
     "Date of Repeat Viral Load - Post EAC VL Sample Collected (yyyy-mm-dd)"),
    ("Co-morbidities", "Co-morbidities"),
    ("Date of Cervical Cancer Screening (yyyy-mm-dd)",
     "Date of Cervical Cancer Screening (yyyy-mm-dd)"),
    ("Cervical Cancer Screening Type", "Cervical Cancer Screening Type"),
    ("Cervical Cancer Screening Method", "Cervical Cancer Screening Method"),
    ("Result of Cervical Cancer Screening", "Result of Cervical Cancer Screening"),
    ("Date of Precancerous Lesions Treatment (yyyy-mm-dd)",
     "Date of Precancerous Lesions Treatment (yyyy-mm-dd)"),
    ("Precancerous Lesions Treatment Methods", "Precancerous Lesions Treatment Methods"),
    ("BiometricCaptureDate", "Date Biometrics Enrolled (yyyy-mm-dd)"),
    ("BiometricCaptured", "Valid Biometrics Enrolled?"),
    ("IIT Chance (%)", "IIT Chance (%)"),
    ("Date calculated (yyyy-mm-dd)", "Date calculated (yyyy-mm-dd)"),
    ("Case Manager", "Case Manager"),
)

# Report columns that the line list cannot fill.
BLANK_COLUMNS = (
    "Patient id", "Household Unique No", "Received OVC Service?", "TPT Type",
    "TPT Completion date (yyyy-mm-dd)", "Date of Regimen Switch/ Substitution (yyyy-mm-dd)",
    "Date of Full Disclosure (yyyy-mm-dd)",
    "Number of Support Group (OTZ Club) meeting attended", "Number of OTZ Modules completed",
    "VL Result After VL Sample Collection (c/ml)",
    "Date of VL Result After VL Sample Collection (yyyy-mm-dd)", "Status at Registration",
    "RTT", "If Transferred out, new facility", "ART Enrollment Setting",
    "Date Commenced DMOC (yyyy-mm-dd)", "Type of DMOC",
    "Date of Return of DMOC Client to Facility (yyyy-mm-dd)",
    "Date of Commencement of EAC (yyyy-mm-dd)", "Number of EAC Sessions Completed",
    "Date of 3rd EAC Completion (yyyy-mm-dd)", "Date of Extended EAC Completion (yyyy-mm-dd)",
    "Date of Repeat Viral Load - Post EAC VL Sample Collected (yyyy-mm-dd)",
    "ViralLoadIndication", "Co-morbidities", "Date of Cervical Cancer Screening (yyyy-mm-dd)",
    "Cervical Cancer Screening Type", "Cervical Cancer Screening Method",
    "Result of Cervical Cancer Screening",
    "Date of Precancerous Lesions Treatment (yyyy-mm-dd)",
    "Precancerous Lesions Treatment Methods", "IIT Chance (%)",
    "Date calculated (yyyy-mm-dd)", "Case Manager",
)

# Report columns that hold days, under their line-list names.
DATE_COLUMNS = (
    "DOB", "ARTStartDate", "LastPickupDate", "LastINHDispensedDate",
    "TPT Completion date (yyyy-mm-dd)", "Date of Regimen Switch/ Substitution (yyyy-mm-dd)",
    "Date of Full Disclosure (yyyy-mm-dd)",
    "Date of Viral Load Sample Collection (yyyy-mm-dd)",
    "Date of Current Viral Load (yyyy-mm-dd)",
    "Date of VL Result After VL Sample Collection (yyyy-mm-dd)", "EnrollmentDate",
    "PreviousARTStatusDate", "PatientOutcomeDate", "Date Commenced DMOC (yyyy-mm-dd)",
    "Date of Return of DMOC Client to Facility (yyyy-mm-dd)",
    "Date of Commencement of EAC (yyyy-mm-dd)", "Date of 3rd EAC Completion (yyyy-mm-dd)",
    "Date of Extended EAC Completion (yyyy-mm-dd)",
    "Date of Repeat Viral Load - Post EAC VL Sample Collected (yyyy-mm-dd)",
    "Date of Cervical Cancer Screening (yyyy-mm-dd)",
    "Date of Precancerous Lesions Treatment (yyyy-mm-dd)", "BiometricCaptureDate",
    "Date calculated (yyyy-mm-dd)",
)

SEX = {"M": "Male", "F": "Female"}
REGIMEN_LINES = {
    "Adult 1st line ARV regimen": "Adult.1st.Line",
    "Adult 2nd line ARV regimen": "Adult.2nd.Line",
    "Adult 3rd line ARV regimen": "Adult.3rd.Line",
    "Child 1st line ARV regimen": "Peds.1st.Line",
    "Child 2nd line ARV regimen": "Peds.2nd.Line",
    "Child 3rd line ARV regimen": "Peds.3rd.Line",
}
STATUSES = {
    "Death": "Dead",
    "Discontinued Care": "Stopped",
    "Transferred out": "Transferred Out",
    "LTFU": "IIT",
}

# Columns a report takes from an earlier one as they are: report name to the earlier name.
TAKEN_FROM_BASELINE = {
    "Case Manager": "Case Manager",
    "ART Enrollment Setting": "ART Enrollment Setting",
    "Date Commenced DMOC (yyyy-mm-dd)": "Date Commenced DMOC (yyyy-mm-dd)",
    "Type of DMOC": "Type of DMOC",
    "Date of Return of DMOC Client to Facility (yyyy-mm-dd)":
        "Date of Return of DMOC Client to Facility (yyyy-mm-dd)",
    "TPT Type": "TPT Type",
    "TPT Completion date (yyyy-mm-dd)": "TPT Completion date (yyyy-mm-dd)",
    "Patient id": "Patient ID",
}
# Columns of the earlier report that newer-wins rules compare.
COMPARED_WITH_BASELINE = (
    "Current Viral Load (c/ml)", "Date of Current Viral Load (yyyy-mm-dd)",
    "Date of Viral Load Sample Collection (yyyy-mm-dd)", "Date of TPT Start (yyyy-mm-dd)",
)
