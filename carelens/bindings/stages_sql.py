"""Line-list rows, earlier report rows and both reports in SQL, for the check."""

from carelens.bindings.tables import PICKUP_END
from carelens.plans.report_columns import BLANK_COLUMNS, DATE_COLUMNS, REPORT_COLUMNS

END = f"DATE '{PICKUP_END}'"
_P = "CASE WHEN o_totalprice >= 5000 THEN pickup END"
_DAYS = ("CASE WHEN o_orderstatus <> 'P' OR rank <> 4 THEN CAST(floor(o_totalprice / 4000) AS INTEGER) END")
_LINE = ("CASE rank WHEN 1 THEN 'Adult 1st line ARV regimen' WHEN 2 THEN 'Adult 2nd line ARV regimen' "
         "WHEN 3 THEN 'Child 1st line ARV regimen' WHEN 4 THEN 'Child 3rd line ARV regimen' "
         "WHEN 5 THEN 'Other line'")

ORDERS = """
listed_orders AS (
  SELECT *, CAST(left(o_orderpriority, 1) AS INTEGER) AS rank,
    DATE '2001-01-01' + CAST(floor(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 13.0)
      AS INTEGER) AS pickup
  FROM orders JOIN customer ON c_custkey = o_custkey)
"""

STAGE = f"""
stage AS (
  SELECT 'o-' || o_orderkey AS uuid, 'State ' || c_nationkey AS state, 'LGA ' || c_nationkey AS lga,
    c_mktsegment AS facility, lpad(CAST(o_orderkey // 2 AS VARCHAR), 7, '0') AS hospital_no,
    CASE WHEN o_totalprice > 250000 THEN lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS unique_id,
    CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'X' END AS sex,
    DATE '1960-01-01' + c_nationkey * 300 AS dob, DATE '1995-01-01' + c_nationkey AS enrolled,
    rank = 1 AS transferred, {_P} AS picked,
    CASE WHEN c_nationkey < 8 THEN {_P} ELSE {_P} - 400 END AS started,
    {_DAYS} AS days, {_P} + {_DAYS} + 29 AS iit,
    {_LINE} END AS first_line, {_LINE} ELSE 'Unknown line' END AS line,
    'REG-' || c_nationkey AS first_regimen, 'REG-' || rank AS regimen,
    CASE WHEN o_orderstatus = 'F' THEN 'Not pregnant' END AS pregnancy,
    CASE WHEN rank <> 3 THEN o_totalprice / 250 END AS vl,
    greatest(CASE WHEN o_orderstatus <> 'F' THEN {_P} - 30 END,
             CASE WHEN c_nationkey < 15 THEN {_P} - rank * 10 END) AS vl_date,
    CASE WHEN rank < 4 THEN {_P} - 40 END AS sampled, o_totalprice / 8000 AS weight,
    CASE WHEN c_nationkey < 12 THEN {_P} - 60 END AS tpt,
    CASE WHEN c_nationkey = 3 THEN strftime({_P}, '%d-%b-%Y') END AS otz,
    CASE WHEN rank <> 5 THEN
           CASE WHEN {_P} + {_DAYS} + 28 >= {END} THEN 'Active' ELSE 'IIT' END
         WHEN o_orderstatus = 'F' THEN 'Dead' WHEN o_orderstatus = 'O' THEN 'Transferred Out'
         ELSE 'Stopped' END AS status,
    CASE WHEN rank = 5 THEN {_P} + 3 END AS outcome_date,
    CASE WHEN rank = 5 AND o_orderstatus = 'F' THEN 'Cause ' || c_nationkey END AS cause,
    CASE WHEN rank = 5 AND o_orderstatus = 'P' THEN 'Moved' END AS reason,
    CASE WHEN c_acctbal > 7000 THEN {_P} END AS returned,
    CASE WHEN c_nationkey < 5 THEN NULL WHEN c_nationkey < 12 THEN 'Active' WHEN c_nationkey < 18 THEN 'IIT'
         ELSE 'Dead' END AS quarter_status,
    CASE WHEN c_nationkey >= 18 THEN DATE '2001-03-01'
         WHEN c_nationkey BETWEEN 12 AND 17 AND c_acctbal >= 0
           THEN {_P} - 90 + CAST(floor(c_acctbal / 100) AS INTEGER) + 29
         WHEN c_nationkey BETWEEN 5 AND 11 THEN {_P} - 90 END AS quarter_date,
    CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 5000 THEN 'Active' WHEN c_acctbal < 8000 THEN 'IIT'
         WHEN c_acctbal < 8500 THEN 'Dead' WHEN c_acctbal < 9000 THEN 'Transferred Out' ELSE 'Stopped' END AS before,
    CASE WHEN c_acctbal >= 3000 THEN DATE '2001-01-15' END AS before_date,
    CASE WHEN o_orderstatus <> 'O' THEN 'Yes' ELSE 'No' END AS captured,
    CASE WHEN o_orderstatus <> 'O' THEN {_P} - 100 END AS capture_date
  FROM listed_orders)
"""


def numbered(source: str = "stage") -> str:
    """Rows of ``source`` with serial number and key."""
    return f"""
numbered AS (
  SELECT *, row_number() OVER (ORDER BY state, lga, facility, hospital_no, uuid) AS n,
    lga || facility || regexp_replace(hospital_no, '^0+', '')
      || coalesce(regexp_replace(unique_id, '^0+', ''), 'nan') AS plain_key FROM {source})
"""


# The key of a list row: repeated keys get letters, the 27th and later none.
KEYED = """
keyed AS (
  SELECT *, CASE WHEN same = 1 THEN plain_key WHEN place <= 26
      THEN plain_key || '_' || chr(CAST(64 + place AS INTEGER)) END AS key
  FROM (SELECT *, count(*) OVER (PARTITION BY plain_key) AS same,
               row_number() OVER (PARTITION BY plain_key ORDER BY hospital_no, uuid) AS place FROM numbered))
"""

BASELINE = f"""
all_earlier AS (
  SELECT 'LGA ' || c_nationkey || c_mktsegment
      || CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey // 2 AS VARCHAR)
              ELSE lpad(CAST(o_orderkey // 2 AS VARCHAR), 7, '0') END
      || CASE WHEN o_totalprice > 250000 THEN CAST(o_custkey AS VARCHAR) ELSE 'nan' END AS key,
    'P' || o_custkey AS e_patient,
    CASE WHEN rank <> 2 THEN o_totalprice / 300 END AS e_vl,
    CASE WHEN c_nationkey < 20 THEN pickup - 20 END AS e_vl_date, pickup - 35 AS e_sampled,
    'CM ' || c_nationkey AS e_manager, CASE WHEN c_nationkey >= 10 THEN 'Facility' END AS e_setting,
    pickup - 200 AS e_dmoc, 'MMD' || rank AS e_dmoc_type,
    CASE WHEN rank = 1 THEN pickup - 150 END AS e_dmoc_return,
    CASE WHEN c_nationkey >= 8 THEN pickup - 50 END AS e_tpt, '3HP' AS e_tpt_type,
    pickup + 30 AS e_tpt_done,
    CASE WHEN pickup - 30 + coalesce(CAST(CASE WHEN rank <> 1 THEN floor(o_totalprice / 100000) * 30 END
           AS INTEGER), 15) + 29 >= {END} AND (rank IN (1, 2, 4, 5))
         THEN 'Active' ELSE 'Inactive' END AS e_status
  FROM listed_orders),
earlier AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY key) AS times FROM all_earlier) WHERE times = 1),
merged AS (
  SELECT k.* EXCLUDE (vl, vl_date, sampled, tpt),
    CASE WHEN (vl_date IS NULL AND e_vl_date IS NOT NULL) OR (e_vl_date > vl_date AND e_vl IS NOT NULL)
         THEN e_vl ELSE vl END AS vl,
    CASE WHEN vl_date IS NULL OR e_vl_date > vl_date THEN e_vl_date ELSE vl_date END AS vl_date,
    CASE WHEN sampled IS NULL OR e_sampled > sampled THEN e_sampled ELSE sampled END AS sampled,
    CASE WHEN tpt IS NULL OR e_tpt > tpt THEN e_tpt ELSE tpt END AS tpt,
    e.* EXCLUDE (key, times)
  FROM keyed k LEFT JOIN earlier e ON e.key = k.key)
"""


def final(source: str) -> str:
    """The rules after the viral-load date over rows of ``source``."""
    return f"""
ruled AS (
  SELECT *, CASE WHEN status LIKE 'Active%' AND 29 - (iit - {END}) >= 0 THEN (29 - (iit - {END})) / 29.0 END AS chance,
    CASE WHEN returned IS NOT NULL AND status IN ('Active', 'Active(A)') THEN 'Active-Restart'
         WHEN transferred AND status IN ('Active', 'Active(A)') THEN 'Active-Transfer In'
         ELSE status END AS final_status,
    CASE WHEN returned IS NOT NULL AND status IN ('Active', 'Active(A)') THEN returned
         WHEN outcome_date IS NOT NULL THEN outcome_date
         WHEN status IN ('IIT', 'Active(A)') THEN iit
         WHEN status = 'Active' THEN picked END AS final_date,
    CASE WHEN before IS NULL AND picked = started THEN 'HIV+ non ART'
         WHEN transferred AND before = 'Active' THEN 'Active-Transfer In' ELSE before END AS final_before,
    CASE WHEN before_date IS NULL AND picked = started THEN enrolled ELSE before_date END AS final_before_date,
    CASE WHEN vl_date IS NOT NULL AND vl <= 1000 THEN 'Routine - Routine'
         WHEN vl_date IS NOT NULL AND vl > 1000 THEN 'Targeted - Post EAC' END AS band
  FROM {source})"""


def _renamed(line: str) -> str:
    return (f"CASE {line} WHEN 'Adult 1st line ARV regimen' THEN 'Adult.1st.Line' "
            f"WHEN 'Adult 2nd line ARV regimen' THEN 'Adult.2nd.Line' "
            f"WHEN 'Child 1st line ARV regimen' THEN 'Peds.1st.Line' "
            f"WHEN 'Child 3rd line ARV regimen' THEN 'Peds.3rd.Line' ELSE {line} END")


# Report columns that are filled, by their line-list name.
FILLED = {
    "S/N.": "n", "State": "state", "LGA": "lga", "FaciityName": "facility",
    "PatientHospitalNo": "hospital_no", "PatientUniqueID": "unique_id", "Sex": "sex",
    "CurrentWeight_Kg": "weight", "DOB": "dob", "ARTStartDate": "started", "LastPickupDate": "picked",
    "DaysOfARVRefil": "round(days / CAST(30 AS DOUBLE), 1)", "LastINHDispensedDate": "tpt",
    "InitialRegimenLine": _renamed("first_line"), "InitialRegimen": "first_regimen",
    "CurrentRegimenLine": _renamed("line"), "CurrentRegimen": "regimen", "PregnancyStatus": "pregnancy",
    "OTZStartDate": "otz", "Date of Viral Load Sample Collection (yyyy-mm-dd)": "sampled",
    "CurrentViralLoad(c/ml)": "vl", "Date of Current Viral Load (yyyy-mm-dd)": "vl_date",
    "ViralLoadIndication": "band",
    "Status at Registration": "CASE WHEN transferred THEN 'ART Transfer In' END",
    "EnrollmentDate": "enrolled", "PreviousARTStatus": "final_before",
    "PreviousARTStatusDate": "final_before_date", "CurrentARTStatus": "final_status",
    "PatientOutcomeDate": "final_date", "If Dead, Cause of Dead": "cause",
    "VA Cause of Dead": "CAST(NULL AS VARCHAR)",
    "Reason for Transfer-Out / IIT / Stooped Treatment": "reason", "BiometricCaptured": "captured",
    "BiometricCaptureDate": "capture_date", "IIT Chance (%)": "chance",
    "Date calculated (yyyy-mm-dd)": "CASE WHEN chance IS NOT NULL THEN iit END",
}
FROM_EARLIER = {
    "Patient id": "e_patient", "Case Manager": "e_manager", "ART Enrollment Setting": "e_setting",
    "Date Commenced DMOC (yyyy-mm-dd)": "e_dmoc", "Type of DMOC": "e_dmoc_type",
    "Date of Return of DMOC Client to Facility (yyyy-mm-dd)": "e_dmoc_return",
    "TPT Type": "e_tpt_type", "TPT Completion date (yyyy-mm-dd)": "e_tpt_done",
}


def report_columns(values: dict[str, str], headings: bool = True) -> str:
    cells = []
    for name, heading in REPORT_COLUMNS:
        kind = "DATE" if name in DATE_COLUMNS else "VARCHAR"
        value = values.get(name, f"CAST(NULL AS {kind})")
        if kind == "DATE":
            value = f"CAST({value} AS DATE)"
        cells.append(f'{value} AS "{heading if headings else name}"')
    return ", ".join(cells)


BLANKS = ", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in BLANK_COLUMNS)
