"""Concepts, forms and codes of the clinical record (fixed values)."""

PICKUP = 165708
REFILL_GROUP = 162240
REFILL_DAYS = 159368
ART_START = 159599
TRANSFER_IN = 165242
PREGNANCY = 165050
VIRAL_LOAD = 856
VIRAL_LOAD_REPORTED = 165414
SAMPLE_DATE = 159951
WEIGHT = 5089
HEIGHT = 5090
TB_STATUS = 1659
INH_START = 164852
INH_STOP = 166096
INH_DISPENSED = 165727
INH_DISPENSED_ANSWER = 1679
TB_TREATMENT_START = 1113
TB_TREATMENT_STOP = 159431
OTZ_START = 166156
OTZ_STOP = 166158
OUTCOME_REASON = 165470
OUTCOME_DATE = 165469
TRACKING_REASON = 165460
CAUSE_OF_DEATH = 165889
OTHER_CAUSE_OF_DEATH = 165915
DISCONTINUED_REASON = 165916
RETURNED_DATE = 165775
REFERRED_FOR = 165776
REGIMENS = (164506, 164513, 164507, 164514, 165702, 165703)

# Concepts a line list looks at; others never reach its as-of columns.
LISTED = (
    159599, 165708, 159368, 164506, 164513, 164507, 164514, 165702, 165703, 165050,
    856, 164980, 165470, 159635, 5089, 5090, 165988, 1659, 164852, 166096, 1113,
    159431, 162240, 165242, 165724, 166156, 166158, 165727, 164982, 165414,
)
DTG_CODES = (
    165681, 165682, 165688, 165691, 165692, 165697, 165699, 166187, 166194, 166196,
    166197, 166198,
)
PHARMACY_FORM = 27
TRACKING_FORM = 13
REGIMEN_ENCOUNTER_TYPE = 13
HOSPITAL_NUMBER = 5
UNIQUE_ID = 4
PROGRAM = 1

DATIM_PROPERTY = "facility_datim_code"
FACILITY_PROPERTY = "Facility_Name"

# Outcomes after which a patient no longer counts as active.
ENDED = ["Discontinued Care", "Death", "Transferred out"]
ENDED_REPORTED = ["Dead", "Stopped", "Transferred Out"]
