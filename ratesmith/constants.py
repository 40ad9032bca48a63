"""Code lists, identifiers and labels the published results depend on."""

from __future__ import annotations

from ratesmith.functions.values import expand_codes

# --- validity of an admitted episode -------------------------------------------------------
INVALID_BIRTH_MONTHS = ["011900", "011901", "011800"]
AGE_LIMITS = (0, 120)
SEX_CODES = ["1", "2"]
FINISHED_STATUS = ["3"]
ORDINARY_TYPE = ["1"]
FIRST_EPISODE = ["1"]
EXCLUDED_SPECIALTIES = ["501", "560", "610"]
EMERGENCY_METHODS = ["21", "23", "24", "28", "2A", "2B", "2C", "2D"]

# --- diagnosis and procedure codes of the condition groups ---------------------------------
ASTHMA = ["J45", "J46"]
ENT_INFECTION = ["H66", "H67", "J02", "J03", "J06", "J312"]
PYELONEPHRITIS = ["N10", "N11", "N12", "N136"]
EPILEPSY = ["G40", "G41", "R56", "O15"]
NO_EXCLUSION_CODES = ASTHMA + ENT_INFECTION + PYELONEPHRITIS + EPILEPSY
DIABETES_CODES = expand_codes("E", range(10, 15), 9)
HEART_FAILURE_CODES = ["I50", "J81", "I110"]
CARDIAC_PROCEDURES = [
    "K50", "K52", "K55", "K56", "K57", "K60", "K61", "K66", "K67", "K68", "K69", "K71",
] + expand_codes("K", range(5), 10)
COPD_CODES = ["J41", "J42", "J43", "J44", "J47"]
COPD_TRIGGER = ["J20"]
HYPERTENSION_CODES = ["I10", "I119"]
FLU_PNEUMONIA_CODES = [
    "J10", "J11", "J13", "J14", "J153", "J154", "J157", "J159", "J168", "J181", "J188",
]
SICKLE_CELL = ["D57"]
CELLULITIS_CODES = ["L03", "L04", "L88", "L080", "L088", "L089", "L980"]
SKIN_PROCEDURES_1 = [
    "A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "K", "L", "M", "N", "O", "P", "Q", "R", "T",
    "V", "W",
]
SKIN_PROCEDURES_2 = ["S1", "S2", "S3", "X0", "X1", "X2", "X4", "X5"]
SKIN_PROCEDURES_3 = ["S41", "S42", "S43", "S44", "S45", "S47", "S48", "S49"]

# --- indicator and attribute identifiers ---------------------------------------------------
ADMISSIONS_INDICATOR = "E1B4261F-8649-42D0-A40E-208AA41F8EAE"
ADMISSIONS_NUMERATOR = "D3C64D53-20CF-43E7-B15B-1AA8613F7B74"
ADMISSIONS_DENOMINATOR = "D388FDB3-E3D7-44F2-80C7-0832B448C9B4"
ADMISSIONS_BASE_NUMERATOR = "0871C126-B4C3-4054-A0C0-2481525A940F"
ADMISSIONS_BASE_DENOMINATOR = "88337490-8A59-4C40-8C13-FF0D9D01F48D"
ADMISSIONS_CRUDE = "d4909566-9bc8-11ed-a8fc-0242ac120002"
ADMISSIONS_BASE_CRUDE = "d4909836-9bc8-11ed-a8fc-0242ac120002"
WAITS_INDICATOR = "283A5FDD-D4BA-4DF7-AC70-B59C83285D3E"
WAITS_NUMERATOR = "767390F9-FD7E-4B01-A8AE-82B41DE00A02"
WAITS_DENOMINATOR = "FB4D2185-044E-44A4-9C11-02A0A4034A02"
ROUNDS_INDICATOR = "FB4334A8-2E9C-43AB-9D1F-51C4A4F14E6B"
ROUNDS_NUMERATOR = "982C9A99-A4EA-48FB-ABE9-B60B3E2F1719"
OTHER_INDICATOR = "472596E3-E60B-4DFF-8D54-283A6B58AA7B"
OTHER_NUMERATOR = "2F9C4BBA-4A2C-452D-BB68-2639FE715908"

WAITS_NUMERATOR_LABEL = "ACC-08 Numerator"
WAITS_DENOMINATOR_LABEL = "ACC-08 Denominator"
ROUNDS_NUMERATOR_LABEL = "EHCH-04 Numerator"

# Indicator_description, Indicator, Attribute_description, Attribute_ID
ATTRIBUTES = [
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions baseline non-standardised numerator", ADMISSIONS_BASE_CRUDE),
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions non-standardised numerator", ADMISSIONS_CRUDE),
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions standardised numerator", ADMISSIONS_NUMERATOR),
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions baseline denominator", ADMISSIONS_BASE_DENOMINATOR),
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions baseline numerator", ADMISSIONS_BASE_NUMERATOR),
    ("NCD013 Indicator", ROUNDS_INDICATOR,
     "Patient contact during Care Home Round", ROUNDS_NUMERATOR),
    ("NCD022 Indicator", ADMISSIONS_INDICATOR,
     "ACSC Emergency Admissions denominator", ADMISSIONS_DENOMINATOR),
    ("NCD026 Indicator", WAITS_INDICATOR, WAITS_DENOMINATOR_LABEL, WAITS_DENOMINATOR),
    ("NCD013 Indicator", ROUNDS_INDICATOR, ROUNDS_NUMERATOR_LABEL, ROUNDS_NUMERATOR),
    ("NCD013 Indicator", OTHER_INDICATOR, "ACC-02 Numerator", OTHER_NUMERATOR),
    ("NCD026 Indicator", WAITS_INDICATOR, WAITS_NUMERATOR_LABEL, WAITS_NUMERATOR),
]
ATTRIBUTE_MISSING = "INDICATOR NOT FOUND IN LOOKUP"

# --- output labels -------------------------------------------------------------------------
CRUDE_IDS = {
    ADMISSIONS_NUMERATOR: ADMISSIONS_CRUDE,
    ADMISSIONS_BASE_NUMERATOR: ADMISSIONS_BASE_CRUDE,
}
DENOMINATOR_LABELS = {
    ADMISSIONS_DENOMINATOR: "Denominator",
    ADMISSIONS_BASE_DENOMINATOR: "Base Year Denominator",
}
NUMERATOR_LABELS = {
    ADMISSIONS_NUMERATOR: "Numerator",
    ADMISSIONS_BASE_NUMERATOR: "Base Year Numerator",
}
CRUDE_LABELS = {
    ADMISSIONS_NUMERATOR: "Numerator - Non-standardised",
    ADMISSIONS_BASE_NUMERATOR: "Base Year Numerator - Non-standardised",
}
ADMISSIONS_CODE = "NCD022"
NETWORK_TYPE = "PCN"

# --- appointment measures ------------------------------------------------------------------
WAITS_CATEGORIES = [
    "General Consultation Acute",
    "General Consultation Routine",
    "Unplanned Clinical Activity",
    "Clinical Triage",
    "Walk-in",
    "Home Visit",
    "Care Home Visit",
    "Care Related Encounter but does not fit into any other category",
]
SHORT_WAITS = ["Same Day", "1 Day", "2 to 7 Days", "8 to 14 Days"]
CARE_HOME_ROUND = "Patient contact during Care Home Round"
CARE_CONTEXT = "Care Related Encounter"
COUNTED_STATUSES = ["Unknown", "Attended", "Seen", "DNA"]

# --- organisation graph --------------------------------------------------------------------
OPERATIONAL = "Operational"
MEMBER_ROLES = ["GP PRACTICE", "PRESCRIBING COST CENTRE"]
NETWORK_ROLE = "RO272"
MEMBERSHIP = "IS PARTNER TO"
