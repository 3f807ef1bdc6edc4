"""Names, bins, value sets and limits of the claims data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical order of the cleaned claims table.
FINAL_COLUMNS = [
    "months_as_customer", "age", "policy_number", "policy_state", "policy_csl",
    "policy_deductable", "policy_annual_premium", "insured_sex", "insured_education_level",
    "insured_occupation", "capital-gains", "capital-loss", "incident_type", "collision_type",
    "incident_severity", "incident_hour_of_the_day", "number_of_vehicles_involved",
    "property_damage", "bodily_injuries", "witnesses", "police_report_available",
    "total_claim_amount", "injury_claim", "property_claim", "vehicle_claim", "auto_make",
    "auto_year", "has_claim", "age_group", "tenure_group", "is_fraud",
]

STRING_COLUMNS = [
    "policy_number", "policy_state", "policy_csl", "insured_sex", "insured_education_level",
    "insured_occupation", "incident_type", "collision_type", "incident_severity",
    "property_damage", "police_report_available", "auto_make",
]
DERIVED_COLUMNS = {
    "has_claim": "total_claim_amount",
    "age_group": "age",
    "tenure_group": "months_as_customer",
    "is_fraud": "fraud_reported",
}
NUMERIC_COLUMNS = [c for c in FINAL_COLUMNS if c not in STRING_COLUMNS and c not in DERIVED_COLUMNS]

# Right-closed bins and their labels.
AGE_EDGES = [0, 25, 35, 45, 55, 65, 100]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]
TENURE_EDGES = [0, 12, 24, 48, 120, 500]
TENURE_LABELS = ["0-1yr", "1-2yr", "2-4yr", "4-10yr", "10yr+"]

# Validation of cleaned rows.
REQUIRED_COLUMNS = [
    "policy_number", "age", "months_as_customer", "policy_state",
    "policy_annual_premium", "total_claim_amount", "is_fraud",
]
CLEAN_RANGES = {
    "age": (18, 100),
    "months_as_customer": (0, 500),
    "policy_annual_premium": (0, 100000),
    "total_claim_amount": (0, 1000000),
}
CLEAN_VALUES = {
    "policy_state": ["Oh", "In", "Il", "Pa", "Ny"],
    "insured_sex": ["M", "F"],
    "incident_severity": ["Trivial Damage", "Minor Damage", "Major Damage", "Total Loss"],
}

# Expectations on raw rows.
EXPECTED_ORDER = [
    "months_as_customer", "age", "policy_number", "policy_state", "policy_csl",
    "policy_deductable", "policy_annual_premium", "insured_sex", "fraud_reported",
    "incident_type", "incident_severity", "total_claim_amount", "auto_make",
]
RAW_RANGES = {
    **CLEAN_RANGES,
    "capital-gains": (0, 100000),
    "bodily_injuries": (0, 10),
    "witnesses": (0, 5),
}
RAW_VALUES = {
    "policy_state": ["OH", "IN", "IL", "PA", "NY"],
    "insured_sex": ["M", "F"],
    "incident_severity": ["Trivial Damage", "Minor Damage", "Major Damage", "Total Loss"],
}
NOT_NULL_COLUMNS = ["policy_number", "age", "total_claim_amount"]

# Record contract, version by version (name, type, nullable).
CONTRACTS = {
    "v1": [
        ("policy_number", "string", False),
        ("months_as_customer", "int", True),
        ("age", "int", True),
        ("policy_state", "string", False),
        ("policy_csl", "string", False),
        ("policy_annual_premium", "double", False),
        ("policy_deductable", "int", True),
        ("insured_sex", "string", False),
        ("incident_type", "string", False),
        ("incident_severity", "string", False),
        ("incident_hour_of_the_day", "int", True),
        ("number_of_vehicles_involved", "int", True),
        ("bodily_injuries", "int", True),
        ("witnesses", "int", True),
        ("police_report_available", "string", False),
        ("total_claim_amount", "double", False),
        ("injury_claim", "double", True),
        ("property_claim", "double", True),
        ("vehicle_claim", "double", True),
        ("auto_make", "string", False),
        ("auto_year", "int", True),
        ("timestamp", "string", False),
    ],
}
# Symbols of the contract's enumerated fields, version by version.
CONTRACT_ENUMS = {
    "v1": {
        "policy_state": ["OH", "IN", "IL", "PA", "NY"],
        "insured_sex": ["M", "F"],
        "incident_severity": ["Trivial Damage", "Minor Damage", "Major Damage", "Total Loss"],
        "police_report_available": ["YES", "NO"],
    },
}
CONTRACT_REQUIRED = ["policy_number", "policy_state", "policy_annual_premium", "total_claim_amount"]
CONTRACT_NUMERIC = ["months_as_customer", "age", "policy_annual_premium", "total_claim_amount"]

# Bounds of a scoring request, (column, low, high) and (column, max length).
REQUEST_BOUNDS = [
    ("months_as_customer", 0, 500),
    ("age", 18, 100),
    ("policy_deductable", 0, None),
    ("policy_annual_premium", 0, None),
    ("total_claim_amount", 0, None),
    ("vehicle_claim", 0, None),
    ("property_claim", 0, None),
    ("injury_claim", 0, None),
]
REQUEST_LENGTHS = [
    ("policy_state", 10),
    ("policy_csl", 20),
    ("insured_sex", 10),
    ("insured_education_level", 20),
    ("insured_occupation", 50),
    ("incident_type", 50),
    ("incident_severity", 20),
    ("auto_make", 30),
]

# Columns coerced to numbers on load and on read, columns shown by the browser.
LOAD_NUMERIC = [
    "policy_deductable", "months_as_customer", "age", "policy_annual_premium", "capital-gains",
    "capital-loss", "incident_hour_of_the_day", "number_of_vehicles_involved", "bodily_injuries",
    "witnesses", "total_claim_amount", "injury_claim", "property_claim", "vehicle_claim",
    "auto_year", "is_fraud",
]
READ_NUMERIC = [c for c in LOAD_NUMERIC if c != "is_fraud"]
BROWSER_COLUMNS = [
    "policy_number", "auto_make", "incident_type", "incident_severity",
    "total_claim_amount", "policy_annual_premium", "is_fraud",
]

# Text a data frame reader takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Thresholds.
FRAUD_THRESHOLD = 0.35
DRIFT_THRESHOLD = 0.05
PREDICTION_DRIFT_THRESHOLD = 0.10
REFERENCE_PROBABILITY = 0.24
MIN_ACCURACY = 0.70
MIN_AUC = 0.70
FEATURE_TTL_SECONDS = 3600
RETAINED_RUNS = 30
RERUN_HOURS = 6

ENGINEERED_FEATURES = [
    "claim_to_premium_ratio", "vehicle_property_ratio", "injury_ratio", "tenure_age_ratio",
    "no_witness_injury", "complex_no_witness", "deductible_claim_ratio", "net_capital",
]

_RAW_TYPES = {
    **{c: T.LongType() for c in ("months_as_customer", "age", "policy_deductable",
                                 "incident_hour_of_the_day", "auto_year")},
    **{c: T.IntegerType() for c in ("number_of_vehicles_involved", "bodily_injuries", "witnesses")},
    **{c: T.DoubleType() for c in ("policy_annual_premium", "capital-gains", "capital-loss",
                                   "total_claim_amount", "injury_claim", "property_claim",
                                   "vehicle_claim")},
}
RAW_SCHEMA = T.StructType(
    [T.StructField(c, _RAW_TYPES.get(c, T.StringType())) for c in FINAL_COLUMNS if c not in DERIVED_COLUMNS]
    + [T.StructField("fraud_reported", T.StringType()), T.StructField("_c39", T.StringType()),
       T.StructField("incident_date", T.TimestampNTZType())]
)
CLEAN_SCHEMA = T.StructType([
    T.StructField(
        c,
        T.DoubleType() if c in NUMERIC_COLUMNS
        else T.IntegerType() if c in ("has_claim", "is_fraud")
        else T.StringType(),
    )
    for c in FINAL_COLUMNS
])
