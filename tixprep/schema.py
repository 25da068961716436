"""Ticket table schema, target columns and null-default policies."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the ticket table (snake_case versions of the spreadsheet headers).
NUMBER = "number_fld"
SHORT = "short_description"
DESC = "description"
CATEGORY = "category"
SUBCATEGORY = "subcategory"
GROUP = "assignment_group"
PRIORITY = "priority"
CONTACT = "contact_type"
LOCATION = "location"
U_DEPT = "u_department"
OPENED_DEPT = "opened_by_department"
DATE_OPENED = "date_opened"

TARGETS = [CATEGORY, SUBCATEGORY, GROUP]
TEXT_FIELDS = [SHORT, DESC]
META_FIELDS = [PRIORITY, CONTACT, LOCATION, U_DEPT, OPENED_DEPT]
# Field order of the combined 7-field text.
COMBINED_FIELDS = [SHORT, DESC, PRIORITY, CONTACT, LOCATION, U_DEPT, OPENED_DEPT]
# Low-cardinality columns the profile path treats as categorical.
CATEGORICAL = [CATEGORY, SUBCATEGORY, PRIORITY, GROUP, LOCATION, OPENED_DEPT, U_DEPT, "u_submitted_by"]

TICKET_SCHEMA = T.StructType(
    [
        T.StructField(NUMBER, T.LongType(), False),
        T.StructField(SHORT, T.StringType()),
        T.StructField(DESC, T.StringType()),
        T.StructField(CATEGORY, T.StringType()),
        T.StructField(SUBCATEGORY, T.StringType()),
        T.StructField(GROUP, T.StringType()),
        T.StructField(PRIORITY, T.StringType()),
        T.StructField(CONTACT, T.StringType()),
        T.StructField(LOCATION, T.StringType()),
        T.StructField(U_DEPT, T.StringType()),
        T.StructField(OPENED_DEPT, T.StringType()),
        T.StructField(DATE_OPENED, T.StringType()),
        T.StructField("total_price", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# --- fixed values (must equal the reference's) --------------------------------------------
SEP = " [SEP] "
OTHER = "Other"
MIN_SAMPLES = 50            # rare threshold per target
OVERSAMPLE_MULTIPLIER = 2   # new copies per minority row
THRESHOLD_FACTOR = 0.3      # minority: n < 0.3 * max
SYNONYM_REPLACE_COUNT = 1
MAX_WEIGHT = 10.0
RARE_MULTIPLIER = 5
HEAVY_BONUS_MULTIPLIER = 2
HEAVY_THRESHOLD = 25
TRANSLATE_SHARE = 0.5
TRANSLATE_CHUNK = 100
MAX_LENGTH = 512
BATCH_SIZE = 128
VAL_SHARE = 0.1
SPLIT_SEED = 42
SAMPLE_SEED = 42
PATIENCE = 3
NUM_EPOCHS = 10

# Null defaults by policy: "main" = batch preparation, "manual" = notebook bundle path,
# "profile" = notebook profiling path.
DEFAULTS = {
    "main": {
        SHORT: "",
        DESC: "",
        PRIORITY: "UnknownPriority",
        CONTACT: "OtherContact",
        LOCATION: "UnknownLocation",
        U_DEPT: "UnknownDepartment",
        OPENED_DEPT: "UnknownDepartment",
    },
    "manual": {
        SHORT: "",
        DESC: "",
        PRIORITY: "3 - Medium (4 Days)",
        CONTACT: "Other",
        LOCATION: "Unknown",
        U_DEPT: "Unknown",
        OPENED_DEPT: "Unknown",
    },
    "profile": {
        SHORT: "",
        DESC: "",
        CATEGORY: "Unknown",
        SUBCATEGORY: "Unknown",
        PRIORITY: "Unknown",
        GROUP: "Unknown",
        LOCATION: "Unknown Location",
        OPENED_DEPT: "Unknown Department",
        U_DEPT: "Unknown Department",
        "u_submitted_by": "Unknown",
    },
}
