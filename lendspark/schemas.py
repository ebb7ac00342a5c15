"""Declared schemas, closed sets, name maps and limits.

Nothing is inferred from data: every source is read with one of these schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
HOME_OWNERSHIP = ("RENT", "OWN", "MORTGAGE", "OTHER")
LOAN_INTENT = (
    "PERSONAL",
    "EDUCATION",
    "MEDICAL",
    "VENTURE",
    "HOMEIMPROVEMENT",
    "DEBTCONSOLIDATION",
)
LOAN_GRADE = ("A", "B", "C", "D", "E", "F", "G")
RISK_LEVEL = ("LOW", "MEDIUM", "HIGH")
DIRECTION = ("positive", "negative")
LOW_MAX = 30
MEDIUM_MAX = 70
AGE_MIN_EXCLUSIVE = 0
AGE_MAX_EXCLUSIVE = 120
MAX_BATCH_ITEMS = 500
SEED = 42
THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70)
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# ---------------------------------------------------------------- own choices
WORKING_AGE = 14          # employment may not start earlier (rule "implausible")
PROBABILITY_CLIP = 1e-15  # log loss keeps p inside [clip, 1 - clip]
PSI_FLOOR = 1e-6          # share given to an empty bin

TARGET = "loan_status"

#: Columns a model may never see: the outcome and what is only known after it.
FORBIDDEN_FEATURES = ("loan_status", "default_probability", "risk_score", "risk_level")

RAW_FILE = T.StructType(
    [
        T.StructField("person_age", T.IntegerType()),
        T.StructField("person_income", T.DoubleType()),
        T.StructField("person_home_ownership", T.StringType()),
        T.StructField("person_emp_length", T.DoubleType()),
        T.StructField("loan_intent", T.StringType()),
        T.StructField("loan_grade", T.StringType()),
        T.StructField("loan_amnt", T.DoubleType()),
        T.StructField("loan_int_rate", T.DoubleType()),
        T.StructField("loan_status", T.IntegerType()),
        T.StructField("loan_percent_income", T.DoubleType()),
        T.StructField("cb_person_default_on_file", T.StringType()),
        T.StructField("cb_person_cred_hist_length", T.IntegerType()),
    ]
)

#: One request, in the declared field order. This is also the feature order.
APPLICATION = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("income", T.DoubleType()),
        T.StructField("employment_years", T.DoubleType()),
        T.StructField("home_ownership", T.StringType()),
        T.StructField("loan_amount", T.DoubleType()),
        T.StructField("interest_rate", T.DoubleType()),
        T.StructField("term_months", T.IntegerType()),
        T.StructField("loan_intent", T.StringType()),
        T.StructField("credit_history_years", T.IntegerType()),
        T.StructField("late_payments", T.IntegerType()),
        T.StructField("previous_defaults", T.IntegerType()),
        T.StructField("credit_utilization", T.DoubleType()),
        T.StructField("active_credit_lines", T.IntegerType()),
    ]
)
FEATURES = tuple(APPLICATION.fieldNames())
REQUIRED = (
    "age",
    "income",
    "employment_years",
    "home_ownership",
    "loan_amount",
    "interest_rate",
    "loan_intent",
    "credit_history_years",
)

EXPLANATION = T.ArrayType(
    T.StructType(
        [
            T.StructField("feature", T.StringType()),
            T.StructField("impact", T.DoubleType()),
            T.StructField("direction", T.StringType()),
        ]
    )
)

#: The common 16-column shape any compatible file is brought to.
COMMON_SHAPE = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("income", T.DoubleType()),
        T.StructField("employment_years", T.DoubleType()),
        T.StructField("home_ownership", T.StringType()),
        T.StructField("loan_amount", T.DoubleType()),
        T.StructField("interest_rate", T.DoubleType()),
        T.StructField("term_months", T.IntegerType()),
        T.StructField("loan_intent", T.StringType()),
        T.StructField("loan_grade", T.StringType()),
        T.StructField("loan_percent_income", T.DoubleType()),
        T.StructField("credit_history_years", T.IntegerType()),
        T.StructField("previous_default", T.IntegerType()),
        T.StructField("late_payments", T.IntegerType()),
        T.StructField("credit_utilization", T.DoubleType()),
        T.StructField("active_credit_lines", T.IntegerType()),
        T.StructField("loan_status", T.IntegerType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("age", T.IntegerType(), False),
        T.StructField("income", T.DecimalType(14, 2), False),
        T.StructField("home_ownership", T.StringType(), False),
        T.StructField("employment_years", T.DecimalType(5, 2), False),
    ]
)
LOANS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("amount", T.DecimalType(14, 2), False),
        T.StructField("interest_rate", T.DecimalType(5, 2), False),
        T.StructField("term_months", T.IntegerType()),
        T.StructField("purpose", T.StringType(), False),
        T.StructField("grade", T.StringType()),
        T.StructField("loan_status", T.IntegerType()),
        T.StructField("loan_percent_income", T.DecimalType(5, 4)),
    ]
)
CREDIT_HISTORIES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("credit_history_years", T.IntegerType(), False),
        T.StructField("previous_defaults", T.IntegerType(), False),
        T.StructField("late_payments", T.IntegerType()),
        T.StructField("credit_utilization", T.DecimalType(5, 4)),
        T.StructField("active_credit_lines", T.IntegerType()),
    ]
)
PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("customer_id", T.StringType()),
        T.StructField("model_id", T.StringType(), False),
        T.StructField("request_id", T.StringType(), False),
        T.StructField("default_probability", T.DoubleType(), False),
        T.StructField("risk_score", T.IntegerType(), False),
        T.StructField("risk_level", T.StringType(), False),
        T.StructField("prediction_version", T.StringType(), False),
        T.StructField("latency_ms", T.DecimalType(10, 3), False),
        T.StructField("explanation", EXPLANATION, False),
    ]
)
MODELS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("algorithm", T.StringType(), False),
        T.StructField("training_dataset", T.StringType(), False),
        T.StructField("feature_version", T.StringType(), False),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("pr_auc", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("brier_score", T.DoubleType()),
        T.StructField("artifact_path", T.StringType(), False),
        T.StructField("trained_at", T.TimestampType(), False),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)
ARTIFACT_METADATA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("algorithm", T.StringType(), False),
        T.StructField("dataset_version", T.StringType(), False),
        T.StructField("feature_version", T.StringType(), False),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("trained_at", T.TimestampType(), False),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
    ]
)
EXPERIMENT = T.StructType(
    [
        T.StructField("experiment_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("dataset_version", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("seed", T.IntegerType()),
        T.StructField("artifact", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

#: Raw file column -> application field.
SOURCE_TO_API = {
    "person_age": "age",
    "person_income": "income",
    "person_emp_length": "employment_years",
    "person_home_ownership": "home_ownership",
    "loan_amnt": "loan_amount",
    "loan_int_rate": "interest_rate",
    "loan_intent": "loan_intent",
    "cb_person_cred_hist_length": "credit_history_years",
    "cb_person_default_on_file": "previous_defaults",
}
#: Application field -> table column.
API_TO_TABLE = {
    "loan_amount": "amount",
    "loan_intent": "purpose",
    "loan_grade": "grade",
}

#: Longest allowed text per (table, column).
LENGTH_LIMITS = {
    "models": {
        "name": 128,
        "version": 32,
        "algorithm": 64,
        "training_dataset": 64,
        "feature_version": 64,
        "artifact_path": 512,
    },
    "predictions": {"request_id": 64, "prediction_version": 32},
}
#: (precision, scale) per decimal column.
DECIMAL_LIMITS = {
    "income": (14, 2),
    "employment_years": (5, 2),
    "amount": (14, 2),
    "interest_rate": (5, 2),
    "credit_utilization": (5, 4),
    "loan_percent_income": (5, 4),
    "latency_ms": (10, 3),
}
