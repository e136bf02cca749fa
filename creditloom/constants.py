"""Fixed values of the lending data model, and the declared source schemas."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------------
# Whole-value tokens that mean "missing".
NULL_TOKENS = ["_", "NA", "na", "N/A"]
ATTRIBUTE_NULL_TOKENS = ["_", "NA", "na", "N/A", "_______"]

# Accepted payment behaviours; anything else becomes null.
PAYMENT_BEHAVIOURS = [
    "High_spent_Large_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Large_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
]

SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"

# Separator of the loan-type list. The first alternative always wins, so the last item of
# "A, B, and C" keeps its "and "; LOAN_TYPE_SEPARATOR_STRICT also strips it.
LOAN_TYPE_SEPARATOR = ", |, and "
LOAN_TYPE_SEPARATOR_STRICT = r",\s*(?:and\s+)?"

# Age bands: upper bounds (exclusive) and names; the last name takes the rest.
AGE_BANDS = [(25, "<25"), (40, "25–39"), (60, "40–59")]
AGE_BAND_REST = "60+"

DPD_CUTOFF = 30
MOB_CUTOFF = 6
CAP_LOWER = 0.01
CAP_UPPER = 0.95
PSI_BUCKETS = 10
PSI_EMPTY_BIN = 1e-8
PSI_THRESHOLD = 0.20
FEATURE_PREFIX = "fe_"
CLICKSTREAM_FEATURES = [f"fe_{i}" for i in range(1, 21)]

FINANCIAL_DOUBLES = [
    "Annual_Income",
    "Monthly_Balance",
    "Outstanding_Debt",
    "Amount_invested_monthly",
    "Changed_Credit_Limit",
    "Total_EMI_per_month",
    "Credit_Utilization_Ratio",
]
FINANCIAL_COUNTS = ["Num_of_Loan", "Num_of_Delayed_Payment"]
FINANCIAL_INTS = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_Credit_Inquiries"]
FINANCIAL_CAPPED = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
]
FINANCIAL_CATEGORIES = ["Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount"]
ATTRIBUTE_CATEGORIES = ["Occupation", "Age_group"]

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

# Columns that never reach the feature store: target, personal data, raw inputs.
FEATURE_STORE_DROPS = [
    "label",
    "label_snapshot_date",
    "Name",
    "SSN",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Age",
    "Num_of_Loan",
    "Type_of_Loan",
    "Loan_Types_Array",
    "Credit_History_Age",
    "Credit_Mix",
    "Payment_Behaviour",
    "Payment_of_Min_Amount",
]

# Hyper-parameter space of the boosted-tree search (n_estimators, max_depth, learning_rate,
# subsample, colsample, gamma, min_child_weight).
SEARCH_SPACE = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}
# --- end of fixed values ----------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Dirty columns arrive as text and are parsed by the cleaning operators, so no inference
# pass over the files is needed.
LOANS_SCHEMA = _struct(**LOAN_TYPES)
FINANCIALS_SCHEMA = _struct(
    Customer_ID="string",
    snapshot_date="date",
    Annual_Income="string",
    Monthly_Inhand_Salary="double",
    Num_Bank_Accounts="int",
    Num_Credit_Card="int",
    Interest_Rate="int",
    Num_of_Loan="string",
    Type_of_Loan="string",
    Num_of_Delayed_Payment="string",
    Changed_Credit_Limit="string",
    Num_Credit_Inquiries="int",
    Credit_Mix="string",
    Outstanding_Debt="string",
    Credit_Utilization_Ratio="string",
    Credit_History_Age="string",
    Payment_of_Min_Amount="string",
    Total_EMI_per_month="string",
    Amount_invested_monthly="string",
    Payment_Behaviour="string",
    Monthly_Balance="string",
)
ATTRIBUTES_SCHEMA = _struct(
    Customer_ID="string", snapshot_date="date", Name="string", Age="string", SSN="string", Occupation="string"
)
CLICKSTREAM_SCHEMA = _struct(
    Customer_ID="string", snapshot_date="date", **{c: "int" for c in CLICKSTREAM_FEATURES}
)
RUNS_SCHEMA = _struct(
    run_id="string",
    start_time="timestamp",
    tags="map<string,string>",
    params="map<string,string>",
    metrics="map<string,double>",
)
METRICS_SCHEMA = _struct(run_id="string", snapshot_date="string", metric_name="string", value="double")
DATA_QUALITY_SCHEMA = _struct(snapshot_date="date", null_pct="double")

SOURCE_SCHEMAS = {
    "clickstream": CLICKSTREAM_SCHEMA,
    "attributes": ATTRIBUTES_SCHEMA,
    "financials": FINANCIALS_SCHEMA,
    "loans": LOANS_SCHEMA,
}
# Layers written partitioned by snapshot month.
PARTITIONED = {
    "bronze": ["clickstream", "financials"],
    "silver": ["clickstream", "loans"],
}
