"""Canonical columns, business constants and fixed dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "customer_id"
USAGE = "average_data_usage"
REVENUE = "average_revenue"
DOU = "average_dou"
PACK = "pack_flag"
TENURE = "aon"
CHURN = "churn"
SEGMENT = "segment"
GROUP = "campaign_group"

# ---- fixed values -----------------------------------------------------------
PAYLOAD = (USAGE, REVENUE, DOU, PACK, TENURE, CHURN)
CANONICAL = (ID, *PAYLOAD)
CLUSTER_FEATURES = (USAGE, REVENUE, DOU, PACK)
CAPPED = (USAGE, REVENUE)
IMPUTED = (USAGE, REVENUE)
RATIOS = ("revenue_per_gb", "usage_intensity", "revenue_per_active_day")
DORMANT = "is_dormant"
CHURN_FEATURES = (*CLUSTER_FEATURES, TENURE, *RATIOS, DORMANT)
BALANCE_COVARIATES = (*CLUSTER_FEATURES, TENURE, CHURN)

MIN_TENURE_DAYS = 90
MAX_ACTIVE_DAYS = 30
DORMANT_DAYS = 5
FENCE_K = 3.0
RATIO_CAP_QUANTILE = 0.995
RATIO_EPSILON = 1e-6

N_CLUSTERS = 6
SWEEP_K = tuple(range(2, 11))
SCORE_SAMPLE = 10_000
KMEANS_RESTARTS = 10
MIXTURE_RESTARTS = 5
MIXTURE_REG = 1e-5

HOLDOUT_FRACTION = 0.03
TEST_FRACTION = 0.20
CV_FOLDS = 5
SEED = 42
BALANCE_LIMIT = 0.10
ESCALATE_AT = 0.60
LOW_CONFIDENCE = 0.60
REVIEW_CONFIDENCE = 0.80

CONTROL = "UCG"
TARGET = "UTG"

# Segment names by revenue rank, 1 = highest mean revenue.
SEGMENT_BY_RANK = {
    1: "Premium Power",
    2: "Loyal Core",
    3: "Sleeping Giant",
    4: "Deal Seeker",
    5: "Question Mark",
    6: "Comfortably Numb",
}

# segment -> (offer, action, priority)
OFFERS = {
    "Premium Power": ("Priority 5G + concierge retention call", "Retain", "Very High"),
    "Loyal Core": ("Loyalty tier upgrade, 12-month lock-in", "Retain", "High"),
    "Sleeping Giant": ("Data-to-revenue upsell: unlimited plan", "Upsell", "High"),
    "Deal Seeker": ("Margin-safe bundle, no discount stacking", "Sustain", "Medium"),
    "Question Mark": ("Onboarding nudge + 3-day trial pack", "Activate", "Medium"),
    "Comfortably Numb": ("Low-cost reactivation SMS, no spend", "Reactivate", "Low"),
}

HOLDOUT_OFFER = ("HOLDOUT - no contact", "None", "N/A")
UNSEGMENTED = ("UNSEGMENTED (AON < 90d)", "Hold - insufficient tenure", "None")

# (upper bound, label); intervals are closed on the right.
RISK_BANDS = ((0.25, "Low"), (0.50, "Moderate"), (0.75, "High"), (1.01, "Critical"))
EXPORT_COLUMNS = (
    ID, *CLUSTER_FEATURES, TENURE, "gmm_cluster", SEGMENT, "gmm_confidence",
    CHURN, "churn_probability", "churn_prediction",
    GROUP, "offer", "action", "priority",
)

# ---- end of fixed values ----------------------------------------------------

RAW_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType()),
    T.StructField(USAGE, T.DoubleType()),
    T.StructField(REVENUE, T.DoubleType()),
    T.StructField(DOU, T.DoubleType()),
    T.StructField(PACK, T.IntegerType()),
    T.StructField(TENURE, T.IntegerType()),
    T.StructField(CHURN, T.IntegerType()),
])
