"""Default parameters of the analytics jobs.

Fixed values that must equal the reference programme for equal results:
fill constants, window lengths, thresholds and business constants.
"""

from __future__ import annotations

# --- fixed values (must equal the reference) ---------------------------------
DEFAULT_JOB_TYPE = "Unknown"
DEFAULT_EMAIL_PROVIDER = "unknown@example.com"
MISSING_FLOAT_DEFAULT = 0.0
MISSING_BOOL_DEFAULT = False
UNKNOWN_LABEL = "Unknown"
MISSING_CATEGORY = "missing"
OTHER_EMAIL = "others"

CHURN_OBSERVATION_DAYS = 90
CHURN_CONTROL_DAYS = 30
CHURN_STEP_DAYS = 30
CHURN_RECENCY_DAYS = 90          # legacy threshold churn flag and last-window filter

PROPENSITY_OBSERVATION_DAYS = 120
PROPENSITY_PREDICTION_DAYS = 60
PROPENSITY_STEP_DAYS = 30
PROPENSITY_CATEGORY = "9"

MBA_MIN_SUPPORT = 0.003
MBA_MIN_LIFT = 0.3
MBA_TOP_N = 10
MBA_EDGE_RULES = 20
MBA_EDGE_LIFT = 2.0

HIGH_VALUE_SPEND_QUANTILE = 0.75
HIGH_VALUE_SCORE_THRESHOLD = 0.7
CAMPAIGN_SCORE_THRESHOLD = 0.8
RISK_LABELS = ("Low", "Medium", "High")

PROFIT_MARGIN = 0.3
EMAIL_COST = 0.05
FULFILLMENT_COST = 1.00

TFIDF_VOCAB_SIZE = 5000
TOKEN_PATTERN = r"(?U)\w\w+"
N_CLUSTERS = 3
N_TREES = 100
SEED = 42
TEST_FRACTION = 0.2
PRIMARY_CATEGORY_SHARE = 0.8

SENTIMENT_SCORES = {"positive": 1, "neutral": 0, "negative": -1}
DETRACTOR_MAX = 0.3               # score <= 0.3 -> Detractor
PROMOTER_MIN = 0.7                # score > 0.7  -> Promoter
OUTLIER_Z = 3.0
HISTOGRAM_BINS = 50
LARGE_GAP_DAYS = 90
# review cleanup removes these literal substrings, in this order
REVIEW_STRIP_TOKENS = ("<", ">", "href", "br")
# one-hot prefixes decoded in the campaign export
ONE_HOT_PREFIXES = ("cat__product_class_", "cat__job_type_", "cat__region_",
                    "cat__loyalty_type_", "cat__email_provider_")
# --- end of fixed values -----------------------------------------------------

# Greatest depth of trees, Spark's own limit; the fits take it as an argument.
TREE_DEPTH = 30
# Depth of the forests of the category propensities, of which one is fitted per
# class (25 at sf0.01); README has the times.
CATEGORY_TREE_DEPTH = 10
# Fits of a clustering, of which the cheapest is kept.
CLUSTER_STARTS = 5
# Memory in which node statistics of one pass are gathered per task: deep forests need fewer passes with more.
TREE_MEMORY_MB = 512
# Type in which money is summed: exact to six decimals.
MONEY_TYPE = "decimal(28,6)"

# Reference dates are explicit arguments, never the wall clock.
AS_OF = "2002-01-01"
LEGACY_AS_OF = "2001-09-01"
# product used for the single-product propensity target on the test tables
PROPENSITY_PRODUCT = "42"
# physical name of the loyalty status column as found in the data
LOYALTY_STATUS_COL = "loyatlty_status"
