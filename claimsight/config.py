"""Business constants and feature lists.

Every operator takes its thresholds as keyword parameters; the defaults come
from here so that one place documents them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the documented business rules of the
# claims application we reproduce (thresholds, labels, feature lists).
# ---------------------------------------------------------------------------

# Severity thresholds (currency units): Low < 5,000 <= Medium < 15,000
# <= High < 30,000 <= Critical.  "critical_severity" (50,000) is only the
# gauge range / alert text and is never used by the classifier.
LOW_SEVERITY = 5000.0
MEDIUM_SEVERITY = 15000.0
HIGH_SEVERITY = 30000.0
CRITICAL_SEVERITY = 50000.0
FNOL_DELAY_THRESHOLD_HOURS = 24.0
RESERVE_BUFFER_PERCENTAGE = 15.0
SEVERITY_LABELS = ("Low", "Medium", "High", "Critical")

# Feature-derivation thresholds
HIGH_RISK_MIN_AGE = 25
HIGH_RISK_MAX_AGE = 65
INEXPERIENCED_LICENCE_YEARS = 2
OLD_VEHICLE_YEARS = 10
EARLY_FNOL_HOURS = 24.0
LATE_CLAIM_HOURS = 48.0

# Estimate bands: right-closed intervals (0,1000], (1000,5000], ...
ESTIMATE_BUCKET_EDGES = (0.0, 1000.0, 5000.0, 10000.0, 20000.0, 50000.0, float("inf"))
ESTIMATE_BUCKET_LABELS = ("0-1k", "1k-5k", "5k-10k", "10k-20k", "20k-50k", "50+")

# Complexity rule
COMPLEX_TRAFFIC = ("High", "Severe")
COMPLEX_WEATHER = "Stormy"
ADVERSE_WEATHER = ("Rainy", "Foggy", "Snowy")

# Age bands used by the analytics dimension and the adequacy table
DRIVER_AGE_EDGES = (0, 25, 35, 45, 55, 65, 100)
DRIVER_AGE_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
VEHICLE_AGE_EDGES = (0, 3, 7, 12, 20, 100)
VEHICLE_AGE_LABELS_TREND = ("New (0-3)", "Modern (4-7)", "Mid (8-12)", "Old (13-20)", "Vintage (20+)")
VEHICLE_AGE_LABELS_ADEQUACY = ("0-3", "4-7", "8-12", "13-20", "20+")

# Reserve adequacy status labels, in rule order
ADEQUACY_STATUS = (
    "🔴Critical Deficit",
    "🟡Under-Reserved",
    "🔵Excessive Surplus",
    "🟢Adequate",
    "⚪Pending",
)

# Portfolio savings projection rates
RESERVE_OPTIMIZATION_RATE = 0.03
FRAUD_PREVENTION_RATE = 0.02
OPERATIONAL_SAVING_PER_CLAIM = 50.0
# Detailed savings defaults (form defaults)
CAPITAL_COST_PCT = 5.0
LABOUR_RATE_PER_HOUR = 45.0
LEAKAGE_RATE_PCT = 10.0
MINUTES_SAVED_PER_CLAIM = 15.0
DELAY_MITIGATION_RATE = 0.02
MONTHLY_MODEL_COST = 2000.0

# Prediction-variance confidence bands (coefficient of variation, %)
CV_HIGH_CONFIDENCE = 10.0
CV_MEDIUM_CONFIDENCE = 25.0

# Upload validation
UPLOAD_REQUIRED_COLUMNS = (
    "Policy_ID", "Claim_ID", "Estimated_Claim_Amount",
    "Driver_Age", "Vehicle_Age", "Claim_Type",
)
UPLOAD_NULL_PCT_LIMIT = 10.0
MISSING_THRESHOLD = 0.1

# Data columns
DATE_COLUMNS = ("Accident_Date", "FNOL_Date", "Settlement_Date",
                "Date_of_Birth", "Full_License_Issue_Date")
NUMERIC_IMPUTE_COLUMNS = ("Estimated_Claim_Amount", "Ultimate_Claim_Amount")
CATEGORICAL_IMPUTE_COLUMNS = ("Traffic_Condition", "Weather_Condition")
TARGET = "Ultimate_Claim_Amount"

CATEGORICAL_FEATURES = (
    "Traffic_Condition", "Weather_Condition", "High_Risk_Driver",
    "Inexperienced_Driver", "Old_Vehicle", "Early_FNOL", "Estimate_Bucket",
    "Claim_Type", "Vehicle_Type", "Complexity_Score",
)
NUMERIC_FEATURES = (
    "FNOL_Delay", "Driver_Age", "License_Age", "Vehicle_Age",
    "Estimate_to_Age_Ratio", "Estimate_Relative_to_Type",
)
DERIVED_FEATURES = (
    "FNOL_Delay", "Driver_Age", "License_Age", "Vehicle_Age",
    "High_Risk_Driver", "Inexperienced_Driver", "Old_Vehicle", "Early_FNOL",
    "Estimate_to_Age_Ratio", "Estimate_Bucket", "Estimate_Relative_to_Type",
    "Complexity_Score",
)

# Business context for explained features: name, impact, action
FEATURE_BUSINESS_CONTEXT = (
    ("Estimated_Claim_Amount", "Initial FNOL Estimate", "Baseline cost assessment", "Review estimation accuracy"),
    ("Driver_Age", "Driver Age", "Risk profile indicator", "Monitor age-based risk patterns"),
    ("Vehicle_Age", "Vehicle Age", "Repair cost predictor", "Assess depreciation impact"),
    ("License_Age", "License Experience", "Driver experience level", "Experience-based risk assessment"),
    ("Claim_Type", "Claim Category", "Cost pattern driver", "Type-specific handling protocols"),
    ("FNOL_Delay", "Reporting Delay", "Cost escalation indicator", "Investigate delayed reporting"),
    ("Weather_Condition", "Weather Conditions", "Severity amplifier", "Weather-based risk adjustment"),
    ("Traffic_Condition", "Traffic Density", "Accident severity context", "Traffic pattern analysis"),
)

# Texts that results must show word for word; a value stands between "before" and "after"
SAVINGS_ROWS = (  # category, driver, column, logic
    ("Capital Release", "Reserving Accuracy", "cap_release", "5% RoC on over-reserved capital"),
    ("Leakage Mitigation", "ML Model Lift", "leakage", "10% capture of Human vs Model error gap"),
    ("Automation Gains", "Severity Triage", "automation", "£15 labor saving per automated claim"),
    ("Delay Mitigation", "FNOL Response", "delay_mitigation", "2% reduction in late-report penalties"),
)
ALERT_TEXTS = {  # kind, title, before, after
    "critical": ("alert-high", "⚠️ Critical Claims Alert", "",
                 " claims exceed critical threshold (£50,000). Immediate review recommended."),
    "savings": ("alert-low", "💰 Projected Cost Savings", "ML-driven optimization projects ",
                " in savings through improved reserve accuracy and fraud detection."),
    "average": ("alert-medium", "📊 Elevated Average Claim Cost", "Average claim (",
                ") exceeds industry benchmarks. Consider enhanced fraud detection protocols."),
}
INSIGHT_TEXTS = {  # kind, title, before, after, action, priority
    "high_value": ("alert", "High-Value Claim Alert", "Predicted amount (",
                   ") exceeds critical threshold. Immediate senior review recommended.",
                   "Escalate to claims manager and fraud investigation team", "High"),
    "late": ("warning", "Delayed FNOL Reporting", "Claim reported ", " hours after incident.",
             "Request detailed incident timeline; check for fraud indicators", "Medium"),
    "young": ("info", "Young Driver Risk Profile", "Driver age suggests higher risk category.", "",
              "Apply enhanced scrutiny to damage assessment", "Medium"),
    "senior": ("info", "Senior Driver Consideration", "Elderly driver may require additional support.", "",
               "Ensure clear communication and customer support", "Low"),
    "old_vehicle": ("warning", "Older Vehicle Assessment", "Vehicle age (", " years) may affect repair economics.",
                    "Evaluate total loss vs. repair cost-effectiveness", "Medium"),
    "weather": ("info", "Adverse Weather Conditions", "Incident occurred in ", " conditions.",
                "Document weather impact on incident severity", "Low"),
}
RISK_TEXTS = {
    "young": "🔴 Young driver (high risk)",
    "senior": "🟡 Senior driver (moderate risk)",
    "standard_age": "🟢 Driver age in standard range",
    "old_vehicle": "🟡 Older vehicle (higher repair costs)",
    "new_vehicle": "🟢 Newer vehicle",
    "late": "🔴 Significant FNOL delay (fraud indicator)",
    "timely": "🟢 Timely FNOL reporting",
    "weather": "🟡 Adverse weather conditions",
}
ADVERSE_WEATHER_LABELLED = ("Rainy", "Snowy", "Foggy")
ESCALATION_STEPS = (
    "✓ Escalate to senior claims handler",
    "✓ Initiate fraud investigation protocol",
    "✓ Request detailed damage assessment",
)
STANDARD_STEPS = (
    "✓ Set reserve to recommended amount",
    "✓ Schedule repair assessment within 48 hours",
    "✓ Contact customer for additional information",
)

# Model tuning grids (scikit-learn names mapped to MLlib parameters)
ELASTIC_NET_GRID = {
    "regParam": [0.01, 0.1, 1.0, 10.0],
    "elasticNetParam": [0.1, 0.5, 0.7, 0.9, 0.95, 0.99, 1.0],
    "maxIter": [1000, 5000],
    "tol": [0.0001],
}
RANDOM_FOREST_GRID = {
    "numTrees": [50, 100, 200, 500],
    "maxDepth": [10, 20, 30],          # 30, MLlib's deepest, stands for "unlimited"
    "minInstancesPerNode": [1, 2],
}
GRADIENT_BOOSTING_GRID = {
    "maxIter": [100, 200, 500],
    "stepSize": [0.01, 0.1, 0.2],
    "maxDepth": [3, 5, 7],
}
HIST_BOOSTING_GRID = {
    "maxBins": [128, 256, 512],
    "maxIter": [500, 750, 1000],
    "stepSize": [0.05, 0.1],
    "maxDepth": [6, 9],
}
TEST_SIZE = 0.2
RANDOM_STATE = 42
CV_FOLDS = 5
