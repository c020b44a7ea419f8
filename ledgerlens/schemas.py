"""Raw-table contracts: column types, keys, references and value lists."""

from __future__ import annotations

# Column types of the seven raw tables. Dates and times arrive as text.
BRONZE = {
    "customers": (
        "customer_id string, full_name string, email string, phone string, country string, "
        "segment string, kyc_status string, risk_score double, date_joined string, "
        "is_pep boolean, is_sanctioned boolean"
    ),
    "accounts": (
        "account_id string, customer_id string, account_type string, currency string, "
        "balance double, credit_limit double, status string, open_date string, "
        "branch_code string, is_joint boolean"
    ),
    "merchants": (
        "merchant_id string, merchant_name string, mcc_code string, mcc_description string, "
        "country string, risk_level string, is_blacklisted boolean, avg_txn_amount double, "
        "registered_date string"
    ),
    "transactions": (
        "transaction_id string, account_id string, merchant_id string, transaction_type string, "
        "channel string, amount double, currency string, txn_datetime string, txn_date string, "
        "txn_hour int, is_international boolean, counterparty_id string, ip_address string, "
        "device_id string, status string, response_code string"
    ),
    "fraud_labels": (
        "fraud_id string, transaction_id string, fraud_type string, fraud_status string, "
        "reported_by string, detected_datetime string, confirmed_datetime string, "
        "loss_amount double, recovered_amount double, investigator_id string, notes string"
    ),
    "alerts": (
        "alert_id string, transaction_id string, rule_id string, alert_type string, "
        "severity string, alert_status string, score double, created_datetime string, "
        "resolved_datetime string, analyst_id string, false_positive boolean, explanation string"
    ),
    "audit_logs": (
        "log_id string, entity_type string, entity_id string, action string, actor_type string, "
        "actor_id string, log_datetime string, ip_address string, session_id string, "
        "status string, change_summary string, compliance_flag boolean"
    ),
}

TABLES = tuple(BRONZE)

PRIMARY_KEY = {
    "customers": "customer_id",
    "accounts": "account_id",
    "merchants": "merchant_id",
    "transactions": "transaction_id",
    "fraud_labels": "fraud_id",
    "alerts": "alert_id",
    "audit_logs": "log_id",
}

# (child table, child column, parent table, parent column)
REFERENCES = (
    ("accounts", "customer_id", "customers", "customer_id"),
    ("transactions", "account_id", "accounts", "account_id"),
    ("transactions", "merchant_id", "merchants", "merchant_id"),
    ("fraud_labels", "transaction_id", "transactions", "transaction_id"),
    ("alerts", "transaction_id", "transactions", "transaction_id"),
)

# ---- fixed values: the value lists of the data model -------------------------------------------
ACCOUNT_TYPES = ["Checking", "Savings", "Credit", "Loan", "Forex", "Investment"]
CURRENCIES = ["USD", "EUR", "GBP", "INR", "SGD", "AED", "CAD", "AUD"]
MCC_CODES = ["5411", "5912", "5812", "7011", "4111", "5999", "6011", "7372", "5944", "4812"]
MCC_LABELS = ["Grocery", "Pharmacy", "Restaurant", "Hotel", "Transit", "Misc Retail",
              "ATM", "Software", "Jewelry", "Telecom"]
TRANSACTION_TYPES = ["Purchase", "ATM Withdrawal", "Wire Transfer", "ACH", "Bill Payment",
                     "Refund", "P2P Transfer", "FX Conversion", "Loan Payment", "Cash Deposit"]
RESPONSE_CODES = ["00", "05", "51", "54", "57"]
FRAUD_TYPES = ["Card Cloning", "Account Takeover", "Identity Theft", "Money Laundering",
               "Phishing", "Synthetic Identity", "Bust-Out", "Card Not Present", "Insider Fraud"]
REPORTERS = ["System", "Customer", "Branch", "AML Team", "Regulator", "Partner Bank"]
ALERT_TYPES = ["Velocity Check", "Amount Threshold", "Geo Anomaly", "Device Anomaly",
               "Blacklist Match", "Dormant Account Activity", "Round Amount", "Night Transaction",
               "Multiple Declines", "Cross-Border High Value"]
ENTITY_TYPES = ["Customer", "Account", "Transaction", "Alert"]
AUDIT_ACTIONS = ["Login", "Logout", "Password Change", "Profile Update", "Large Transfer Approved",
                 "Account Suspended", "KYC Update", "Fraud Case Opened", "Alert Escalated",
                 "Beneficiary Added", "Limit Override", "Manual Review Completed"]
AUDIT_ACTORS = ["Customer", "Analyst", "System", "Branch Officer", "Compliance Officer", "API"]
# ------------------------------------------------------------------------------------------------
