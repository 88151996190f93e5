"""Constants shared by the operators.

FIXED VALUES: these must stay exactly as written for results to match the
warehouse contract (column names, rule catalogue, reason texts, version tags).
"""

from __future__ import annotations

# ---- FIXED VALUES -------------------------------------------------------------
# Source extract columns, in file order.
SOURCE_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID",
    "Customer Name", "Segment", "Country", "City", "State", "Postal Code", "Region",
    "Product ID", "Category", "Sub-Category", "Product Name", "Sales", "Quantity",
    "Discount", "Profit",
]
# Columns the source contract requires (extras are allowed).
REQUIRED_SOURCE_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Customer ID",
    "Product ID", "Sales", "Quantity", "Discount", "Profit",
]
SOURCE_KEY = "Row ID"
SOURCE_DATE_FORMAT = "M/d/yyyy"
DEFAULT_POSTAL_CODE = "00000"
PIPELINE_VERSION = "1.0.0"
QUALITY_RULE_VERSION = "1.0.0"
LOAD_MODES = ("full", "append", "upsert", "snapshot")
FAILURE_MODES = ("STOP", "WARN", "QUARANTINE")
DEFAULT_OVERLAP_DAYS = 2
PROFILE_METRICS = ["total_rows", "null_order_ids", "duplicate_row_ids"]
# Quarantine reasons, first match wins, in this order.
REASON_QUANTITY = "quantity <= 0"
REASON_DISCOUNT = "discount outside [0,1]"
REASON_SALES = "sales < 0"
# Quality rule catalogue: (rule_name, contract_name, owner, severity, description).
CONTRACT_NAME = "retail_sales"
QUALITY_RULES = [
    ("silver/gold row count", CONTRACT_NAME, "data-engineering", "STOP",
     "Silver and Gold must contain the same number of rows"),
    ("null location keys", CONTRACT_NAME, "data-engineering", "STOP",
     "Published fact rows must resolve to a location key"),
    ("invalid measures", CONTRACT_NAME, "data-quality", "QUARANTINE",
     "Sales, quantity and discount must satisfy business constraints"),
    ("silver/gold totals", CONTRACT_NAME, "finance-data-owner", "STOP",
     "Silver and Gold measures must reconcile within tolerance"),
]
RECON_TOLERANCE = 0.000001
# ---- end FIXED VALUES ---------------------------------------------------------

# Money and ratio columns are exact decimals inside the warehouse; sums of doubles
# depend on partition order, decimals do not.
MONEY_TYPE = "decimal(18,4)"

# Column in which landed rows carry the name of the file they were read from.
SOURCE_FILE = "_source_file"
LOCATION_COLUMNS = ["country", "region", "state", "city", "postal_code"]
