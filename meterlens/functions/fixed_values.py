"""Results are only right if these stay exactly as they are."""

from decimal import Decimal

# Upper bound in milliseconds (inclusive) and label of each duration bucket.
DURATION_BUCKETS = (
    (60_000, "<60s"),
    (300_000, "60s-5m"),
    (600_000, "5m-10m"),
    (1_800_000, "10m-30m"),
)
LONGEST_BUCKET = ">30m"

# Prices per credit and per terabyte-month.
QUERY_CREDIT_PRICE = Decimal("2.56")
BILL_CREDIT_PRICE = Decimal("2.40")
CLUSTERING_CREDIT_PRICE = Decimal("2.32")
BILL_STORAGE_PRICE = Decimal("23")
TABLE_STORAGE_PRICE = Decimal("16.86")
ORGANISATION_STORAGE_PRICE = Decimal("18.40")

# First month of each credit price, oldest first; None means "from the start".
CREDIT_PRICE_TIERS = ((None, Decimal("2.32")), ("2025-05-01", Decimal("2.56")))

# Query-operator flags.
UNION_OPERATOR = "UnionAll"
AGGREGATE_OPERATOR = "Aggregate"
PRUNING_RATIO = 0.8
PRUNING_PARTITIONS = 20_000

# Billing.
CLOUD_SERVICES_WAREHOUSE = "CLOUD_SERVICES_ONLY"
WAREHOUSE_METERING = "WAREHOUSE_METERING"
SEARCH_OPTIMIZATION = "SEARCH_OPTIMIZATION"
AUTO_CLUSTERING = "AUTO_CLUSTERING"
MATERIALIZED_VIEW = "MATERIALIZED_VIEW"
COMPUTE_LABEL = "COMPUTE"
CLOUD_SERVICES_LABEL = "CLOUD SERVICES"
STORAGE_LABEL = "STORAGE"
SEARCH_NAME_TABLE_ID = (33, 10)  # position and length of the table id in a name
UNKNOWN_OWNER = "Other"

# Credits are divided by this per warehouse size.
WAREHOUSE_SIZES = {
    "XSMALL": 0.25,
    "SMALL": 0.5,
    "MEDIUM": 1.0,
    "LARGE": 2.0,
    "XLARGE": 4.0,
    "2XLARGE": 8.0,
    "3XLARGE": 16.0,
    "4XLARGE": 32.0,
}

# Storage.
ACTIVE_SIZE_TITLE = "Average Active Size in TB"
FAILSAFE_SIZE_TITLE = "Average Failsafe Size in TB"

# Governance.
COMMENT_STATEMENT = "ALTER TABLE %s.%s.%s ALTER COLUMN %s comment '%s'"
RETENTION_TARGET_DAYS = 3
RETENTION_CHANGED = "Time Travel Duration Changed"
RETENTION_CHANGED_AUDIT = "Time Travel Duration Changed to 3 Days"
RETENTION_FAILED = "Failed to Change Time Travel Duration"
MASK = "**Masked**"
MASKED_TAG = "security_class"
MASKED_TAG_VALUE = "PII"

# Text extraction.
TABLE_KEYWORDS = ("INSERT INTO", "COPY INTO", "FROM", "JOIN")
MERGE_PHRASE = "MERGE INTO"
MERGE_TARGET_LIMIT = 100
MERGE_TARGET_PATTERN = r'(?i)MERGE\s+INTO\s+("[^"]+"|[A-Z0-9_\.]+)'
LEADING_IDENTIFIER_PATTERN = r'(?i)^("[^"]+"(\."[^"]+"){0,2}|[A-Z0-9_]+(\.[A-Z0-9_]+){0,2})'
IDENTIFIER_ARGUMENT_PATTERN = r"IDENTIFIER\('([^']+)'\)"
IDENTIFIER_CALL_PATTERN = r"IDENTIFIER\('.+?'\)"
BOOLEAN_WORDS = {
    "true": ("true", "t", "yes", "y", "on", "1"),
    "false": ("false", "f", "no", "n", "off", "0"),
}

# Mail text of the failed-task digest.
DIGEST_NONE = "<p>No task failures found in the past hour.</p>"
DIGEST_INTRO = "<p>The following tasks have failed in the past hour:</p>"
DIGEST_TABLE = (
    '<table border="1" cellpadding="5" cellspacing="0" style="border-collapse: collapse;">'
)
DIGEST_HEADINGS = ("Task Name", "Database", "Schema", "Error", "Start Time")
DIGEST_ERROR_LENGTH = 100

# Paged service results.
PAGE_SIZE = 1000
