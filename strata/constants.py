"""Business constants of the data contract.

Fixed values: these must stay equal to the source system's contract, otherwise
tiers, change hashes and therefore SCD2 history differ.
"""

# Fixed values -- revenue tier lower bounds (inclusive), highest first.
PLATINUM_MIN: int = 100_000
GOLD_MIN: int = 50_000
SILVER_MIN: int = 10_000
# Fixed values -- tier labels, highest first; the last one is the fallback.
TIER_LABELS: tuple[str, ...] = ("Platinum", "Gold", "Silver", "Bronze")

# Fixed values -- attributes whose change opens a new SCD2 version.
TRACKED_COLUMNS: tuple[str, ...] = (
    "first_name",
    "last_name",
    "email",
    "country",
    "city",
    "customer_segment",
    "revenue_ytd",
    "is_active",
)

# Fixed values -- version of the change-hash layout, stored with every SCD2 row.
HASH_VERSION: int = 1

# Fixed values -- text layout of row / change hashes: every value is cast to
# string, a null becomes NULL_TOKEN, values are joined with HASH_SEPARATOR and
# the result is hashed with SHA-256 (hex).
NULL_TOKEN: str = "__NULL__"
HASH_SEPARATOR: str = "||"

# Natural key and ordering column of the customer source.
CUSTOMER_KEY: str = "customer_id"
CUSTOMER_ORDER: str = "updated_at"

# Columns the SCD2 dimension adds to its source columns.
EFFECTIVE_FROM: str = "effective_from"
EFFECTIVE_TO: str = "effective_to"
IS_CURRENT: str = "is_current"
HASH_VERSION_COL: str = "hash_version"

# names used by code written against the user / customer flow contract
PLATINUM_THRESHOLD = PLATINUM_MIN
GOLD_THRESHOLD = GOLD_MIN
SILVER_THRESHOLD = SILVER_MIN
SCD2_TRACKED_COLUMNS = TRACKED_COLUMNS
