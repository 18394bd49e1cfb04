"""Fixed schemas and column names of the data model."""

from pyspark.sql import types as T

# Attributes kept per object and per account, in output order.
ATTRS = ("date", "size", "hash")

# Long listing: one row per object (or one placeholder row per empty folder) and account.
LISTING = T.StructType(
    [
        T.StructField("account", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("prefix", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("hash", T.StringType()),
    ]
)

# A listing table on disk also has its run; partition values are declared as text, so that
# account ids such as 012345678901 keep their zeros.
LISTING_WITH_RUN = T.StructType([*LISTING.fields, T.StructField("run_id", T.StringType())])

# Raw entry of an object store listing (what a list call or an inventory report returns).
RAW_ENTRY = T.StructType(
    [
        T.StructField("account", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("etag", T.StringType()),
    ]
)

# Per-account listing as stored in CSV: every column read as text first (size may read "49.0").
LISTING_CSV_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("bucket", "prefix", "name", "date", "size", "hash")])

LISTING_CSV_WITH_RUN = T.StructType(
    [*LISTING_CSV_TEXT.fields, T.StructField("run_id", T.StringType()), T.StructField("account", T.StringType())]
)

RULE_CONFIG = T.StructType(
    [
        T.StructField("run_analysis", T.BooleanType()),
        T.StructField("origin", T.StringType()),
        T.StructField("can_the_file_exist_in", T.ArrayType(T.StringType())),
        T.StructField("is_hash_the_same_in", T.ArrayType(T.StringType())),
    ]
)

OBJECT_STRUCT = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("hash", T.StringType()),
    ]
)

# Output column names of the all-accounts table (fixed values of the output format).
FILE_NAME_COLUMN = "file_name_in_all_accounts"


def key_bucket_column(key_account: str) -> str:
    return f"bucket_in_{key_account}"


def key_prefix_column(key_account: str) -> str:
    return f"prefix_in_{key_account}"


def attr_column(attr: str, account: str) -> str:
    return f"{attr}_in_{account}"


def all_accounts_schema(accounts: list[str]) -> T.StructType:
    """Flattened all-accounts schema; built from the account list, never parsed from names."""
    key = accounts[0]
    fields = [
        T.StructField(key_bucket_column(key), T.StringType()),
        T.StructField(key_prefix_column(key), T.StringType()),
        T.StructField(FILE_NAME_COLUMN, T.StringType()),
    ]
    for account in accounts:
        fields += [
            T.StructField(attr_column("date", account), T.TimestampType()),
            T.StructField(attr_column("size", account), T.LongType()),
            T.StructField(attr_column("hash", account), T.StringType()),
        ]
    return T.StructType(fields)
