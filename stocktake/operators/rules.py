"""Analysis rules on the flattened all-accounts table.

Three-valued results (true / false / null), one column per rule and target:

| origin file | target file | hashes          | is_hash_the_same_in_<t> | can_exist_in_<t> |
| yes         | yes         | equal           | true                    | null             |
| yes         | yes         | differ or null  | false                   | null             |
| yes         | no          | -               | false                   | null             |
| no          | yes         | -               | false                   | false            |
| no          | no          | -               | null                    | null             |

"Has a file" means the account's ``size`` is not null. Hash equality is null-safe
to *false* (null against anything, null against null included, is not a match).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.functions.uri import hash_kind, quoted
from stocktake.schemas import attr_column

RULE_HASH = "is_hash_the_same_in"
RULE_EXIST = "can_the_file_exist_in"

# Output column prefixes and user-facing error texts of the rule config check.
HASH_COLUMN_PREFIX = "is_hash_the_same_in_"
EXIST_COLUMN_PREFIX = "can_exist_in_"
CONFIG_FILE_NAME = "analysis-config.json"
MAP_FILE_NAME = "s3-uris-to-analyze.csv"
MSG_ONE_UNKNOWN = "The AWS account '{account}' is defined in {config} but not in {map_file}"
MSG_MANY_UNKNOWN = "The AWS accounts '{accounts}' are defined in {config} but not in {map_file}"


class AnalysisConfigError(ValueError):
    pass


class HashKindError(ValueError):
    pass


@dataclass(frozen=True)
class RuleConfig:
    origin: str
    is_hash_the_same_in: list[str] = field(default_factory=list)
    can_the_file_exist_in: list[str] = field(default_factory=list)
    run_analysis: bool = True


def has_file(account: str) -> Column:
    return quoted(attr_column("size", account)).isNotNull()


def same_hash(origin: str, target: str) -> Column:
    eq = quoted(attr_column("hash", origin)) == quoted(attr_column("hash", target))
    return F.coalesce(eq, F.lit(False))


def is_hash_the_same(origin: str, target: str) -> Column:
    return F.when(has_file(origin), same_hash(origin, target)).when(has_file(target), F.lit(False))


def can_exist(origin: str, target: str) -> Column:
    return F.when(~has_file(origin) & has_file(target), F.lit(False))


def rule_columns(config: RuleConfig) -> list[Column]:
    """All hash rules first, then all existence rules, each in configured order."""
    cols = [is_hash_the_same(config.origin, t).alias(HASH_COLUMN_PREFIX + t) for t in config.is_hash_the_same_in]
    cols += [can_exist(config.origin, t).alias(EXIST_COLUMN_PREFIX + t) for t in config.can_the_file_exist_in]
    return cols


def unknown_accounts(config: RuleConfig, accounts: list[str]) -> tuple[bool, list[str]]:
    """(origin unknown?, sorted unknown targets) against the map's accounts (metadata only)."""
    known = set(accounts)
    targets = set(config.is_hash_the_same_in) | set(config.can_the_file_exist_in)
    return config.origin not in known, sorted(targets - known)


def unknown_message(accounts: list[str]) -> str:
    if len(accounts) == 1:
        return MSG_ONE_UNKNOWN.format(account=accounts[0], config=CONFIG_FILE_NAME, map_file=MAP_FILE_NAME)
    return MSG_MANY_UNKNOWN.format(accounts="', '".join(accounts), config=CONFIG_FILE_NAME, map_file=MAP_FILE_NAME)


def assert_config_matches(config: RuleConfig, accounts: list[str]) -> None:
    origin_unknown, targets = unknown_accounts(config, accounts)
    if origin_unknown:
        raise AnalysisConfigError(unknown_message([config.origin]))
    if targets:
        raise AnalysisConfigError(unknown_message(targets))


def analyse(flat: DataFrame, config: RuleConfig, accounts: list[str]) -> DataFrame:
    """Add the rule columns in one projection; with ``run_analysis`` off, return the table as is."""
    if not config.run_analysis:
        return flat
    assert_config_matches(config, accounts)
    return flat.select("*", *rule_columns(config))


def unlike_hashes(flat: DataFrame, config: RuleConfig) -> DataFrame:
    """Per target of a hash rule: objects there whose hash is of another kind than the origin's, so that they can't match.

    ``origin, target, origin_kind, target_kind, n_objects``; one pass over the hashes."""
    mine = quoted(attr_column("hash", config.origin))
    cells = [
        F.struct(F.lit(config.origin).alias("origin"), F.lit(t).alias("target"), hash_kind(mine).alias("origin_kind"), hash_kind(quoted(attr_column("hash", t))).alias("target_kind"))
        for t in config.is_hash_the_same_in
    ]
    if not cells:
        return flat.sparkSession.createDataFrame([], "origin string, target string, origin_kind string, target_kind string, n_objects long")
    pairs = flat.select(F.inline(F.filter(F.array(*cells), lambda c: c.origin_kind != c.target_kind)))
    return pairs.groupBy("origin", "target", "origin_kind", "target_kind").agg(F.count(F.lit(1)).alias("n_objects"))


def assert_like_hashes(report: DataFrame) -> None:
    """Strict mode: raise if hashes of different kinds were compared, with the kinds (a few rows for each target)."""
    found = report.orderBy("target", "origin_kind", "target_kind").collect()
    if found:
        kinds = "; ".join(f"{r.n_objects} objects with {r.origin_kind} in '{r.origin}' and {r.target_kind} in '{r.target}'" for r in found)
        raise HashKindError(f"Hashes of different kinds can't be compared: {kinds}")


# ------------------------------------------------------------- DataFrame form of the config check


def rules_long(config_df: DataFrame) -> DataFrame:
    """Config row(s) -> ``rule, ord, target`` (one row per configured target)."""
    hash_rules = config_df.select(F.lit(RULE_HASH).alias("rule"), F.posexplode(RULE_HASH).alias("ord", "target"))
    exist_rules = config_df.select(F.lit(RULE_EXIST).alias("rule"), F.posexplode(RULE_EXIST).alias("ord", "target"))
    return hash_rules.unionByName(exist_rules)


def unknown_accounts_report(config_df: DataFrame, accounts_df: DataFrame) -> DataFrame:
    """One row per failing check (``origin`` / ``targets``): unknown accounts, sorted, and the message.

    ``accounts_df`` has a column ``account``; both inputs are config-sized.
    """
    known = accounts_df.select("account").distinct()
    origin = config_df.select(F.col("origin").alias("account")).join(known, "account", "left_anti")
    targets = rules_long(config_df).select(F.col("target").alias("account")).distinct().join(known, "account", "left_anti")

    def summarise(df: DataFrame, check: str) -> DataFrame:
        g = df.agg(F.array_sort(F.collect_set("account")).alias("accounts"))
        g = g.where(F.size("accounts") > 0)
        listed = F.array_join("accounts", "', '")
        one = F.format_string(
            MSG_ONE_UNKNOWN.replace("{account}", "%s").format(config=CONFIG_FILE_NAME, map_file=MAP_FILE_NAME), listed
        )
        many = F.format_string(
            MSG_MANY_UNKNOWN.replace("{accounts}", "%s").format(config=CONFIG_FILE_NAME, map_file=MAP_FILE_NAME), listed
        )
        return g.select(
            F.lit(check).alias("check"),
            F.size("accounts").cast("long").alias("n_accounts"),
            F.array_join("accounts", ", ").alias("accounts"),
            F.when(F.size("accounts") == 1, one).otherwise(many).alias("message"),
        )

    return summarise(origin, "origin").unionByName(summarise(targets, "targets"))
