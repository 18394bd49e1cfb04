"""Rule truth table, hash equality, rule order and the config check."""

import pytest

from stocktake.operators import rules as R

SCHEMA = "bucket_in_pro string, prefix_in_pro string, file_name_in_all_accounts string, size_in_pro long, hash_in_pro string, size_in_release long, hash_in_release string"

# A side of a case: size and hash. The truth table of `rules.py`, every side against every side.
SIDES = {"absent": (None, None), "seen": (7, "9e10"), "changed": (8, "77ab"), "unhashed": (7, None)}


def expected(origin, target):
    """(hash rule, can-exist rule)"""
    there = origin != "absent", target != "absent"
    same = origin == target and origin in ("seen", "changed")
    return (same if there[0] else False if there[1] else None), (False if there == (False, True) else None)


@pytest.mark.parametrize("origin", SIDES)
@pytest.mark.parametrize("target", SIDES)
def test_truth_table(spark, origin, target):
    df = spark.createDataFrame([("store", "2023/q4/", "invoices.json", *SIDES[origin], *SIDES[target])], SCHEMA)
    cfg = R.RuleConfig(origin="pro", is_hash_the_same_in=["release"], can_the_file_exist_in=["release"])
    row = R.analyse(df, cfg, ["pro", "release"]).collect()[0]
    assert (row["is_hash_the_same_in_release"], row["can_exist_in_release"]) == expected(origin, target)


def test_rule_columns_order_and_empty_lists(spark):
    df = spark.createDataFrame([("b", "p/", "f", 1, "h", 1, "h")], SCHEMA)
    cfg = R.RuleConfig(origin="pro", is_hash_the_same_in=["release"], can_the_file_exist_in=["release"])
    cols = R.analyse(df, cfg, ["pro", "release"]).columns
    assert cols[-2:] == ["is_hash_the_same_in_release", "can_exist_in_release"]
    none = R.RuleConfig(origin="pro")
    assert R.analyse(df, none, ["pro", "release"]).columns == df.columns


def test_run_analysis_off_returns_table(spark):
    df = spark.createDataFrame([("b", "p/", "f", 1, "h", 1, "h")], SCHEMA)
    cfg = R.RuleConfig(origin="nope", is_hash_the_same_in=["x"], run_analysis=False)
    assert R.analyse(df, cfg, ["pro", "release"]).columns == df.columns


def message_of(config, accounts):
    with pytest.raises(R.AnalysisConfigError) as e:
        R.assert_config_matches(config, accounts)
    return str(e.value)


KNOWN = ["live", "mirror", "sandbox", "archive"]
ONE = "The AWS account '{}' is defined in analysis-config.json but not in s3-uris-to-analyze.csv"
TWO = "The AWS accounts '{}', '{}' are defined in analysis-config.json but not in s3-uris-to-analyze.csv"


def test_unknown_origin_message():
    assert message_of(R.RuleConfig(origin="main"), KNOWN) == ONE.format("main")


def test_unknown_targets_messages():
    assert message_of(R.RuleConfig(origin="live", is_hash_the_same_in=["backup"]), KNOWN) == ONE.format("backup")
    both = R.RuleConfig(origin="live", is_hash_the_same_in=["vault", "archive"], can_the_file_exist_in=["backup", "vault"])
    assert message_of(both, KNOWN) == TWO.format("backup", "vault")


def test_unknown_accounts_report_dataframe(spark):
    from stocktake.schemas import RULE_CONFIG

    cfg = spark.createDataFrame([(True, "live", ["vault"], ["backup", "archive"])], RULE_CONFIG)
    accounts = spark.createDataFrame([(a,) for a in KNOWN], "account string")
    rows = R.unknown_accounts_report(cfg, accounts).collect()
    assert [(r["check"], r["n_accounts"], r["message"]) for r in rows] == [("targets", 2, TWO.format("backup", "vault"))]


def test_rule_config_reader(spark, tmp_root):
    from stocktake.sources.readers import read_rule_config

    path = f"{tmp_root}/analysis-config.json"
    with open(path, "w") as f:
        f.write('{\n  "run_analysis": true,\n  "origin": "pro",\n  "can_the_file_exist_in": ["release"],\n  "is_hash_the_same_in": ["release", "dev"]\n}\n')
    cfg = read_rule_config(spark, path)
    assert cfg == R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])
