"""Configuration tables: known-failure rules (S6) and check specs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = (
    "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, "
    "fix_config struct<key:string,value:string>"
)

# The known-failure rules of the Spark 3.5 -> 4.0 manifest, in list order.
DEFAULT_RULES = [
    {
        "pattern": "ArithmeticException.*(divide by zero|division by zero|DIVIDE_BY_ZERO)",
        "diagnosis": "ANSI SQL mode is enabled by default in Spark 4.0 - division by zero now throws instead of returning NULL",
        "action": "config_fix",
        "auto_fix": True,
        "fix_config": {"key": "spark.sql.ansi.enabled", "value": "false"},
    },
    {
        "pattern": "SparkUpgradeException.*DATETIME_PATTERN_RECOGNITION",
        "diagnosis": "Spark 4.0 changed datetime pattern recognition behavior",
        "action": "config_fix",
        "auto_fix": True,
        "fix_config": {"key": "spark.sql.legacy.timeParserPolicy", "value": "LEGACY"},
    },
    {
        "pattern": "AnalysisException.*cannot resolve.*CAST",
        "diagnosis": "Spark 4.0 ANSI mode rejects implicit unsafe casts",
        "action": "config_fix",
        "auto_fix": True,
        "fix_config": {"key": "spark.sql.ansi.enabled", "value": "false"},
    },
    {
        "pattern": "ClassNotFoundException.*javax.servlet",
        "diagnosis": "Spark 4.0 migrated from javax.servlet to jakarta.servlet",
        "action": "escalate",
        "auto_fix": False,
        "fix_config": None,
    },
]
DEFAULT_MAX_RETRIES = 2


def rules_table(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """The ordered rule list as a table; ``rule_no`` keeps list order (1-based)."""
    rules = DEFAULT_RULES if rules is None else rules
    rows = [
        (i + 1, r["pattern"], r["diagnosis"], r["action"], bool(r.get("auto_fix", False)),
         (r["fix_config"]["key"], r["fix_config"]["value"]) if r.get("fix_config") else None)
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rules_from_json(spark: SparkSession, path: str) -> DataFrame:
    """S6 from files: JSON lines with the rule fields and an explicit ``rule_no``."""
    return spark.read.schema(RULE_SCHEMA).json(path)


def rules_json(rules: list[dict] | None = None) -> str:
    return json.dumps(DEFAULT_RULES if rules is None else rules)


def checks_table(spark: SparkSession, checks_json: str) -> DataFrame:
    """A JSON check list to rows (check_no, name, type, severity, tolerance)."""
    from driftcheck.operators.parity import check_specs

    one = spark.createDataFrame([("_", checks_json)], "pair_id string, checks_json string")
    return check_specs(one, F.col("checks_json")).drop("pair_id")
