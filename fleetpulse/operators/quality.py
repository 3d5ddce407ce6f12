"""Quality rules: flag, filter, split and count (range rules on metrics)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SIX_METRIC_QUALITY_RULES, QUALITY_RULES
from ..functions.columns import active_rules, failed_rules, quality_predicate, rule_passes

QUALITY_FLAG = "_quality_passed"


def flag_quality(df: DataFrame, rules: dict | None = None, flag: str = QUALITY_FLAG) -> DataFrame:
    """Add a boolean column: the row passes every applicable range rule."""
    return df.withColumn(flag, quality_predicate(df.columns, rules))


def filter_quality(df: DataFrame, rules: dict | None = None, flag: str = QUALITY_FLAG) -> DataFrame:
    """Keep the passing rows (the flag stays, always true, as in the silver layout).
    Catalyst pushes the rule conjunction down to the file scan."""
    flagged = flag_quality(df, rules, flag)
    return flagged.filter(F.col(flag))


def with_failed_rules(df: DataFrame, rules: dict | None = None, column: str = "failed_rules") -> DataFrame:
    """Add the array of broken rule names (empty for a passing row)."""
    return df.withColumn(column, failed_rules(df.columns, rules))


def split_quality(df: DataFrame, rules: dict | None = None, flag: str = QUALITY_FLAG
                  ) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined). Quarantined rows carry the names of the broken
    rules. Both sides come from one predicate, so rows in = passed + failed."""
    flagged = with_failed_rules(flag_quality(df, rules, flag), rules)
    passed = flagged.filter(F.col(flag)).drop("failed_rules")
    failed = flagged.filter(~F.col(flag))
    return passed, failed


def quality_failure_counts(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Rows failing each rule, and rows failing any rule, in one scan.
    Result: (rule, failing_rows); the rule ``_any`` counts failing rows."""
    act = active_rules(df.columns, rules)
    aggs = [F.count_if(~rule_passes(c, lo, hi)).alias(c) for c, (lo, hi) in act.items()]
    aggs.append(F.count_if(~quality_predicate(df.columns, rules)).alias("_any"))
    wide = df.agg(*aggs)
    names = list(act) + ["_any"]
    return wide.unpivot([], names, "rule", "failing_rows")


def chained_range_filters(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Chained form: one ``between`` filter per metric (NULL fails).
    Catalyst merges the chain into a single pushed-down Filter."""
    rules = SIX_METRIC_QUALITY_RULES if rules is None else rules
    return reduce(lambda acc, kv: acc.filter(F.col(kv[0]).between(*kv[1])),
                  [kv for kv in rules.items() if kv[0] in df.columns], df)


def drop_null_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def null_key_rows(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.filter(F.col(key).isNull())


__all__ = [
    "QUALITY_FLAG", "QUALITY_RULES", "flag_quality", "filter_quality", "with_failed_rules",
    "split_quality", "quality_failure_counts", "chained_range_filters", "drop_null_key",
    "null_key_rows",
]
