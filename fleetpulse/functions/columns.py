"""Column expressions of the telemetry layers.

Every function returns a ``Column`` of built-in SQL functions, so that a
whole layer compiles into one code-generated projection; no Python runs per
row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    ANOMALY_FLAG_RULES,
    COMPLIANCE_WEIGHTS,
    ENGINE_STATUS_DEFAULT,
    ENGINE_STATUS_RULES,
    HEALTH_DEFAULT,
    HEALTH_LEVELS,
    PIPELINE_VERSION,
    QUALITY_RULES,
    SEVERITY_DEFAULT,
    SEVERITY_LEVELS,
)

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


# Rules are rendered as SQL text and parsed once by the JVM: one call per
# expression instead of one per node, which keeps plan construction cheap
# (it is paid again for every micro-batch of a stream).

def _q(name: str) -> str:
    return f"`{name}`"


def _num(v: float) -> str:
    return repr(float(v)) if isinstance(v, float) else str(v)


def _rule_sql(column: str, lo: float, hi: float) -> str:
    c = _q(column)
    return f"({c} IS NOT NULL AND {c} BETWEEN {_num(lo)} AND {_num(hi)})"


def _case_sql(branches: list[tuple[str, str]], default: str | None) -> str:
    body = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in branches)
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {body}{tail} END"


def rule_passes(column: str, lo: float, hi: float) -> Column:
    """Not NULL and inside [lo, hi]. Two-valued: NULL and NaN fail."""
    return F.expr(_rule_sql(column, lo, hi))


def active_rules(columns: list[str], rules: dict[str, tuple[float, float]] | None = None
                 ) -> dict[str, tuple[float, float]]:
    """The rules whose column exists; a rule on an absent column is skipped."""
    rules = QUALITY_RULES if rules is None else rules
    present = set(columns)
    return {c: r for c, r in rules.items() if c in present}


def quality_predicate(columns: list[str], rules: dict[str, tuple[float, float]] | None = None) -> Column:
    """Conjunction of all applicable rules; no rule at all passes every row."""
    conds = [_rule_sql(c, lo, hi) for c, (lo, hi) in active_rules(columns, rules).items()]
    return F.expr(" AND ".join(conds)) if conds else F.lit(True)


def failed_rules(columns: list[str], rules: dict[str, tuple[float, float]] | None = None) -> Column:
    """Array of the names of the rules a row breaks, in rule order."""
    items = [f"CASE WHEN NOT {_rule_sql(c, lo, hi)} THEN '{c}' END"
             for c, (lo, hi) in active_rules(columns, rules).items()]
    if not items:
        return F.array().cast("array<string>")
    return F.expr(f"filter(array({', '.join(items)}), x -> x IS NOT NULL)")


# --- enrichment ------------------------------------------------------------

_OFFSET_SUFFIX = "(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def parse_event_time_sql(column: str = "timestamp") -> str:
    s = f"trim({_q(column)})"
    return f"try_to_timestamp(CASE WHEN {s} RLIKE '{_OFFSET_SUFFIX}' THEN {s} ELSE concat({s}, 'Z') END)"


def parse_event_time(column: str = "timestamp") -> Column:
    """ISO-8601 text to an instant. Text without an offset is read as UTC
    whatever the session zone; unparseable text gives NULL, not an error."""
    return F.expr(parse_event_time_sql(column))


def hour_of_day(ts: str = "timestamp") -> Column:
    """Hour 0-23 of the instant in UTC, by integer arithmetic on epoch micros."""
    return F.expr(f"CAST(pmod(unix_micros({_q(ts)}), {MICROS_PER_DAY}) / {MICROS_PER_HOUR} AS INT)")


def day_of_week(ts: str = "timestamp") -> Column:
    """Day of week in UTC, 1 = Sunday .. 7 = Saturday (the Spark convention).
    1970-01-01 was a Thursday (5)."""
    m = f"unix_micros({_q(ts)})"
    days = f"CAST(({m} - pmod({m}, {MICROS_PER_DAY})) / {MICROS_PER_DAY} AS BIGINT)"
    return F.expr(f"CAST(pmod({days} + 4, 7) + 1 AS INT)")


def emissions_severity(nox: str = "nox_ppm") -> Column:
    """CRITICAL / HIGH / MEDIUM on strict NOx thresholds, else NORMAL (NULL too)."""
    return F.expr(_case_sql([(f"{_q(nox)} > {_num(t)}", label) for t, label in SEVERITY_LEVELS],
                            SEVERITY_DEFAULT))


def engine_status() -> Column:
    """First matching rule wins: OVERHEATING, LOW_OIL_PRESSURE, HIGH_RPM, NORMAL."""
    return F.expr(_case_sql([(f"{_q(c)} {op} {_num(t)}", label) for c, op, t, label in ENGINE_STATUS_RULES],
                            ENGINE_STATUS_DEFAULT))


def _flag_items_sql() -> list[str]:
    return [f"CASE WHEN {_q(c)} {op} {_num(t)} THEN '{code}' END" for c, op, t, code in ANOMALY_FLAG_RULES]


def anomaly_flags() -> Column:
    """Comma-joined threshold codes in fixed order; NULL when none applies."""
    return F.expr(f"nullif(concat_ws(',', {', '.join(_flag_items_sql())}), '')")


def anomaly_flag_array() -> Column:
    """The same codes as an array (empty when none applies)."""
    return F.expr(f"filter(array({', '.join(_flag_items_sql())}), x -> x IS NOT NULL)")


# --- metadata stamps -------------------------------------------------------

def ingested_at() -> Column:
    return F.current_timestamp()


def source_file() -> Column:
    """Per-row source file of a file scan (finer than one literal per run)."""
    return F.col("_metadata.file_path")


def pipeline_version(version: str = PIPELINE_VERSION) -> Column:
    return F.lit(version)


# --- gold measures -----------------------------------------------------------
# These follow SQL decimal semantics exactly (literals such as 100.0 are
# decimals), then expose doubles. Division goes through try_divide / NULLIF so
# a group without counted ids gives NULL instead of failing under ANSI mode.

def anomaly_rate_sql(anomalies: str = "total_anomalies", readings: str = "total_readings") -> str:
    return f"CAST(ROUND(try_divide({anomalies} * 100.0, {readings}), 2) AS DOUBLE)"


def compliance_sql(readings: str = "total_readings") -> str:
    """100 minus weighted violation percentages. Not clamped: a group violating
    everything scores below zero."""
    parts = " + ".join(f"({c} * {w} / NULLIF({readings}, 0) * 100)" for c, w in COMPLIANCE_WEIGHTS.items())
    return f"CAST(ROUND(100 - ({parts}), 1) AS DOUBLE)"


def health_sql(rate: str = "anomaly_rate_pct") -> str:
    """Banding of the rounded anomaly rate; a NULL rate is HEALTHY."""
    return _case_sql([(f"{_q(rate)} > {_num(t)}", label) for t, label in HEALTH_LEVELS], HEALTH_DEFAULT)


def anomaly_rate_pct() -> Column:
    return F.expr(anomaly_rate_sql())


def compliance_score() -> Column:
    return F.expr(compliance_sql())


def health_status(rate: str = "anomaly_rate_pct") -> Column:
    return F.expr(health_sql(rate))
