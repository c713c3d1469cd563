"""Data-quality checks (unique, not_null, declared lengths) as Spark jobs.

Each check yields rows ``(table_name, column_name, check_name, failures)``;
``failures`` counts offending key values (unique) or rows (not_null, length), and is null where
the table is absent, which fails the check. The counts of a table come from one aggregate,
duplicate keys from one more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.schemas import RAW_VARCHAR_LIMITS

# The declared column tests, per table.
UNIQUE_CHECKS = {
    "raw_earthquakes": ["event_id"],
    "stg_earthquakes": ["event_id"],
    "fct_earthquakes": ["event_id"],
    "agg_daily_summary": ["summary_date"],
    "agg_regional_risk": ["region"],
}
NOT_NULL_CHECKS = {
    "raw_earthquakes": ["event_id"],
    "stg_earthquakes": ["event_id", "magnitude", "latitude", "longitude", "event_timestamp"],
    "fct_earthquakes": ["event_id", "magnitude", "event_date", "latitude", "longitude"],
    "agg_daily_summary": ["summary_date"],
    "agg_regional_risk": ["region"],
}
LENGTH_CHECKS = {"raw_earthquakes": RAW_VARCHAR_LIMITS}

#: Columns that every staging row has.
REQUIRED_FIELDS = ("event_id", "magnitude", "latitude", "longitude")

REPORT_SCHEMA = "table_name string, column_name string, check_name string, failures bigint"

Checks = Mapping[tuple[str, str], Column]  # (column, check) -> count of failures


def _absent(spark: SparkSession, table: str, checks: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(table, c, k, None) for c, k in checks], REPORT_SCHEMA)


def counted(df: DataFrame, table: str, checks: Checks) -> DataFrame:
    """All counts of one table in a single scan."""
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(k).alias("check_name"), n.cast("bigint").alias("failures"))
            for (c, k), n in checks.items()]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def unique_failures(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null values of ``column`` that occur more than once."""
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
    return counted(dup, table, {(column, "unique"): F.count(F.lit(1))})


def _nulls(columns: Sequence[str]) -> Checks:
    return {(c, "not_null"): F.count_if(F.col(c).isNull()) for c in columns}


def _lengths(limits: Mapping[str, int]) -> Checks:
    return {(c, "max_length"): F.count_if(F.length(c) > n) for c, n in limits.items()}


def not_null_failures(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return counted(df, table, _nulls(columns))


def length_failures(raw: DataFrame, limits: Mapping[str, int] = RAW_VARCHAR_LIMITS,
                    table: str = "raw_earthquakes") -> DataFrame:
    """Rows whose text is longer than the declared VARCHAR(n), per column."""
    return counted(raw, table, _lengths(limits))


def dq_unique(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    return _union([unique_failures(tables[t], t, c) if t in tables else _absent(spark, t, [(c, "unique")])
                   for t, cols in UNIQUE_CHECKS.items() for c in cols])


def dq_counts(tables: Mapping[str, DataFrame], spark: SparkSession, lengths: bool = True) -> DataFrame:
    """not_null and, if asked for, declared lengths: one aggregate per table."""
    parts = []
    for t, cols in NOT_NULL_CHECKS.items():
        checks = {**_nulls(cols), **(_lengths(LENGTH_CHECKS.get(t, {})) if lengths else {})}
        parts.append(counted(tables[t], t, checks) if t in tables else _absent(spark, t, list(checks)))
    return _union(parts)


def dq_report(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """All declared tests plus the raw length check, with a pass/fail status."""
    report = dq_unique(tables, spark).unionByName(dq_counts(tables, spark))
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def write_checks(table: str) -> dict[str, Column]:
    """The not_null and length checks of a table, and those of staging that depend on raw rows, for a write
    to count on its rows: column__check -> whether a row fails (null: no)."""
    out = {f"{c}__not_null": F.col(c).isNull() for c in NOT_NULL_CHECKS[table]}
    out |= {f"{c}__max_length": F.length(c) > n for c, n in LENGTH_CHECKS.get(table, {}).items()}
    if table == "raw_earthquakes":  # staging leaves out rows without these; of the others it needs the time
        there = F.lit(True)
        for c in REQUIRED_FIELDS:
            there = there & F.col(c).isNotNull()
        out["stg_event_timestamp__not_null"] = there & F.col("event_time").isNull()
    return out


def dq_report_of_writes(tables: Mapping[str, DataFrame], spark: SparkSession, failures: Callable[[str, str], int | None]) -> DataFrame:
    """``dq_report`` from what the writes counted: of raw and fact only keys are read, unless a count needs more.

    ``failures(table, column__check)`` gives the count of a table's writes, None where they can't tell.
    """
    told, parts, raw_twice = [], [], None
    for t, cols in NOT_NULL_CHECKS.items():
        checks = {**_nulls(cols), **_lengths(LENGTH_CHECKS.get(t, {}))}
        if t not in tables:
            parts.append(_absent(spark, t, list(checks)))
            continue
        rest = {}
        for (c, k), n in checks.items():
            if t != "stg_earthquakes":
                known = failures(t, f"{c}__{k}")
            elif c in REQUIRED_FIELDS:
                known = 0  # by the definition of staging
            else:
                known = failures("raw_earthquakes", f"stg_{c}__{k}")
            if known is None:
                rest[c, k] = n
            else:
                told.append((t, c, k, known))
        if rest:
            parts.append(counted(tables[t], t, rest))
    for t, cols in UNIQUE_CHECKS.items():
        for c in cols:
            if t not in tables:
                parts.append(_absent(spark, t, [(c, "unique")]))
            elif t == "raw_earthquakes" and "stg_earthquakes" in tables:  # counted once, for both
                raw_twice = unique_failures(tables[t].select(c), t, c).first().failures
                told.append((t, c, "unique", raw_twice))
            elif t != "stg_earthquakes" or raw_twice is None:
                parts.append(unique_failures(tables[t].select(c), t, c))
            else:  # staging has the raw table's keys, or fewer
                twice = tables["raw_earthquakes"].where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1")
                again = tables[t].join(twice.select(c), c, "left_semi") if raw_twice else tables[t].limit(0)
                parts.append(unique_failures(again, t, c))
    if told:
        rows = [F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(k).alias("check_name"), F.lit(n).cast("bigint").alias("failures"))
                for t, c, k, n in told]
        parts.append(spark.range(1).select(F.inline(F.array(*rows))))
    return _union(parts).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
