"""Data-quality checks. Each yields rows (layer, table, check, status, value, details)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed_values as fixed
from ..functions.dates import key_to_date
from .joins import orphan_count

RESULT_COLUMNS = ["layer", "table", "check", "status", "value", "details"]
RESULT_DDL = ", ".join(f"`{c}` string" for c in RESULT_COLUMNS)


class QualityGateError(RuntimeError):
    """At least one check failed."""


@dataclass(frozen=True)
class Rule:
    """A condition every row must meet; a NULL outcome breaks it."""

    name: str
    condition: str


def key_profile(df: DataFrame, key: str, ingested: str | None = None) -> DataFrame:
    """Rows, NULL keys, repeated key values, key bounds, distinct keys, latest load: one job."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        (F.max(ingested) if ingested else F.lit(None).cast("timestamp")).alias("ts"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.min(key).alias("min_key"), F.max(key).alias("max_key"),
        F.count(key).alias("distinct_keys"), F.max("ts").alias("latest_ingest_ts"),
    )


def validate_silver(table: str | DataFrame, key_col: str, spark: SparkSession | None = None) -> DataFrame:
    """Row count, key range, distinct keys and latest load of a silver table, as one row."""
    if isinstance(table, DataFrame):
        df = table
    else:
        df = (spark or SparkSession.active()).table(table)
    ingested = "ingestion_timestamp_utc" if "ingestion_timestamp_utc" in df.columns else None
    return key_profile(df, key_col, ingested)


def key_checks(df: DataFrame, key: str, layer: str, table: str) -> DataFrame:
    """row_count, null_pk and duplicate_pk of one table."""
    return profile_checks(key_profile(df, key), key, layer, table)


def profile_checks(p: DataFrame, key: str, layer: str, table: str) -> DataFrame:
    """`key_checks` from a key profile."""
    empty = F.col("row_count") == 0
    checks = F.array(
        _result(layer, table, "row_count", empty, F.col("row_count"), F.lit("table is empty")),
        _result(layer, table, "null_pk", F.col("null_keys") > 0, F.col("null_keys"),
                F.concat(F.col("null_keys"), F.lit(f" null {key} values"))),
        _result(layer, table, "duplicate_pk", F.col("repeated_keys") > 0, F.col("repeated_keys"),
                F.concat(F.col("repeated_keys"), F.lit(f" duplicate {key} values"))),
    )
    return _rows(p, checks)


def count_match(left: DataFrame, right: DataFrame, table: str, left_name: str = "silver",
                right_name: str = "gold", layer: str = "sync") -> DataFrame:
    """Whether two tables have the same number of rows."""
    both = left.agg(F.count(F.lit(1)).alias("a")).withColumn("b", right.agg(F.count(F.lit(1))).scalar())
    differ = F.col("a") != F.col("b")
    value = F.when(differ, F.concat(F.lit(f"{left_name}="), F.col("a"), F.lit(f" {right_name}="), F.col("b"))
                   ).otherwise(F.concat(F.col("a"), F.lit("="), F.col("b")))
    return _rows(both, F.array(_result(layer, table, "row_count_match", differ, value,
                                       F.concat(F.lit("delta="), F.abs(F.col("a") - F.col("b"))))))


def foreign_key_check(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, nullable: bool,
                      fact_name: str, dim_name: str, layer: str = "integrity") -> DataFrame:
    return _orphan_result(orphan_count(fact, fact_col, dim, dim_col, nullable), fact_col, nullable, fact_name, dim_name, layer)


def _orphan_result(n: DataFrame, fact_col: str, nullable: bool, fact_name: str, dim_name: str, layer: str) -> DataFrame:
    which = "non-null FK" if nullable else "FK"
    return _rows(n, F.array(_result(
        layer, fact_name, f"{fact_col}→{dim_name}", F.col("orphan_count") > 0, F.col("orphan_count"),
        F.concat(F.col("orphan_count"), F.lit(f" {which} values with no matching dim row")))))


def fact_key_counts(fact: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, fk, n): the distinct values of all foreign keys of a fact and how often they occur, in one pass.

    Values are counted before the shuffle, so a hot or NULL key costs one row per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("fk")) for c in columns])
    return fact.select(F.explode(pairs).alias("p")).groupBy("p.column_name", "p.fk").agg(F.count(F.lit(1)).alias("n"))


def counted_key_check(counts: DataFrame, column: str, dim: DataFrame, dim_col: str, nullable: bool, fact_name: str,
                      dim_name: str) -> DataFrame:
    """`foreign_key_check` from the counts of `fact_key_counts`."""
    own = counts.filter(F.col("column_name") == column)
    if nullable:
        own = own.filter("fk IS NOT NULL")
    pk = dim.select(F.col(dim_col).cast("bigint").alias("pk"))
    n = own.join(pk, F.col("fk") == F.col("pk"), "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count"))
    return _orphan_result(n, column, nullable, fact_name, dim_name, "integrity")


def orphan_messages(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, dim_name: str) -> list[str]:
    """Messages for one pair of tables; NULL keys are ignored."""
    n = orphan_count(fact, fact_col, dim, dim_col, nullable=True).first()[0]
    return [f"{n} orphan {fact_col} values not in {dim_name}"] if n else []


def freshness_check(df: DataFrame, table: str, as_of: Column, date_key: str = "date_key",
                    layer: str = "freshness") -> DataFrame:
    """Days between the newest day key and `as_of`: PASS, WARN or FAIL; no rows is FAIL."""
    newest = df.agg(key_to_date(F.max(date_key)).alias("d")).withColumn("behind", F.datediff(as_of.cast("date"), "d"))
    status = (
        F.when(F.col("d").isNull(), "FAIL")
        .when(F.col("behind") <= fixed.FRESH_PASS_DAYS, "PASS")
        .when(F.col("behind") <= fixed.FRESH_WARN_DAYS, "WARN").otherwise("FAIL")
    )
    details = (
        F.when(F.col("d").isNull(), "no rows")
        .when(F.col("behind") <= fixed.FRESH_PASS_DAYS, "")
        .otherwise(F.concat(F.col("behind"), F.lit(" days behind today")))
    )
    return newest.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit("max_date").alias("check"),
        status.alias("status"), F.coalesce(F.col("d").cast("string"), F.lit("")).alias("value"),
        details.alias("details"))


def rule_checks(df: DataFrame, rules: Iterable[Rule], table: str, layer: str = "rules") -> DataFrame:
    """Rows breaking each rule, all rules in one pass."""
    rules = list(rules)
    broken = df.agg(*[
        F.count_if(~F.coalesce(F.expr(r.condition), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)])
    return _rows(broken, F.array(*[
        _result(layer, table, r.name, F.col(f"r{i}") > 0, F.col(f"r{i}"),
                F.concat(F.col(f"r{i}"), F.lit(" rows break: "), F.lit(r.condition)))
        for i, r in enumerate(rules)]))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_count, null_rate) of every column, in one pass."""
    total = F.count(F.lit(1))
    agg = df.agg(total.alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return agg.select("n", F.explode(pairs).alias("p")).select(
        "p.column_name", "p.null_count",
        F.coalesce(F.try_divide(F.col("p.null_count").cast("double"), F.col("n").cast("double")),
                   F.lit(0.0)).alias("null_rate"))


def volume_bands(df: DataFrame, day: str, trailing: int = 28, sigmas: float = 3.0) -> DataFrame:
    """Rows per day against mean ± sigmas·stddev of the preceding days.

    The window runs over one row per day, so the calendar bounds it.
    """
    daily = df.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("day").rowsBetween(-trailing, -1)
    mean, dev = F.avg("n").over(w), F.stddev_samp("n").over(w)
    return daily.select(
        "day", "n", mean.alias("expected"), dev.alias("deviation"),
    ).withColumn("status", F.when(F.col("deviation").isNull(), "PASS")
                 .when(F.abs(F.col("n") - F.col("expected")) <= sigmas * F.col("deviation"), "PASS")
                 .otherwise("FAIL"))


def schema_differences(actual: StructType, declared: StructType) -> list[tuple[str, str]]:
    """(column, problem) for missing, extra and differently typed columns; metadata only."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in declared.fields}
    out = [(c, "missing") for c in want if c not in have]
    out += [(c, "extra") for c in have if c not in want]
    out += [(c, f"{have[c].simpleString()} instead of {want[c].simpleString()}")
            for c in want if c in have and have[c] != want[c]]
    return out


def bronze_checks(df: DataFrame, declared: StructType, table: str, min_rows: int, max_rows: int,
                  max_null_rate: dict[str, float]) -> DataFrame:
    """Schema, row-count bounds and null rates of a raw entity before it is loaded."""
    problems = schema_differences(df.schema, declared)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in max_null_rate])
    text = "; ".join(f"{c}: {p}" for c, p in problems)
    checks = [
        _result("bronze", table, "schema", F.lit(bool(problems)), F.lit(len(problems)), F.lit(text)),
        _result("bronze", table, "row_count", ~F.col("n").between(min_rows, max_rows), F.col("n"),
                F.lit(f"expected {min_rows} to {max_rows} rows")),
    ]
    for c, limit in max_null_rate.items():
        rate = F.coalesce(F.col(f"null_{c}"), F.lit(0.0))
        checks.append(_result("bronze", table, f"null_rate:{c}", rate > limit, rate, F.lit(f"limit {limit}")))
    return _rows(agg, F.array(*checks))


def history_checks(versions: DataFrame, natural: str, table: str, surrogate: str,
                   effective: str = "effective_date", expiry: str = "expiry_date", layer: str = "history") -> DataFrame:
    """One current row per key, open end iff current, ascending and non-overlapping ranges.

    Versions are folded to one row per key and start day first, so the calendar bounds a key.
    """
    per_day = versions.groupBy(natural, effective).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_current").alias("current_rows"),
        F.count_if(F.col("is_current") != F.col(expiry).isNull()).alias("open_mismatch"),
        F.max(expiry).alias("ends"), F.min(surrogate).alias("low"), F.max(surrogate).alias("high"))
    w = Window.partitionBy(natural).orderBy(effective)
    chained = per_day.withColumns({
        "next_start": F.lead(effective).over(w), "previous_high": F.lag("high").over(w)})
    per_key = chained.groupBy(natural).agg(
        F.sum("current_rows").alias("current_rows"),
        F.sum("open_mismatch").alias("open_mismatch"),
        F.sum(F.col("n") - 1 + F.coalesce(F.col("next_start") <= F.col("ends"), F.lit(False)).cast("bigint")
              ).alias("overlaps"),
        F.count_if(F.col("previous_high") > F.col("low")).alias("disorder"))
    total = per_key.agg(
        F.count_if(F.col("current_rows") != 1).alias("current_rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("open_mismatch", "overlaps", "disorder")])
    names = {
        "current_rows": "keys without exactly one current row",
        "open_mismatch": "rows open but not current, or current but closed",
        "overlaps": "rows overlapping the next version",
        "disorder": "rows out of version order",
    }
    return _rows(total, F.array(*[
        _result(layer, table, c, F.col(c) > 0, F.col(c), F.concat(F.col(c), F.lit(f" {text}")))
        for c, text in names.items()]))


def pattern_check(measured: DataFrame, value: str, low: float | None, high: float | None, table: str,
                  name: str, layer: str = "pattern") -> DataFrame:
    """Whether a measured effect lies in its expected band; no data cannot be judged and warns."""
    v = F.col(value).cast("double")
    ok = F.lit(True)
    if low is not None:
        ok = ok & (v >= low)
    if high is not None:
        ok = ok & (v <= high)
    status = F.when(v.isNull(), "WARN").when(ok, "PASS").otherwise("FAIL")
    return measured.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit(name).alias("check"),
        status.alias("status"), F.coalesce(v.cast("string"), F.lit("")).alias("value"),
        F.when(status == "PASS", "").otherwise(f"expected {low} to {high}").alias("details"))


def date_dimension_messages(dim: DataFrame) -> list[str]:
    """Problems of a calendar: repeated day keys, days without a fiscal year."""
    row = dim.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fiscal_year").isNull()).alias("holes"),
    ).agg(F.count_if(F.col("n") > 1), F.coalesce(F.sum("holes"), F.lit(0))).first()
    out = []
    if row[0]:
        out.append(f"{row[0]} duplicate date_key values")
    if row[1]:
        out.append(f"{row[1]} rows with null fiscal_year")
    return out


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def health_over_time(log: DataFrame) -> DataFrame:
    """Checks per run and status, from the result log."""
    return log.groupBy("run_id").agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL")],
        F.count(F.lit(1)).alias("checks"))


def ordered(results: DataFrame) -> DataFrame:
    return results.orderBy("status", "layer", "table", "check")


def gate(results: DataFrame, fail_on_errors: bool = True) -> int:
    """Number of failed checks; raises if there are any and `fail_on_errors` is set."""
    failed = results.filter("status = 'FAIL'").count()
    if failed and fail_on_errors:
        raise QualityGateError(f"DQ checkpoint failed: {failed} check(s) failed.")
    return failed


def _result(layer: str, table: str, check: str, failed: Column, value: Column, details: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit(check).alias("check"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        value.cast("string").alias("value"),
        F.when(failed, details.cast("string")).otherwise("").alias("details"))


def _rows(df: DataFrame, checks: Column) -> DataFrame:
    return df.select(F.explode(checks).alias("c")).select("c.*")
