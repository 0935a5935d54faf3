"""Data-quality rules compiled to aggregates (DQ-1..8, DQ-10..13).

All rules of one table are evaluated in ONE scan and one shuffle: a row gives one
text of marks for its row-level rules and one (rule, value) row for each
uniqueness and foreign-key rule, and referenced keys are rows of the same kind.
Equal ones are counted before they are shuffled, so a hot value is one row a task.
Results come back as a DataFrame of one row per rule: nothing but those rows ever
reaches the driver."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType()), T.StructField("expectation_type", T.StringType()),
    T.StructField("column_name", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("success", T.BooleanType()), T.StructField("element_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()), T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("observed_value", T.StringType()), T.StructField("raw_result", T.StringType()),
])

KNOWN = ("expect_table_row_count_to_be_between", "expect_column_values_to_not_be_null",
         "expect_column_values_to_be_unique", "expect_column_values_to_be_in_set",
         "expect_column_values_to_match_regex", "expect_expression_true",
         "expect_foreign_key")


@dataclass(frozen=True)
class Rule:
    id: str
    expectation: str
    kwargs: dict = field(default_factory=dict)
    severity: str = "warning"
    enabled: bool = True

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


# DQ-1 .. DQ-5, DQ-12, DQ-13 constructors
def expect_row_count(rule_id, min_value=None, max_value=None, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[0], {"min_value": min_value, "max_value": max_value}, severity)


def expect_not_null(rule_id, column, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[1], {"column": column}, severity)


def expect_unique(rule_id, column, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[2], {"column": column}, severity)


def expect_in_set(rule_id, column, values, mostly=1.0, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[3], {"column": column, "value_set": list(values), "mostly": mostly}, severity)


def expect_regex(rule_id, column, regex, mostly=1.0, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[4], {"column": column, "regex": regex, "mostly": mostly}, severity)


def expect_expr(rule_id, expression, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[5], {"expression": expression}, severity)


def expect_fk(rule_id, column, dim: DataFrame, dim_key: str, severity="warning") -> Rule:
    return Rule(rule_id, KNOWN[6], {"column": column, "dim": dim, "dim_key": dim_key}, severity)


def _pct(bad: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(bad.cast("double") * 100.0 / n.cast("double"), 4))


def _mostly_ok(bad: Column, nonnull: Column, mostly: float) -> Column:
    # pass when (1 - bad / nonnull) >= mostly, compared exactly in decimals
    return F.when(nonnull == 0, F.lit(True)).otherwise(
        (nonnull - bad).cast("decimal(30,6)") >= (nonnull.cast("decimal(20,0)") * F.lit(mostly).cast("decimal(10,6)")))


def _result(rule: Rule, success: Column, n: Column, bad: Column | None, observed: Column,
            raw: Column | None = None) -> Column:
    bad = bad if bad is not None else F.lit(None).cast("long")
    return F.struct(
        F.lit(rule.id).alias("rule_id"), F.lit(rule.expectation).alias("expectation_type"),
        F.lit(rule.column).cast("string").alias("column_name"), F.lit(rule.severity).alias("severity"),
        success.alias("success"), n.cast("long").alias("element_count"), bad.cast("long").alias("unexpected_count"),
        (_pct(bad, n) if rule.expectation != KNOWN[0] else F.lit(None).cast("double")).alias("unexpected_percent"),
        observed.cast("string").alias("observed_value"),
        (raw if raw is not None else F.lit(None).cast("string")).alias("raw_result"))


def _error_row(rule: Rule, message: str) -> Column:
    return F.struct(
        F.lit(rule.id).alias("rule_id"), F.lit(rule.expectation).alias("expectation_type"),
        F.lit(rule.column).cast("string").alias("column_name"), F.lit(rule.severity).alias("severity"),
        F.lit(False).alias("success"), F.lit(None).cast("long").alias("element_count"),
        F.lit(None).cast("long").alias("unexpected_count"), F.lit(None).cast("double").alias("unexpected_percent"),
        F.lit(None).cast("string").alias("observed_value"),
        F.lit(json.dumps({"exception": message})).alias("raw_result"))


def _problem(df: DataFrame, rule: Rule) -> str | None:
    """Why a regex or expression cannot be evaluated at all, or None."""
    k = rule.kwargs
    try:
        if rule.expectation == KNOWN[4]:
            df.sparkSession.range(1).select(F.regexp_like(F.lit(""), F.lit(k["regex"]))).collect()
        elif rule.expectation == KNOWN[5]:
            kind = df.select(F.expr(k["expression"]).alias("x")).schema["x"].dataType.simpleString()
            return None if kind == "boolean" else f"expression is {kind}, not boolean"
    except Exception as e:  # noqa: BLE001 - whatever is wrong with the rule goes to its result row
        return str(e).split("\n")[0][:500]
    return None


def _as_text(c: Column, dtype: T.DataType) -> Column:
    """Text that is equal for two values of a type just when a grouping holds them equal."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))      # 0.0 and -0.0 are one value
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("string")                              # an hour can occur twice a day
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        raise TypeError(f"a column of type {dtype.simpleString()} cannot be compared")
    return c.cast("string")


def _common_type(spark, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which Spark compares values of two types."""
    both = F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b))
    return a if a == b else spark.range(0).select(both.alias("v")).schema["v"].dataType


def _keys(df: DataFrame, r: Rule) -> tuple[Column, DataFrame | None]:
    """A key rule's value as text, and the keys that it refers to (column ``value``)."""
    c, own = F.col(f"`{r.column}`"), df.schema[r.column].dataType
    if r.expectation == KNOWN[2]:
        return _as_text(c, own), None
    dim = r.kwargs["dim"].select(F.col(f"`{r.kwargs['dim_key']}`").alias("k"))
    wide = _common_type(df.sparkSession, own, dim.schema["k"].dataType)
    return _as_text(c.try_cast(wide), wide), dim.select(_as_text(F.col("k").try_cast(wide), wide).alias("value"))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """DQ-6: evaluate enabled rules; an unknown rule or column, or one that cannot
    be compared, becomes a failed result row instead of an exception.  Nulls are
    neither duplicates nor orphans; a duplicate counts with all its copies."""
    cols = set(df.columns)
    marks: list[Column] = []                  # true: counted, one place each in a row's text
    values: list[Column] = []                 # (slot, value) of the key rules, from slot 1 on
    dims: list[DataFrame] = []
    results: list[Column] = []
    errors: list[Column] = []
    rows = F.col("slot") == 0

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))

    def marked(flag: Column) -> Column:
        marks.append(F.when(flag, F.lit("1")).otherwise(F.lit("0")))
        return total(rows & (F.substring("value", len(marks), 1) == "1"))

    n = total(rows)
    for r in rules:
        if not r.enabled:
            continue
        if r.expectation not in KNOWN:
            errors.append(_error_row(r, f"unknown expectation {r.expectation}"))
            continue
        if r.column is not None and r.column not in cols:
            errors.append(_error_row(r, f"column {r.column} not found"))
            continue
        c = F.col(f"`{r.column}`") if r.column else None
        k = r.kwargs
        if problem := _problem(df, r):
            errors.append(_error_row(r, problem))
            continue
        if r.expectation == KNOWN[0]:
            ok = F.lit(True)
            if k.get("min_value") is not None:
                ok = ok & (n >= F.lit(k["min_value"]))
            if k.get("max_value") is not None:
                ok = ok & (n <= F.lit(k["max_value"]))
            results.append(_result(r, ok, n, None, n))
        elif r.expectation in (KNOWN[1], KNOWN[5]):
            bad = marked(c.isNull() if r.expectation == KNOWN[1]
                         else ~F.coalesce(F.expr(k["expression"]), F.lit(False)))
            results.append(_result(r, bad == 0, n, bad, bad))
        elif r.expectation in (KNOWN[3], KNOWN[4]):
            fits = (c.isin(k["value_set"]) if r.expectation == KNOWN[3]
                    else F.regexp_like(c.cast("string"), F.lit(k["regex"])))
            nonnull, bad = marked(c.isNotNull()), marked(c.isNotNull() & ~fits)
            results.append(_result(r, _mostly_ok(bad, nonnull, k.get("mostly", 1.0)), n, bad, bad))
        else:
            try:
                value, dim = _keys(df, r)
            except Exception as e:  # noqa: BLE001 - as in _problem
                errors.append(_error_row(r, str(e).split("\n")[0][:500]))
                continue
            slot = len(values) + 1
            values.append(F.struct(F.lit(slot).alias("slot"), value.alias("value")))
            if dim is not None:
                dims.append(dim.where("value is not null").select(
                    F.lit(slot).alias("slot"), "value", F.lit(0).cast("long").alias("n"), F.lit(1).alias("known")))
            wrong = F.col("n") > 1 if dim is None else F.col("known") == 0
            bad = total((F.col("slot") == slot) & wrong)
            results.append(_result(r, bad == 0, n, bad, bad))
    out = None
    if results:
        line = F.concat(*marks) if marks else F.lit("")
        told = df.select(F.inline(F.array(F.struct(F.lit(0).alias("slot"), line.alias("value")), *values)))
        told = told.where("value is not null").select("slot", "value", F.lit(1).cast("long").alias("n"),
                                                      F.lit(0).alias("known"))
        for dim in dims:
            told = told.unionByName(dim)
        counted = told.groupBy("slot", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        out = counted.agg(F.array(*results).alias("r")).select(F.inline("r"))
    if errors:
        er = df.sparkSession.range(1).select(F.inline(F.array(*errors)))
        out = er if out is None else out.unionByName(er)
    if out is None:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return out


def gate(results: DataFrame, fail_on: Sequence[str] = ("critical",), enabled: bool = True,
         load_done: bool = True) -> DataFrame:
    """DQ-7 as a one-row frame: ``skipped`` (load not done), ``disabled``,
    ``failed`` (a failing rule whose severity is in ``fail_on``),
    ``passed_with_warnings`` or ``passed``, with counts and success percent."""
    spark = results.sparkSession
    if not load_done or not enabled:
        status = "skipped" if not load_done else "disabled"
        return spark.range(1).select(F.lit(status).alias("status"), F.lit(0).cast("long").alias("total_rules"),
                                     F.lit(0).cast("long").alias("passed_rules"),
                                     F.lit(0).cast("long").alias("failed_rules"),
                                     F.lit(None).cast("decimal(5,2)").alias("success_percent"))
    sev = [s.lower() for s in fail_on]
    a = results.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count(F.when(F.col("success"), 1)).alias("passed_rules"),
        F.count(F.when(~F.col("success"), 1)).alias("failed_rules"),
        F.count(F.when(~F.col("success") & F.lower("severity").isin(sev), 1)).alias("blocking"))
    status = (F.when(F.col("blocking") > 0, "failed").when(F.col("failed_rules") > 0, "passed_with_warnings")
              .otherwise("passed"))
    pct = F.when(F.col("total_rules") == 0, F.lit(None)).otherwise(
        F.round(F.col("passed_rules").cast("decimal(20,4)") * 100 / F.col("total_rules"), 2)).cast("decimal(5,2)")
    return a.select(status.alias("status"), "total_rules", "passed_rules", "failed_rules", pct.alias("success_percent"))


def enforce(gate_row: DataFrame) -> str:
    """Raise when the gate failed (after results were stored by the caller)."""
    status = gate_row.first()["status"]
    if status == "failed":
        raise RuntimeError("data quality gate failed")
    return status


def config_hash(rules: Sequence[Rule], extra: dict | None = None) -> str:
    """DQ-8: SHA-256 over the sorted JSON of the rule configuration."""
    doc = {"rules": [{"id": r.id, "expectation": r.expectation, "severity": r.severity, "enabled": r.enabled,
                      "kwargs": {k: v for k, v in r.kwargs.items() if k != "dim"}} for r in rules]}
    if extra:
        doc.update(extra)
    return hashlib.sha256(json.dumps(doc, sort_keys=True, default=str).encode()).hexdigest()


def record_run(results: DataFrame, root: str, run_id: str, source_id: str, target_table: str,
               batch_id: str | None, rules: Sequence[Rule]) -> DataFrame:
    """DQ-8: append the per-rule results and the run header to two Parquet tables."""
    results = results.sparkSession.createDataFrame(results.collect(), results.schema)   # one row a rule, evaluated once
    stamped = results.select(F.lit(run_id).alias("validation_run_id"), F.lit(source_id).alias("source_id"), "*")
    stamped.write.mode("append").parquet(f"{root.rstrip('/')}/_dq/results")
    g = gate(results)
    header = g.select(F.lit(run_id).alias("validation_run_id"), F.lit(source_id).alias("source_id"),
                      F.lit(target_table).alias("target_table"), F.lit(batch_id).cast("string").alias("batch_id"),
                      "*", F.lit(config_hash(rules)).alias("config_hash"))
    header.write.mode("append").parquet(f"{root.rstrip('/')}/_dq/runs")
    return header


def current_batch(df: DataFrame, batch_col: str = "_batch_id", loaded_col: str = "_loaded_at") -> DataFrame:
    """DQ-10: the ids (column ``batch_col``) loaded last: the only batch present,
    else the batch(es) at max ``_loaded_at``.  Only a one-row aggregate comes to
    the driver; the ids stay a table."""
    last = df.groupBy(batch_col).agg(F.max(loaded_col).alias("__at")).filter(F.col(batch_col).isNotNull())
    b = last.agg(F.max("__at").alias("at"), F.count(F.lit(1)).alias("n")).first()
    return (last if b["n"] <= 1 else last.filter(F.col("__at") == F.lit(b["at"]))).select(batch_col)
