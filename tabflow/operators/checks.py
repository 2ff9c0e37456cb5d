"""Declarative data-quality checks.

A check is a name, the columns it looks at, a severity and how to count its
violations. ``run_checks`` evaluates every row-level check of a table in ONE
aggregate pass (plus one grouped pass per ``unique`` check); schema checks
need no job at all. The result is a small DataFrame
``(check, column, severity, violations, passed)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAIL = "fail"
WARN = "warn"

_FLOATING = (T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class Check:
    name: str
    columns: tuple[str, ...]
    severity: str = FAIL
    # aggregate expression counting violating rows (row checks)
    count_expr: Callable[[DataFrame], Column] | None = None
    # violations known from the schema alone (schema checks)
    schema_violations: Callable[[DataFrame], int] | None = None
    # key column for a uniqueness check (needs its own grouping)
    unique_key: tuple[str, ...] | None = None

    def with_severity(self, severity: str) -> Check:
        return Check(self.name, self.columns, severity, self.count_expr, self.schema_violations, self.unique_key)


class CheckFailed(AssertionError):
    def __init__(self, failures: list):
        self.failures = failures
        text = "; ".join(f"{r['check']}({r['column']}): {r['violations']} violation(s)" for r in failures)
        super().__init__(f"data-quality checks failed: {text}")


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def no_nulls(column: str, severity: str = FAIL) -> Check:
    """No null in ``column``."""
    return Check("no_nulls", (column,), severity, lambda df: F.count_if(_col(column).isNull()))


def accepted_values(column: str, values: Sequence, severity: str = FAIL) -> Check:
    """Every non-null value is one of ``values`` (nulls are E1's job; a
    null in the list says nothing)."""
    vals = [v for v in values if v is not None]
    return Check(
        "accepted_values",
        (column,),
        severity,
        lambda df: F.count_if(_col(column).isNotNull() & ~_col(column).isin(vals)),
    )


def in_range(column: str, low: float, high: float, severity: str = FAIL) -> Check:
    """``low <= value <= high``. Null is not a violation; NaN is (it
    compares greater than any number in Spark)."""
    return Check(
        "in_range",
        (column,),
        severity,
        lambda df: F.count_if((_col(column) < F.lit(low)) | (_col(column) > F.lit(high))),
    )


def no_nulls_all(columns: Sequence[str], severity: str = FAIL) -> Check:
    """Total null count over several columns is zero."""
    cols = tuple(columns)

    def expr(df: DataFrame) -> Column:
        total = F.lit(0).cast("long")
        for c in cols:
            total = total + F.count_if(_col(c).isNull())
        return total

    return Check("no_nulls_all", cols, severity, expr)


def holds(name: str, predicate: Callable[[], Column] | str, columns: Sequence[str] = (), severity: str = FAIL) -> Check:
    """E5: ``predicate`` holds on every row. A row where it is false is a
    violation; where it is null (null inputs) it is not, like a SQL filter
    for the violating rows."""

    def expr(df: DataFrame) -> Column:
        p = F.expr(predicate) if isinstance(predicate, str) else predicate()
        return F.count_if(~p)

    return Check(name, tuple(columns), severity, expr)


def is_floating(column: str, severity: str = WARN) -> Check:
    """The column's type is float or double (schema only, no job)."""
    return Check(
        "is_floating",
        (column,),
        severity,
        schema_violations=lambda df: 0 if isinstance(df.schema[column].dataType, _FLOATING) else 1,
    )


def not_empty(severity: str = FAIL) -> Check:
    """At least one row."""
    return Check("not_empty", (), severity, lambda df: F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long"))


def field_is(column: str, type_name: str, severity: str = FAIL) -> Check:
    """The column's type is ``type_name`` (Spark simple string, e.g.
    ``string``, ``double``, ``bigint``)."""
    want = T.DataType.fromDDL(type_name).simpleString()
    return Check(
        "field_is",
        (column,),
        severity,
        schema_violations=lambda df: 0 if df.schema[column].dataType.simpleString() == want else 1,
    )


def unique(*columns: str, severity: str = FAIL) -> Check:
    """The key is unique; violations = number of keys seen more than once.
    Rows with a null key part are ignored (they never match in a join)."""
    return Check("unique", tuple(columns), severity, unique_key=tuple(columns))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; one row per check.

    All row checks share a single aggregate over ``df``; each ``unique``
    check adds one grouped aggregate attached as a scalar subquery. Nothing
    is collected here: call ``assert_checks`` (or act on the frame) to run it.
    """
    if not checks:
        raise ValueError("no checks given")
    aggs: list[Column] = []
    cells: list[Column] = []
    for i, chk in enumerate(checks):
        if chk.count_expr is not None:
            aggs.append(chk.count_expr(df).cast("long").alias(f"_v{i}"))
            cells.append(F.col(f"_v{i}"))
        elif chk.schema_violations is not None:
            cells.append(F.lit(int(chk.schema_violations(df))).cast("long"))
        elif chk.unique_key is not None:
            keys = [_col(k) for k in chk.unique_key]
            present = keys[0].isNotNull()
            for k in keys[1:]:
                present = present & k.isNotNull()
            dupes = (
                df.where(present)
                .groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1)
                .agg(F.count(F.lit(1)).cast("long"))
            )
            cells.append(dupes.scalar())
        else:
            raise ValueError(f"check {chk.name} has nothing to evaluate")

    base = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    rows = F.array(
        *[
            F.struct(
                F.lit(chk.name).alias("check"),
                F.lit(",".join(chk.columns)).alias("column"),
                F.lit(chk.severity).alias("severity"),
                cell.alias("violations"),
            )
            for chk, cell in zip(checks, cells)
        ]
    )
    return (
        base.select(F.inline(rows))
        .withColumn("passed", F.col("violations") == 0)
        .select("check", "column", "severity", "violations", "passed")
    )


def row_metrics(df: DataFrame, checks: Sequence[Check]) -> dict[str, Column]:
    """The violation counts of the row checks, as aggregates over ``df`` that a
    write can observe; ``checked`` takes their values."""
    return {f"_v{i}": chk.count_expr(df).cast("long") for i, chk in enumerate(checks) if chk.count_expr is not None}


def checked(written: DataFrame, checks: Sequence[Check], counted: Mapping[str, int]) -> list[dict]:
    """The result rows of ``run_checks`` for a table whose row checks were
    counted while it was written. Only ``unique`` checks run a job."""
    keyed = [chk for chk in checks if chk.unique_key is not None]
    found = iter(run_checks(written, keyed).collect()) if keyed else iter(())
    out = []
    for i, chk in enumerate(checks):
        if chk.count_expr is not None:
            violations = int(counted[f"_v{i}"])
        elif chk.schema_violations is not None:
            violations = int(chk.schema_violations(written))
        else:
            violations = int(next(found)["violations"])
        out.append(
            {"check": chk.name, "column": ",".join(chk.columns), "severity": chk.severity, "violations": violations, "passed": violations == 0}
        )
    return out


def assert_checks(results: DataFrame) -> list:
    """Run the checks and raise ``CheckFailed`` if a fail-severity check has
    violations. Returns the result rows (one per check, a bounded result)."""
    rows = [r.asDict() for r in results.collect()]
    failures = [r for r in rows if not r["passed"] and r["severity"] == FAIL]
    if failures:
        raise CheckFailed(failures)
    return rows
