"""Declarative data checks.

All row checks of a table are counted in one pass over it, and so are the unique and the foreign
keys of all tables. Results have the shape
``(table_name, check_name, column_name, n_failed)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampType

from tallyhouse.functions.money import money_sum


@dataclass(frozen=True)
class Range:
    """Accepted range of a column."""

    low: float | None = None
    high: float | None = None
    inclusive: bool = True


@dataclass(frozen=True)
class Checks:
    """What must hold for a table. NULLs pass every check but ``not_null``."""

    not_null: str = ""
    unique: str = ""
    refers: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    values: Mapping[str, tuple] = field(default_factory=dict)
    ranges: Mapping[str, Range] = field(default_factory=dict)
    holds: Mapping[str, str] = field(default_factory=dict)


def _outside(column: str, accepted: Range) -> Column:
    c = F.col(column)
    failed = F.lit(False)
    if accepted.low is not None:
        failed = failed | ((c < accepted.low) if accepted.inclusive else (c <= accepted.low))
    if accepted.high is not None:
        failed = failed | ((c > accepted.high) if accepted.inclusive else (c >= accepted.high))
    return failed


def row_rules(checks: Checks) -> list[tuple[str, str, Column]]:
    """(check, column, failed-condition) of every rule that looks at one row."""
    rules = [("not_null", c, F.col(c).isNull()) for c in checks.not_null.split()]
    rules += [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in checks.values.items()]
    rules += [("accepted_range", c, _outside(c, r)) for c, r in checks.ranges.items()]
    rules += [("expression_is_true", name, ~F.expr(text)) for name, text in checks.holds.items()]
    return rules


def check_rows(table_name: str, df: DataFrame, checks: Checks) -> DataFrame:
    """Failures of all row rules, from one aggregation."""
    rules = row_rules(checks)
    counts = df.agg(*[F.count_if(failed).alias(f"n{i}") for i, (_, _, failed) in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(f"n{i}").alias("n_failed"),
        )
        for i, (check, column, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _values(df: DataFrame, columns: Sequence[tuple[int, str]]) -> DataFrame:
    """(rule, value) of every value of the numbered columns, from one pass; NULLs are left out.

    Values are compared as text, so that columns of all kinds fit into one; a date is its midnight.
    """

    def text(c: str) -> Column:
        in_time = isinstance(df.schema[c].dataType, (DateType, TimestampType))
        return (F.col(c).cast("timestamp_ntz") if in_time else F.col(c)).cast("string")

    listed = F.array(*(F.struct(F.lit(n).alias("rule"), text(c).alias("value")) for n, c in columns))
    return df.select(F.inline(listed)).filter("value is not null")


def _told(check: str, rules: Sequence[tuple[str, str]], failed: DataFrame, count: Callable[[Column], Column]) -> DataFrame:
    """One row per rule (table, column), counted from the failures (rule, ...) in one aggregation."""
    counts = failed.agg(*[count(F.col("rule") == n).alias(f"n{n}") for n in range(len(rules))])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.coalesce(f"n{n}", F.lit(0)).cast("bigint").alias("n_failed"),
        )
        for n, (table, column) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _by_table(rules: Sequence[tuple[str, str]]) -> dict[str, list[tuple[int, str]]]:
    out: dict[str, list[tuple[int, str]]] = {}
    for n, (table, column) in enumerate(rules):
        out.setdefault(table, []).append((n, column))
    return out


def check_unique(tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Number of values that occur more than once, for every rule (table, column).

    Each table is read once, and all rules share one shuffle. Equal values are combined before it,
    so a value's share of the rows does not matter.
    """
    values = [_values(tables[table], columns) for table, columns in _by_table(rules).items()]
    repeated = reduce(DataFrame.unionAll, values).groupBy("rule", "value").count().filter("count > 1")
    return _told("unique", rules, repeated, F.count_if)


def check_relationships(
    tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Number of rows whose value is missing from the parent's column, for every rule (table, column,
    parent, parent's column).

    Each child is read once, and each parent's column once, however many rules refer to it. Rows are
    counted per value before they meet the parents' distinct values in one anti join, so a value's
    share of the rows does not matter.
    """
    parents = list(dict.fromkeys((parent, field) for _, _, parent, field in rules))
    known = [
        _values(tables[parent], columns).select(F.col("rule").alias("_parent"), F.col("value").alias("_known"))
        for parent, columns in _by_table(parents).items()
    ]
    own = [(table, column) for table, column, _, _ in rules]
    used = [_values(tables[table], columns) for table, columns in _by_table(own).items()]
    of = F.element_at(F.array(*(F.lit(parents.index((parent, field))) for _, _, parent, field in rules)), F.col("rule") + 1)
    counted = reduce(DataFrame.unionAll, used).groupBy("rule", "value").count().withColumn("parent", of)
    dangling = counted.join(
        reduce(DataFrame.unionAll, known).distinct(),
        (F.col("parent") == F.col("_parent")) & (F.col("value") == F.col("_known")),
        "left_anti",
    )
    return _told("relationships", own, dangling, lambda hit: F.sum(F.when(hit, F.col("count"))))


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, Checks]) -> DataFrame:
    """Every check of every table named in ``checks``."""
    results = [check_rows(name, tables[name], wanted) for name, wanted in checks.items() if row_rules(wanted)]
    unique, refers = unique_rules(checks), reference_rules(checks)
    results += [check_unique(tables, unique)] if unique else []
    results += [check_relationships(tables, refers)] if refers else []
    return reduce(DataFrame.unionAll, results)


def unique_rules(checks: Mapping[str, Checks]) -> list[tuple[str, str]]:
    return [(name, c) for name, wanted in checks.items() for c in wanted.unique.split()]


def reference_rules(checks: Mapping[str, Checks]) -> list[tuple[str, str, str, str]]:
    return [(name, c, *parent) for name, wanted in checks.items() for c, parent in wanted.refers.items()]


def reconcile(expected: DataFrame, movements: DataFrame, key: str, balance: str, amount: str) -> DataFrame:
    """Keys whose movements do not add up to the expected balance."""
    actual = movements.groupBy(key).agg(money_sum(amount).alias("actual"))
    return (
        expected.select(key, F.col(balance).alias("expected"))
        .join(actual, key, "left")
        .filter(F.col("expected") != F.col("actual"))
        .select(key, "expected", "actual")
    )
