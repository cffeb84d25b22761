"""Declarative quality rules, checked in one pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.operators.keys import orphans_by_key


@dataclass(frozen=True)
class Rule:
    """Rows of ``table`` for which ``fails`` is true break the rule; an unknown result does not."""

    table: str
    name: str
    fails: Column


class QualityError(ValueError):
    """A refresh that must not be published; the message names each broken rule."""


def check_rules(tables: dict[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``table_name, check_type, failing_rows`` for every rule. All rules of a table share one scan."""
    per_table: dict[str, list[Rule]] = {}
    for rule in rules:
        per_table.setdefault(rule.table, []).append(rule)
    return union_all([_one_pass(tables[t], t, group) for t, group in per_table.items()])


def _one_pass(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    counts = df.agg(*[F.count_if(r.fails).alias(f"c{i}") for i, r in enumerate(rules)])
    pairs = [F.struct(F.lit(r.name).alias("check_type"), F.col(f"c{i}").alias("failing_rows"))
             for i, r in enumerate(rules)]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs)))


def check_orphans(tables: dict[str, DataFrame], dim: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of each table whose key has no dimension row."""
    return union_all([
        orphans_by_key(df, dim, key).agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("failing_rows"))
        .select(F.lit(table).alias("table_name"), F.lit(name).alias("check_type"), "failing_rows")
        for table, df in tables.items()
    ])


def check_grain(df: DataFrame, table: str, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of each key; NULL keys count as equal. Rows are counted per key on the map side."""
    extra = df.groupBy(*keys).agg((F.count("*") - 1).alias("_extra"))
    return extra.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_type"), "failing_rows")


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]], name: str) -> DataFrame:
    """Row counts of curated and raw tables; a negative variance lost rows, a positive one multiplied them."""
    rows = []
    for table, (curated, raw) in pairs.items():
        sides = curated.agg(F.count("*").alias("curated_rows")).select(
            "curated_rows", raw.agg(F.count("*").alias("n")).scalar().alias("raw_rows"))
        rows.append(sides.select(
            F.lit(table).alias("table_name"), F.lit(name).alias("check_type"), "curated_rows", "raw_rows",
            (F.col("curated_rows") - F.col("raw_rows")).alias("variance")))
    return union_all(rows)


def assert_clean(checks: DataFrame, count: str = "failing_rows") -> None:
    """Raise ``QualityError`` unless every check counts 0. Only check rows reach the driver."""
    broken = checks.filter(F.col(count) != 0).collect()
    if broken:
        lines = [f"{r['table_name']}: {r['check_type']}: {r[count]}" for r in broken]
        raise QualityError("; ".join(sorted(lines)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
