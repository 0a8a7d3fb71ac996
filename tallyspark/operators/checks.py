"""Data-quality checks (Q1-Q7). Each returns the failing rows as a DataFrame.

All checks are grouped aggregates or anti joins: partial aggregation runs
before the shuffle, so a hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q1: key combinations occurring more than once (NULLs group together)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows whose ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q3: non-NULL values occurring more than once."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q4: values outside the list with their counts; NULL passes."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def check_relationship(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q5: child rows with a non-NULL key that has no parent."""
    p = parent.select(F.col(parent_col).alias(child_col)).distinct()
    return child.where(F.col(child_col).isNotNull()).join(p, child_col, "left_anti")


@dataclass(frozen=True)
class Check:
    """A check given by its failing rows."""

    name: str
    table: str
    failing: DataFrame


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """Q6 for checks of any form: one row per check: (check_name, table_name, failing_rows, passed), in one job."""
    parts = [c.failing.agg(F.count(F.lit(1)).alias("failing_rows"))
             .select(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), "failing_rows")
             for c in checks]
    return _result(parts)


def _result(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    """A unique combination of columns (one column: NULLs pass, as in Q3)."""

    columns: tuple[str, ...]
    ignore_null: bool = False


@dataclass(frozen=True)
class Related:
    """Every non-NULL value has a parent."""

    column: str
    parent: DataFrame
    parent_column: str


@dataclass(frozen=True)
class TableChecks:
    """Named checks of one table."""

    table: str
    df: DataFrame
    checks: dict[str, NotNull | Accepted | Unique | Related]


def check_table(t: TableChecks) -> DataFrame:
    """All checks of a table in one pass over it: (check_name, table_name, failing_rows).

    Row checks are 0/1 flags. Without a unique check they are summed at once; with one, rows are first grouped on
    its columns and the flags summed in each group, so that the one exchange serves both. More than one unique
    check become grouping sets, each row then standing once for each set. A related column takes its flag from an
    outer join with the distinct parent values. As in Q1-Q5, accepted values and unique combinations count
    values and combinations, the others rows.
    """
    df, flags = t.df, {}
    names = {c.lower() for c in df.columns}

    def fresh(name: str) -> str:
        while name.lower() in names:
            name = f"_{name}"
        names.add(name.lower())
        return name

    related = [(n, c) for n, c in t.checks.items() if isinstance(c, Related)]
    for name, c in related:
        key, found = fresh("_parent"), fresh("_found")
        parents = c.parent.select(F.col(c.parent_column).alias(key)).where(F.col(key).isNotNull()).distinct() \
            .withColumn(found, F.lit(True))
        df = df.join(parents, F.col(c.column) == F.col(key), "left").drop(key)
        flags[name] = F.col(c.column).isNotNull() & F.col(found).isNull()
    for name, c in t.checks.items():
        if isinstance(c, NotNull):
            flags[name] = F.col(c.column).isNull()
    sets: dict[str, tuple[str, ...]] = {}
    for name, c in t.checks.items():
        if isinstance(c, Unique):
            sets[name] = c.columns
        elif isinstance(c, Accepted):
            sets[name] = (c.column,)
    columns = {name: fresh(f"_flag{k}") for k, name in enumerate(flags)}
    used = list(dict.fromkeys(c for s in sets.values() for c in s))
    rows = df.select(*used, *[flags[n].cast("bigint").alias(columns[n]) for n in flags])
    sums = [F.sum(columns[n]).alias(columns[n]) for n in flags]
    which, count = fresh("_set"), fresh("_n")
    distinct_sets = list(dict.fromkeys(sets.values()))
    if not sets:
        grouped = rows.agg(*sums)
    elif len(distinct_sets) == 1:
        grouped = rows.groupBy(*used).agg(F.count(F.lit(1)).alias(count), *sums).withColumn(which, F.lit(0))
    else:
        # the columns of a set that lacks a column are NULL there; the id tells the sets apart
        bits = {s: sum(1 << (len(used) - 1 - k) for k, c in enumerate(used) if c not in s) for s in distinct_sets}
        grouped = rows.groupingSets([[F.col(c) for c in s] for s in distinct_sets], *used).agg(
            F.count(F.lit(1)).alias(count), F.grouping_id().alias(which), *sums)
    first = F.lit(True) if len(distinct_sets) < 2 else F.col(which) == bits[distinct_sets[0]]
    results = {n: F.sum(F.when(first, F.col(columns[n]))) for n in flags}
    for name, c in t.checks.items():
        if name not in sets:
            continue
        mine = F.lit(True) if len(distinct_sets) < 2 else F.col(which) == bits[sets[name]]
        if isinstance(c, Unique):
            bad = F.col(count) > 1
            if c.ignore_null:
                for x in c.columns:
                    bad = bad & F.col(x).isNotNull()
        else:
            bad = F.col(c.column).isNotNull() & ~F.col(c.column).isin(list(c.values))
        results[name] = F.sum(F.when(mine & bad, 1).otherwise(0))
    one = grouped.agg(*[F.coalesce(x, F.lit(0)).cast("bigint").alias(f"_{k}") for k, x in enumerate(results.values())])
    each = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(t.table).alias("table_name"), F.col(f"_{k}").alias("failing_rows"))
                     for k, n in enumerate(results)])
    return one.select(F.inline(each))


def check_tables(tables: Sequence[TableChecks]) -> DataFrame:
    """Q6: (check_name, table_name, failing_rows, passed), each table read once."""
    return _result([check_table(t) for t in tables if t.checks])


def differences(full: DataFrame, incremental: DataFrame) -> DataFrame:
    """Q7: rows in one result but not the other (multiset difference both ways)."""
    cols = full.columns
    a = full.exceptAll(incremental.select(*cols)).withColumn("side", F.lit("full_only"))
    b = incremental.select(*cols).exceptAll(full).withColumn("side", F.lit("incremental_only"))
    return a.unionByName(b)


def rebuild_equals_incremental(model: str, full: DataFrame, incremental: DataFrame,
                               tolerance: float = 1e-9, smallest: float = 1e-12) -> DataFrame:
    """Q7 summary: (model, full_rows, incremental_rows, n_diff) as one row.

    ``n_diff`` counts the rows that one side has more of than the other. Equal rows cancel first, in one grouped
    pass over both sides with partial counts. What is left differs at least in a double: inside a group of rows that
    agree in all other columns, doubles that follow each other within ``tolerance`` of their size (or ``smallest``)
    are the same value, since the order of a sum changes its last bits; rows then meet on these values. NULL
    differs from a value. Only rows without an equal partner are sorted.
    """
    doubles = [c for c, t in full.dtypes if t in ("double", "float")]
    exact = [c for c in full.columns if c not in doubles]
    names = {c.lower() for c in full.columns}
    side = "_side"
    while side in names:
        side = f"_{side}"
    n_full, n_incr = f"{side}_full", f"{side}_incr"
    both = full.withColumn(side, F.lit(1)).unionByName(incremental.select(*full.columns).withColumn(side, F.lit(-1)))
    rows = both.groupBy(*full.columns).agg(F.count(F.when(F.col(side) == 1, 1)).alias(n_full),
                                           F.count(F.when(F.col(side) == -1, 1)).alias(n_incr))
    left = rows.where(F.col(n_full) != F.col(n_incr)).withColumn(side, F.col(n_full) - F.col(n_incr)).drop(n_full, n_incr)
    values = []
    for k, c in enumerate(doubles):
        value = f"{side}_value{k}"
        order = Window.partitionBy(*exact).orderBy(F.col(c).asc_nulls_first())
        before = F.lag(c).over(order)
        near = F.abs(F.col(c) - before) <= F.greatest(F.lit(smallest), F.lit(tolerance) * F.greatest(F.abs(F.col(c)), F.abs(before)))
        # 1 where a new value begins; the first NULL and the first number after NULLs begin one
        begins = F.when(F.col(c).isNull() & before.isNull(), F.lit(0)).otherwise(F.coalesce(F.when(near, 0).otherwise(1), F.lit(1)))
        left = left.withColumn(value, begins).withColumn(value, F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        values.append(value)
    differ = left.groupBy(*exact, *values).agg(F.sum(side).alias(side))
    zero = F.lit(0).cast("bigint")
    parts = rows.agg(F.sum(n_full).alias("f"), F.sum(n_incr).alias("i")).select("f", "i", zero.alias("d")).unionByName(
        differ.agg(F.sum(F.abs(side)).alias("d")).select(zero.alias("f"), zero.alias("i"), "d"))
    total = {c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint") for c in "fid"}
    return parts.agg(total["f"].alias("full_rows"), total["i"].alias("incremental_rows"), total["d"].alias("n_diff")) \
        .select(F.lit(model).alias("model"), "full_rows", "incremental_rows", "n_diff")
