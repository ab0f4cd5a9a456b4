"""Table constraint and referential checks.

Results are long tables ``(table, check, column, violations)`` /
``(relation, key, rows)`` so any number of checks stack into one report.
Each check is an aggregate (null counts in one pass, duplicate keys by a
partially aggregated ``groupBy``); foreign keys are reduced to distinct
values with row counts before they are anti-joined to the parent keys, so
the join sees one row per key however skewed the child table is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constraint_report(df: DataFrame, table: str, primary_key: Sequence[str] = (),
                      not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """C4: violations of primary key, NOT NULL and UNIQUE constraints.

    ``primary_key``: duplicate key groups, plus nulls in any key column;
    ``not_null``: null count per column; ``unique``: duplicate value groups
    (nulls are not compared, as in SQL). One scan for all of it: the key and
    every UNIQUE column set are grouping sets of a single aggregate (partial
    counts per set, combined map-side), and the null counts ride along in
    it. The single result row is unpivoted into the report.
    """
    pk = list(primary_key)
    null_cols = list(dict.fromkeys(pk + list(not_null)))
    sets = ([("primary_key", pk)] if pk else []) + [("unique", list(u)) for u in unique]
    nulls = [F.count(F.when(F.col(c).isNull(), True)).alias(f"_null_{c}") for c in null_cols]
    findings: list[tuple[str, str, Column]] = []
    if not sets:
        if not nulls:
            raise ValueError("no constraint given")
        totals = df.agg(*nulls)
        findings = [("not_null", c, F.col(f"_null_{c}")) for c in null_cols]
    else:
        group_cols = list(dict.fromkeys(c for _, cols in sets for c in cols))

        def gid(cols: list[str]) -> int:  # grouping_id(): one bit per column, set when not grouped
            return int("".join("0" if c in cols else "1" for c in group_cols), 2)

        grouped = df.groupingSets([cols for _, cols in sets], *group_cols).agg(
            F.count(F.lit(1)).alias("_n"), *nulls, F.grouping_id().alias("_gid"))
        first = gid(sets[0][1])  # every set covers all rows once: null counts from the first
        aggs = [F.coalesce(F.sum(F.when(F.col("_gid") == first, F.col(f"_null_{c}"))), F.lit(0))
                .alias(f"_null_{c}") for c in null_cols]
        for i, (_, cols) in enumerate(sets):
            present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
            aggs.append(F.count(F.when((F.col("_gid") == gid(cols)) & present & (F.col("_n") > 1), True))
                        .alias(f"_dup_{i}"))
        totals = grouped.agg(*aggs)
        findings = [("not_null", c, F.col(f"_null_{c}")) for c in null_cols]
        findings += [(check, ",".join(cols), F.col(f"_dup_{i}")) for i, (check, cols) in enumerate(sets)]
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(col).alias("column"),
                              value.cast("bigint").alias("violations")) for check, col, value in findings])
    return totals.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("table"), "r.check", "r.column", "r.violations")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """Foreign-key values of ``child`` absent from ``parent`` (nulls are
    not violations), with the number of child rows carrying each."""
    counts = (child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key"))
              .agg(F.count(F.lit(1)).alias("rows")))
    parents = parent.select(F.col(pk).alias("key")).distinct()
    return counts.join(parents, "key", "left_anti").select(F.lit(relation).alias("relation"), "key", "rows")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3 on any (composite) key: key values on more than one row, with the
    row count ``n``; rows with a null key part are not compared. A partially
    aggregated ``groupBy``, so a hot key reaches the shuffle pre-counted."""
    keys = list(keys)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    return (df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def orphan_report(children: Sequence[tuple[DataFrame, Sequence[tuple[str, str, DataFrame, str]]]],
                  key_type: str = "bigint") -> DataFrame:
    """C5 for many foreign keys at once: ``(relation, key, rows)`` for every
    foreign-key value without a parent row.

    ``children`` lists each child table with its foreign keys as
    ``(fk_column, relation_name, parent_df, parent_key)``. Each child is
    scanned once: its foreign keys are the grouping sets of one aggregate
    (value counts, combined map-side). All parents' keys, tagged with their
    relation, form one table, and a single anti join on (relation, key)
    finds the orphans. Keys are compared as ``key_type``.
    """
    counted: list[DataFrame] = []
    parents: list[DataFrame] = []
    for child, fks in children:
        fks = list(fks)
        cols = list(dict.fromkeys(fk for fk, _, _, _ in fks))

        def gid(col: str) -> int:
            return int("".join("0" if c == col else "1" for c in cols), 2)

        grouped = (child.groupingSets([[c] for c in cols], *cols)
                   .agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("_gid")))
        relation = F.lit(None).cast("string")
        key = F.lit(None).cast(key_type)
        for fk, name, _, _ in fks:
            relation = F.when(F.col("_gid") == gid(fk), F.lit(name)).otherwise(relation)
            key = F.when(F.col("_gid") == gid(fk), F.col(fk).cast(key_type)).otherwise(key)
        counted.append(grouped.select(relation.alias("relation"), key.alias("key"), "rows")
                       .where(F.col("key").isNotNull()))
        for fk, name, parent, pk in fks:
            parents.append(parent.select(F.lit(name).alias("relation"), F.col(pk).cast(key_type).alias("key"))
                           .where(F.col("key").isNotNull()).distinct())
    all_counts = reduce(DataFrame.unionByName, counted)
    all_parents = reduce(DataFrame.unionByName, parents)
    return all_counts.join(all_parents, ["relation", "key"], "left_anti").select("relation", "key", "rows")
