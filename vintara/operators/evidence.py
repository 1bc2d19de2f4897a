"""Gates over ledgers: boolean questions whose answers are one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gates(df: DataFrame, by: list[str], expected: dict[str, Column], required: tuple[Column, list[str]] | None = None, groups: DataFrame | None = None) -> DataFrame:
    """groups: the groups that must be there; one that is absent comes out with 0 rows, null answers and not passed, one that
    is not expected is left out.

    For each group of `by`: for each name, whether its condition holds for every row (a null counts as no, an empty
    group passes nothing); with required=(column, values), has_all: whether all values occur; passed: all of these."""
    aggs = [F.bool_and(F.coalesce(x, F.lit(False))).alias(n) for n, x in expected.items()]
    names = list(expected)
    if required is not None:
        column, values = required
        aggs.append((F.size(F.array_except(F.array(*[F.lit(v) for v in values]), F.collect_set(F.when(column.isin(values), column)))) == 0).alias("has_all"))
        names.append("has_all")
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    if groups is not None:
        out = groups.select(*by).distinct().join(out, by, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    passed = reduce(lambda a, b: a & b, [F.coalesce(F.col(n), F.lit(False)) for n in names], F.col("n_rows") > 0)
    return out.withColumn("passed", passed)


def transitions_outside(events: DataFrame, edges: DataFrame, before: str = "from", after: str = "to") -> DataFrame:
    """Events whose (before, after) is none of the edges; nulls are no edge."""
    e = edges.select(F.col(before), F.col(after)).distinct()
    return events.join(e, [before, after], "left_anti").select(*events.columns)


def document(rows: DataFrame) -> DataFrame:
    """One row, document: the rows (of a report, few) as sorted, indented JSON with sorted keys."""
    fields = F.to_json(F.struct(*sorted(rows.columns)), {"pretty": "true", "ignoreNullFields": "false"})
    lines = F.array_sort(F.collect_list(fields))
    return rows.agg(F.concat(F.lit("[\n"), F.array_join(lines, ",\n"), F.lit("\n]")).alias("document"))


def independent(source: Column, sources: Column) -> Column:
    """Whether some source other than the row's own is among sources."""
    return F.size(F.array_except(sources, F.array(source))) >= 1
