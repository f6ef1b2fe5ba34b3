"""Splitting, de-duplication and data-quality reports."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions import any_null, holds, quoted
from gustline.operators.schema import require_columns


def keep_valid(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy the condition."""
    return df.filter(condition)


def keep_invalid(df: DataFrame, condition: Column) -> DataFrame:
    """Every other row, also where the condition is unknown: nothing falls between the two."""
    return df.filter(~holds(condition))


def drop_duplicate_rows(
    df: DataFrame, keys: Sequence[str] | None = None, latest_by: str | None = None
) -> DataFrame:
    """One row per distinct row, or per distinct ``keys``.

    Both forms combine copies inside each map task first, so a row repeated any number of times
    sends one copy per task through the shuffle. With ``keys`` the survivor is the row with the
    greatest ``latest_by``, ties going to the greatest remaining values: the same on every run.
    """
    if keys is None:
        return df.dropDuplicates()
    require_columns(df, [*keys, *([latest_by] if latest_by else [])])
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.select(*map(quoted, keys)).distinct()
    ranked = sorted(rest, key=lambda name: name != latest_by)
    best = F.max(F.struct(*map(quoted, ranked))).alias("best")
    chosen = df.groupBy(*map(quoted, keys)).agg(best)
    return chosen.select(
        *(quoted(name) if name in keys else F.col("best").getField(name).alias(name) for name in df.columns)
    )


def validation_statistics(
    df: DataFrame,
    condition: Column,
    keys: Sequence[str] | None = None,
    deduplicated: DataFrame | int | None = None,
) -> DataFrame:
    """Rows entering, removed by and leaving the filter and the de-duplication.

    Result: ``step`` (filter, deduplicate), ``rows_in``, ``rows_removed``, ``rows_out``.

    Everything comes from one scan and one shuffle, which carries one pre-counted record per
    distinct valid row and task; all invalid rows share one record. The counts are an ordinary
    aggregate, so a lost executor cannot count a row twice. ``keys`` are those of the
    de-duplication (default: the whole row). If the de-duplicated rows are already a written
    table, or their number is known, pass that: then no row is shuffled at all.
    """
    valid = holds(condition)
    if deduplicated is None:
        compared = df.columns if keys is None else keys
        copies = df.groupBy(
            valid.alias("valid"),
            *(F.when(valid, quoted(name)).alias(f"key_{i}") for i, name in enumerate(compared)),
        ).agg(F.count(F.lit(1)).alias("copies"))
        totals = copies.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("seen"),
            F.coalesce(F.sum(F.when(F.col("valid"), F.col("copies"))), F.lit(0)).alias("kept"),
            F.count_if(F.col("valid")).alias("unique"),
        )
    elif isinstance(deduplicated, int):
        totals = df.agg(
            F.count(F.lit(1)).alias("seen"),
            F.count_if(valid).alias("kept"),
            F.lit(deduplicated).cast("bigint").alias("unique"),
        )
    else:
        counted = df.agg(
            F.count(F.lit(1)).alias("seen"), F.count_if(valid).alias("kept"), F.lit(0).alias("unique")
        )
        written = deduplicated.agg(
            F.lit(0).alias("seen"), F.lit(0).alias("kept"), F.count(F.lit(1)).alias("unique")
        )
        totals = counted.union(written).agg(*(F.sum(name).alias(name) for name in counted.columns))

    def step(name: str, rows_in: str, rows_out: str) -> Column:
        return F.struct(
            F.lit(name).alias("step"),
            F.col(rows_in).alias("rows_in"),
            (F.col(rows_in) - F.col(rows_out)).alias("rows_removed"),
            F.col(rows_out).alias("rows_out"),
        )

    return totals.select(
        F.inline(F.array(step("filter", "seen", "kept"), step("deduplicate", "kept", "unique")))
    )


def audit_null_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows in which at least one of the columns (default: any column) has no value."""
    return df.filter(any_null(df.columns if columns is None else columns))


def constraint_violations(
    df: DataFrame,
    not_null: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    unique: Iterable[Sequence[str]] = (),
    checks: Iterable[str] = (),
    nulls_equal: Iterable[Sequence[str]] = (),
) -> DataFrame:
    """Rows that a table with these constraints would have refused.

    Result: ``constraint``, ``columns``, ``violating_rows``. A key counts the surplus rows of each
    repeated value. A primary key implies NOT NULL on its columns; a unique key leaves out rows that
    lack a part of it, unless it is named among ``nulls_equal``. A check counts the rows for which it
    is false (unknown is no violation); ``columns`` is then its text.

    One scan, whatever the constraints: several keys are grouping sets of it. The shuffle carries
    nothing but keys with their counts, combined in the map tasks, so a hot key is cheap.
    """
    checks, uniques = list(checks), [tuple(key) for key in unique]
    alike = {tuple(key) for key in nulls_equal}
    uniques += [key for key in alike if key not in uniques]
    required = list(dict.fromkeys([*primary_key, *not_null]))
    keys = [tuple(primary_key)] * bool(primary_key) + uniques
    if not (required or keys or checks):
        raise ValueError("No constraint to check")
    require_columns(df, [*required, *(name for key in keys for name in key)])

    def entry(kind: str, columns: str, violations: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("constraint"),
            F.lit(columns).alias("columns"),
            violations.alias("violating_rows"),
        )

    parts = {name: f"key_{i}" for i, name in enumerate(dict.fromkeys(name for key in keys for name in key))}
    null_counts = {name: f"null_{i}" for i, name in enumerate(required)}
    failures = {text: f"check_{i}" for i, text in enumerate(checks)}
    rows = df.select(
        *(quoted(name).alias(part) for name, part in parts.items()),
        *(quoted(name).isNull().alias(null) for name, null in null_counts.items()),
        *((~F.expr(text)).alias(failure) for text, failure in failures.items()),
    )
    # Every row is in each grouping set once, so any one of them has all nulls and failures.
    sets = [[F.col(parts[name]) for name in key] for key in keys] or [[]]
    counts = [F.count(F.lit(1)).alias("copies")]
    counts += [F.count_if(flag).alias(flag) for flag in (*null_counts.values(), *failures.values())]
    if len(sets) == 1:
        copies = rows.groupBy(*sets[0]).agg(*counts).withColumn("kind", F.lit(0))
    else:
        grouped = rows.groupingSets(sets, *map(F.col, parts.values()))
        # The bits of the grouping id are the columns that a set leaves out, the first one the highest.
        names = list(parts)
        left_out = [sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in key) for key in keys]
        kind = F.array_position(F.array(*map(F.lit, left_out)).cast("array<bigint>"), F.col("left_out"))
        copies = grouped.agg(*counts, F.grouping_id().cast("bigint").alias("left_out")).withColumn("kind", kind - 1)

    def surplus(number: int, key: Sequence[str]) -> Column:
        counted = F.col("kind") == number
        if key not in alike:
            counted = reduce(and_, (F.col(parts[name]).isNotNull() for name in key), counted)
        return F.coalesce(F.sum(F.when(counted, F.col("copies") - 1)), F.lit(0)).alias(f"surplus_{number}")

    totals = copies.agg(
        *(surplus(i, key) for i, key in enumerate(keys)),
        *(
            F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col(flag))), F.lit(0)).alias(flag)
            for flag in (*null_counts.values(), *failures.values())
        ),
    )
    kinds = ["PRIMARY KEY"] * bool(primary_key) + ["UNIQUE"] * len(uniques)
    entries = [entry(kind, ", ".join(key), F.col(f"surplus_{i}")) for i, (kind, key) in enumerate(zip(kinds, keys))]
    entries += [entry("NOT NULL", name, F.col(null)) for name, null in null_counts.items()]
    entries += [entry("CHECK", text, F.col(failure)) for text, failure in failures.items()]
    return totals.select(F.inline(F.array(*entries)))


_NAMED = re.compile(r"^constraint\s+(\"[^\"]+\"|\w+)\s+", re.IGNORECASE)
_KEY = re.compile(r"^(primary\s+key|unique)(\s+nulls\s+(?:not\s+)?distinct)?\s*\((.+)\)$", re.IGNORECASE | re.DOTALL)
_CHECK = re.compile(r"^check\s*\((.+)\)$", re.IGNORECASE | re.DOTALL)
_COLUMN = re.compile(r"\s*(?:\"((?:[^\"]|\"\")+)\"|(\w+))\s*(?:,|$)")


def _key_columns(text: str) -> tuple[str, ...]:
    names, place = [], 0
    while place < len(text):
        found = _COLUMN.match(text, place)
        if not found:
            raise ValueError(f"No list of columns: {text!r}")
        names.append(found[1].replace('""', '"') if found[1] else found[2])
        place = found.end()
    return tuple(names)


def declared_constraints(constraints: Iterable[str], schema: Mapping[str, str] | None = None) -> dict[str, Any]:
    """The arguments of ``constraint_violations`` for constraints as a table definition spells them.

    ``constraints`` are table constraints: ``PRIMARY KEY (a, b)``, ``UNIQUE [NULLS NOT DISTINCT] (a)`` and
    ``CHECK (condition)``, with or without a name. ``schema`` maps columns to declared types, which may end in
    NOT NULL, PRIMARY KEY or UNIQUE. Anything else, such as a foreign key, raises ``ValueError``.
    """
    declared: dict[str, Any] = {"not_null": [], "primary_key": (), "unique": [], "checks": [], "nulls_equal": []}

    def primary(key: tuple[str, ...]) -> None:
        if declared["primary_key"]:
            raise ValueError("A table has one primary key")
        declared["primary_key"] = key

    for name, kind in (schema or {}).items():
        words = " ".join(kind.lower().split())
        if re.search(r" not null\b", words):
            declared["not_null"].append(name)
        if re.search(r" primary key\b", words):
            primary((name,))
        if re.search(r" unique\b", words):
            declared["unique"].append((name,))
    for text in constraints:
        body = _NAMED.sub("", text.strip().rstrip(",").strip())
        if key := _KEY.match(body):
            columns = _key_columns(key[3])
            if key[1].lower().startswith("primary"):
                primary(columns)
            elif key[2] and " not " in f" {' '.join(key[2].lower().split())} ":
                declared["nulls_equal"].append(columns)
            else:
                declared["unique"].append(columns)
        elif check := _CHECK.match(body):
            declared["checks"].append(check[1].strip())
        else:
            raise ValueError(f"No constraint that can be checked: {text!r}")
    return declared


def declared_violations(
    df: DataFrame, constraints: Iterable[str], schema: Mapping[str, str] | None = None
) -> DataFrame:
    """``constraint_violations`` of constraints as a table definition spells them."""
    return constraint_violations(df, **declared_constraints(constraints, schema))
