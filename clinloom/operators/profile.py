"""Column types and profiles of all-text tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions import text as X

SAMPLE_VALUES = 5
DISTINCT_LIMIT = 1_000  # larger counts are also shown as "1000+"
SHUFFLED_BYTES = 64  # longer texts are counted by a hash


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per cell: ``ordinal_position, column_name, value`` (stripped, blank as NULL)."""
    cells = F.array(
        *(
            F.struct(F.lit(n).alias("ordinal_position"), F.lit(c).alias("column_name"), X.blank_to_null(F.col(f"`{c}`")).alias("value"))
            for n, c in enumerate(columns, 1)
        )
    )
    return df.select(F.inline(cells))


def first_rows(df: DataFrame, rows: int, order_by: str) -> DataFrame:
    """The first rows by a column."""
    return df.orderBy(order_by).limit(rows)


def _every(test: Column) -> Column:
    """Whether the test holds for every filled value (and there is one)."""
    return F.coalesce(F.bool_and(F.when(F.col("value").isNotNull(), F.coalesce(test, F.lit(False)))), F.lit(False))


def infer_load_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Loader types from all rows: uuid, datetime, date, else text.

    Days and times count only if they exist, so the cast that follows cannot
    fail. One partial aggregate per task; no values are shuffled.
    """
    value = F.col("value")
    kind = (
        F.when(_every(value.rlike(X.UUID_PATTERN)), "uuid")
        .when(_every(X.moment_of(value).isNotNull()), "datetime")
        .when(_every(X.day_of(value).isNotNull()), "date")
        .otherwise("text")
    )
    return unpivot(df, columns).groupBy("ordinal_position", "column_name").agg(kind.alias("value_kind"))


def coerce(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Blank to NULL, strip, and cast by kind; a value outside its kind fails the load."""

    def cast(column: str, kind: str) -> Column:
        text = X.blank_to_null(F.col(f"`{column}`"))
        if kind == "date":
            return text.cast("date")
        if kind == "datetime":
            return F.regexp_replace(text, "Z$", "").cast("timestamp_ntz")
        return text

    return df.select(*(cast(c, kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns))


def _tested(cells: DataFrame) -> DataFrame:
    """Each cell with what it could be; the aggregates then only combine flags and values."""
    value = F.col("value")
    is_number = value.rlike(X.FLOAT_PATTERN)
    return cells.select(
        *cells.columns,
        F.lower(value).isin(*X.BOOLEAN_WORDS).alias("is_boolean"),
        value.rlike(X.INTEGER_PATTERN).alias("is_integer"),
        is_number.alias("is_number"),
        F.when(is_number, value.try_cast("decimal(38,18)")).alias("number"),
        # by size, for columns with numbers that no decimal holds
        F.when(is_number, F.struct(value.try_cast("double").alias("size"), F.col("value").alias("text"))).alias("any_number"),
        X.moment_of(value).alias("moment"),
        X.day_of(value).alias("day"),
        value.rlike(X.UUID_PATTERN).alias("is_uuid"),
    )


def _beyond_decimal(value: Column) -> Column:
    """Whether a number has more digits than ``decimal(38,18)`` keeps, or an exponent that may ask for them."""
    whole = F.regexp_extract(value, r"^[+-]?0*([0-9]*)", 1)
    fraction = F.regexp_extract(value, r"[.]([0-9]*?)0*$", 1)
    small = value.try_cast("double").between(-1e15, 1e15) & ((F.abs(value.try_cast("double")) > 1e-6) | (value.try_cast("double") == 0))
    return F.when(value.rlike("[eE]"), ~small).otherwise((F.length(whole) > 20) | (F.length(fraction) > 18))


def _type_label() -> Column:
    """The first type every filled value has; needs the columns of ``_tested``."""
    filled = F.count("value")

    def all_are(test: Column) -> Column:
        return F.bool_and(test)  # NULL cells do not count

    return (
        F.when(filled == 0, "empty")
        .when(all_are(F.col("is_boolean")), "boolean")
        .when(all_are(F.col("is_integer")), "integer")
        .when(all_are(F.col("is_number")), "decimal")
        .when(F.count("moment") == filled, "datetime")
        .when(F.count("day") == filled, "date")
        .when(all_are(F.col("is_uuid")), "uuid")
        .otherwise("text")
    )


def infer_full_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Profiler types from all rows."""
    cells = _tested(unpivot(df, columns))
    return cells.groupBy("ordinal_position", "column_name").agg(_type_label().alias("inferred_type"))


def _moment_text(moment: Column) -> Column:
    text = moment.cast("string")
    fraction = F.substring(text, 21, 6)
    return F.concat(F.substring(text, 1, 19), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), F.rpad(fraction, 6, "0"))))


def distinct_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of each column (blank as NULL), their length, and how often. Copies collapse before the shuffle.

    A text of more than ``SHUFFLED_BYTES`` that is no number or time is told
    from others by its 128-bit hash, which takes its place as ``value``: what
    is shuffled for a cell does not grow with its text.
    """
    value = F.col("value")
    long_text = (F.octet_length(value) > SHUFFLED_BYTES) & ~value.rlike(X.FLOAT_PATTERN) & X.moment_of(value).isNull()
    cells = unpivot(df, columns).select(
        "ordinal_position", "column_name", F.when(long_text, F.concat(F.lit("#"), F.md5(value))).otherwise(value).alias("value"),
        F.length(value).alias("length"), F.octet_length(value).alias("bytes"),  # the bytes tell a hash from a value that looks like one
    )
    return cells.groupBy("ordinal_position", "column_name", "value", "length", "bytes").agg(F.count("*").alias("n"))


def column_statistics(df: DataFrame, columns: Sequence[str], cells: DataFrame | None = None) -> DataFrame:
    """Everything of a profile but samples, from its distinct values: patterns are tried once a value."""
    value, n = F.col("value"), F.col("n")
    stats = (
        _tested(distinct_cells(df, columns) if cells is None else cells)
        .groupBy("ordinal_position", "column_name")
        .agg(
            _type_label().alias("inferred_type"),
            F.sum(n).alias("rows"),
            F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).alias("non_null_count"),
            F.count(value).alias("distinct_values"),
            F.min("length").alias("min_length"),
            F.max("length").alias("max_length"),
            *(
                f(kind).alias(f"{name}_{kind}")
                for kind in ("number", "any_number", "moment", "day")
                for name, f in (("min", F.min), ("max", F.max))
            ),
            F.bool_or(F.col("is_number") & _beyond_decimal(value)).alias("beyond"),
        )
    )

    def bound(name: str) -> Column:
        kind = F.col("inferred_type")
        return (
            F.when(kind.isin("integer", "decimal") & F.col("beyond"), F.col(f"{name}_any_number.text"))
            .when(kind.isin("integer", "decimal"), X.plain_decimal(F.col(f"{name}_number")))
            .when(kind == "datetime", _moment_text(F.col(f"{name}_moment")))
            .when(kind == "date", F.col(f"{name}_day").cast("string"))
            .alias(f"{name}_value")
        )

    return stats.select(
        "ordinal_position",
        "column_name",
        "inferred_type",
        "rows",
        "non_null_count",
        (F.col("rows") - F.col("non_null_count")).alias("blank_count"),
        X.completeness(F.col("non_null_count"), F.col("rows")).alias("completeness_pct"),
        "min_length",
        "max_length",
        bound("min"),
        bound("max"),
        "distinct_values",
    )


def first_distinct(df: DataFrame, values: Mapping[str, Column], limit: int, place: Column | None = None) -> tuple[int, dict[str, list[str]]]:
    """The rows of a table, and the first ``limit`` distinct values of some expressions, by ``place`` or else the smallest.

    Every scan finds the next value of all of them at once, as one aggregate
    whose state is one value each: a task sends one row, whatever the number
    of distinct values, and the driver gets one row a scan.
    """
    rows, found = 0, {name: [] for name in values}
    number = {name: n for n, name in enumerate(values)}
    picked = df.select(*([] if place is None else [place.alias("place")]), *(v.alias(f"v{number[name]}") for name, v in values.items()))
    wanted = list(values)
    for scan in range(limit):
        aggregates = [F.count(F.lit(1)).alias("rows")] if scan == 0 else []
        for name in wanted:
            column, known = f"v{number[name]}", found[name]
            value = F.col(column)
            fresh = value.isNotNull()
            if known:
                fresh = fresh & (value > F.lit(known[-1]) if place is None else ~value.isin(known))
            key = value if place is None else F.struct(F.col("place"), value.alias("value"))
            aggregates.append(F.min(F.when(fresh, key)).alias(column))
        if not aggregates:
            break
        row = picked.agg(*aggregates).head()
        rows = row["rows"] if scan == 0 else rows
        wanted = [name for name in wanted if row[f"v{number[name]}"] is not None]
        for name in wanted:
            value = row[f"v{number[name]}"]
            found[name].append(value if place is None else value["value"])
    return rows, found


def distinct_counts(df: DataFrame, columns: Sequence[str], limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Exact distinct counts: ``column_name, distinct_count, is_capped`` (whether it is shown as ``limit+``)."""
    names = F.explode(F.array(*map(F.lit, columns))).alias("column_name")
    every = df.sparkSession.range(1).select(names)
    found = distinct_cells(df, columns).groupBy("column_name").agg(F.count("value").alias("n"))
    count = F.coalesce("n", F.lit(0))
    return every.join(found, "column_name", "left").select("column_name", count.alias("distinct_count"), (count > limit).alias("is_capped"))


def _place(df: DataFrame, order_by: str | Column | None) -> Column:
    return F.monotonically_increasing_id() if order_by is None else df[order_by] if isinstance(order_by, str) else order_by


def sample_values(df: DataFrame, columns: Sequence[str], limit: int = SAMPLE_VALUES, order_by: str | Column | None = None) -> DataFrame:
    """The first distinct values per column, by a column or position; columns without any have no row."""
    texts = {c: X.blank_to_null(F.col(f"`{c}`")) for c in columns}
    _, found = first_distinct(df, texts, limit, _place(df, order_by))
    return df.sparkSession.createDataFrame([(c, v) for c, v in found.items() if v], "column_name string, sample_values array<string>")


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    file_name: str,
    sample_limit: int = SAMPLE_VALUES,
    distinct_limit: int = DISTINCT_LIMIT,
    order_by: str | Column | None = None,
) -> DataFrame:
    """One row per column of an all-text table: one pass to its distinct values and all that follows from those, and one scan a sample."""
    cells = distinct_cells(df, columns)
    samples = sample_values(df, columns, sample_limit, order_by)
    joined = column_statistics(df, columns, cells).join(samples, "column_name", "left")
    count = F.col("distinct_values")
    return joined.select(
        F.lit(file_name).alias("file_name"),
        "ordinal_position",
        "column_name",
        "inferred_type",
        "non_null_count",
        "blank_count",
        "completeness_pct",
        count,
        F.when(count > distinct_limit, f"{distinct_limit}+").otherwise(count.cast("string")).alias("distinct_count"),
        (count > distinct_limit).alias("distinct_count_is_capped"),
        F.coalesce(F.array_join("sample_values", " | "), F.lit("")).alias("sample_values"),
        "min_length",
        "max_length",
        "min_value",
        "max_value",
    )


def file_profile(df: DataFrame, columns: Sequence[str], file_name: str, delimiter: str = ",", size: int | None = None) -> DataFrame:
    """Rows, columns and blank cells of one table; the size comes from the file listing."""
    blanks = sum((X.blank_to_null(F.col(f"`{c}`")).isNull().cast("long") for c in columns), F.lit(0))
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(blanks), F.lit(0)).alias("blank_cells")).select(
        F.lit(file_name).alias("file_name"),
        "row_count",
        F.lit(len(columns)).alias("column_count"),
        F.lit(delimiter).alias("delimiter"),
        F.lit(size).cast("long").alias("file_size_bytes"),
        "blank_cells",
    )
