"""Type repair, key de-duplication and the counts that describe what was repaired."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import (
    date_parts, integer_reading, integer_value, known_text, may_swap, number_characters, number_text, parse_number,
    preferred_timestamp, short_integer, spelled_digits, spelled_number, spelled_part, spelled_times, strip, timestamp_of,
)
from ledgerline.operators.ranking import global_row_number, number_in_place
from ledgerline.session import code_border
from ledgerline.sources.contracts import TableContract, spark_type
from ledgerline.sources.files import ROW_ORDER

_HAD = "__had_"
# Of a date that may be read either way: the day-first reading, and that there are two.
_DAY_FIRST = "__day_first_"
_EITHER = "__either_"


def clean_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text columns; blanks and spellings of 'missing' become NULL."""
    text = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    trimmed = df.withColumns({c: strip(F.col(c)) for c in text})
    return trimmed.withColumns({c: known_text(F.col(c)) for c in text})


def prefers_day_first(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Per column, whether reading dates day-first parses more values; a tie stays month-first.

    All columns and both readings are counted in one aggregation.
    """
    if not columns:
        return {}
    trimmed = df.select(*[strip(F.col(c)).alias(c) for c in columns])
    parts = trimmed.select(*[date_parts(F.col(c)).alias(c) for c in columns])
    counts = parts.agg(
        *[
            F.count(timestamp_of(F.col(c), day_first)).alias(f"{c}|{day_first}")
            for c in columns
            for day_first in (False, True)
        ]
    ).first()
    return {c: counts[f"{c}|True"] > counts[f"{c}|False"] for c in columns}


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace text columns by timestamps, each under its better reading."""
    day_first = prefers_day_first(df, columns)
    trimmed = df.withColumns({c: strip(F.col(c)) for c in columns})
    parts = trimmed.withColumns({c: date_parts(F.col(c)) for c in columns})
    return parts.withColumns({c: preferred_timestamp(F.col(c), day_first[c]) for c in columns})


def parse_integers(df: DataFrame, columns: Sequence[str], readings: bool = False, loading: bool = False) -> DataFrame:
    """Replace text columns by the integers they spell; ``readings`` adds how each was read.

    ``loading`` is for cells that are trimmed, and ends the fused code before the closer look.
    """
    short, parts, numbers, values = {}, {}, {}, {}
    for c in columns:
        text, digits = F.col(c), F.col(f"__short_{c}")
        part, times, number, whole = (F.col(f"__{step}_{c}") for step in ("part", "times", "number", "whole"))
        # How a cell was read takes the closer look at every cell.
        closer = F.lit(True) if readings else digits == ""
        short[f"__short_{c}"] = short_integer(text)
        parts[f"__part_{c}"] = F.when(closer, spelled_part(text))
        parts[f"__times_{c}"] = F.when(closer, spelled_times(text))
        numbers[f"__number_{c}"] = F.when(closer, spelled_number(text, part, times))
        numbers[f"__whole_{c}"] = F.when(closer, spelled_digits(text, part))
        if readings:
            values[f"{c}_reading"] = integer_reading(text, number)
        values[c] = F.when(digits != "", digits.cast("bigint")).otherwise(integer_value(whole, times, number))
    out = df.withColumns({c: number_text(F.col(c), loading) for c in columns}).withColumns(short)
    out = code_border(out) if loading else out
    return out.withColumns(parts).withColumns(numbers).withColumns(values).drop(*short, *parts, *numbers)


def parse_numbers(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Replace text columns by numbers, dropping currency signs, separators and other junk."""
    kept = df.withColumns({c: number_characters(F.col(c)) for c in columns})
    return kept.withColumns({c: parse_number(F.col(c), kind) for c in columns})


def integer_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How the integers of each text column were read: one scan, one row per column."""
    readings = ("plain", "prefix", "band", "nonint", "lost")
    read = parse_integers(df.select(*columns), columns, readings=True)
    long = read.select(*[F.col(f"{c}_reading").alias(c) for c in columns]).unpivot([], list(columns), "column", "how")
    return long.groupBy("column").agg(
        *[F.count_if(F.col("how") == reading).alias(reading) for reading in readings[:4]],
        F.count_if(F.col("how").isin("nonint", "lost")).alias("lost"),
    )


def clean_types(df: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """Cast a canonical text table to its contract; returns (typed rows, per-column quality).

    One narrow aggregate over the date columns settles how dates are read. Both results are plans over the
    input: the counts need no copy of the rows, and a load takes them while it writes (``quality_measures``).
    """
    typed = type_columns(df, contract)
    rows = typed.select(*contract.headers, *([ROW_ORDER] if ROW_ORDER in df.columns else []))
    return rows, coercion_counts(typed, contract)


def type_columns(df: DataFrame, contract: TableContract, both_readings: bool = False) -> DataFrame:
    """Typed columns, and which non-text cells were filled.

    ``both_readings`` keeps both readings of every date, so that a load need not parse its files before it knows
    which one reads more; ``chosen_readings`` settles them.
    """
    rest = [F.col(ROW_ORDER)] if ROW_ORDER in df.columns else []
    day_first = {} if both_readings else prefers_day_first(df, contract.timestamps)
    cleaned = clean_strings(df.select(*contract.headers, *rest), list(contract.headers))
    had = {_HAD + n: F.col(n).isNotNull() for n, t in contract.types.items() if spark_type(t) != "string"}
    cleaned = parse_integers(cleaned.withColumns(had), contract.integers, loading=both_readings)
    cleaned = cleaned.withColumns({n: number_characters(F.col(n)) for n in contract.numbers})
    if both_readings and contract.timestamps:
        cleaned = code_border(cleaned)
    cleaned = cleaned.withColumns({n: date_parts(F.col(n)) for n in contract.timestamps})
    typed: list[Column] = []
    for name in contract.headers:
        text, kind = F.col(name), spark_type(contract.types[name])
        if name in contract.integers:
            typed.append(text.try_cast(kind).alias(name))
        elif name in contract.numbers:
            typed.append(parse_number(text, kind).alias(name))
        elif name in contract.timestamps and both_readings:
            typed.append(timestamp_of(text, False).alias(name))
            typed.append(F.when(may_swap(text), timestamp_of(text, True)).alias(_DAY_FIRST + name))
            typed.append(F.coalesce(may_swap(text), F.lit(False)).alias(_EITHER + name))
        elif name in contract.timestamps:
            typed.append(preferred_timestamp(text, day_first[name]).alias(name))
        else:
            typed.append(text.alias(name))
    return cleaned.select(*typed, *had, *rest)


def reading_measures(contract: TableContract) -> dict[str, Column]:
    """Aggregates of a table with both readings: the dates that each of them parses; see ``prefers_day_first``."""
    read = {}
    for n in contract.timestamps:
        day_first = F.when(F.col(_EITHER + n), F.col(_DAY_FIRST + n)).otherwise(F.col(n))
        read |= {f"{n}|False": F.count(F.col(n)), f"{n}|True": F.count(day_first)}
    return read


def reading_columns(contract: TableContract) -> list[str]:
    """What ``chosen_readings`` needs besides the columns of the contract."""
    return [_DAY_FIRST + n for n in contract.timestamps]


def chosen_readings(df: DataFrame, contract: TableContract, counts: Mapping[str, int]) -> DataFrame:
    """Each date under the better reading of its column by ``reading_measures``, or the other way if that is impossible."""
    chosen = {}
    for n in contract.timestamps:
        readings = [F.col(n), F.col(_DAY_FIRST + n)]
        chosen[n] = F.coalesce(*(reversed(readings) if counts[f"{n}|True"] > counts[f"{n}|False"] else readings))
    return df.withColumns(chosen).drop(*reading_columns(contract))


def quality_measures(typed: DataFrame, contract: TableContract) -> dict[str, Column]:
    """Aggregates of a typed table: rows, and per column the values lost and the negative values kept."""

    def value(n: str) -> Column:
        return F.coalesce(n, _DAY_FIRST + n) if _DAY_FIRST + n in typed.columns else F.col(n)

    lost = {f"lost_{n}": F.count_if(F.col(_HAD + n) & value(n).isNull()) for n in contract.headers if _HAD + n in typed.columns}
    negative = {f"negative_{n}": F.count_if(F.col(n) < 0) for n in contract.numbers}
    return {"rows": F.count(F.lit(1)), **lost, **negative}


def coercion_counts(typed: DataFrame, contract: TableContract) -> DataFrame:
    """Per column: values turned into NULL and negative values kept."""
    none = F.lit(0).cast("bigint")
    measures = quality_measures(typed, contract)
    totals = typed.agg(*[c.alias(n) for n, c in measures.items()])
    return totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        F.col("rows"),
                        (F.col(f"lost_{n}") if f"lost_{n}" in measures else none).alias("coerced"),
                        (F.col(f"negative_{n}") if f"negative_{n}" in measures else none).alias("negative"),
                    )
                    for n in contract.headers
                ]
            )
        ).alias("q")
    ).select("q.*")


def drop_null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(key)) if key else df


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of every key in the given order; rows with an incomplete key go.

    ``min_by`` combines on the map side, so a key repeated over a third of the input reaches its
    reducer as one row per task, unlike a window over the key.
    """
    if not key:
        return df
    payload = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*payload) if payload else F.lit(1), F.struct(*order_by)).alias("__first")
    kept = drop_null_keys(df, key).groupBy(*key).agg(first)
    return kept.select(*[F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in df.columns])


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def null_rate(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Missing values of a measure, as a count and in percent; ``weight`` is the rows a row stands for."""
    rows = F.col(weight) if weight else F.lit(1).cast("bigint")
    missing = F.coalesce(F.sum(F.when(F.col(column).isNull(), rows)), F.lit(0))
    return df.agg(missing.alias("null_rows"), (F.try_divide(missing, F.sum(rows)) * 100).alias("null_pct"))


def add_surrogate_key(df: DataFrame, name: str, order_by: Sequence[str] = (), dense: bool = False) -> DataFrame:
    """Give every row an id.

    Unique ids cost nothing. Dense ids from 1 need the sizes of the partitions before a row's own:
    without an order that is one count over ``df``, which must be frozen, and no shuffle.
    """
    if not dense:
        return df.withColumn(name, F.monotonically_increasing_id() + F.lit(1))
    if order_by:
        return global_row_number(df, order_by, name)
    return number_in_place(df, name)
