"""Global order without a one-partition window.

``Window.orderBy`` without a partition sorts everything in one task, and ``percentile`` merges every
distinct value in one. Here rows are range-partitioned by the ordering key, frozen, and each
partition only needs the total of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import freeze

_PART, _SLOT = "__part", "__slot"


def _ordered(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def global_row_number(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Number all rows from 1 in the given order; ``order_by`` must be unique to be reproducible.

    One range shuffle. A heavily repeated value cannot overload a partition as long as a unique
    column closes the ordering.
    """
    keys = _ordered(order_by)
    return number_in_place(freeze(df.repartitionByRange(*keys).sortWithinPartitions(*keys)), name)


def number_in_place(frozen: DataFrame, name: str) -> DataFrame:
    """Number the rows of a frozen table from 1 as they lie, partition after partition."""
    located = frozen.withColumn(_SLOT, F.monotonically_increasing_id()).withColumns(
        {_PART: F.shiftright(_SLOT, 33), _SLOT: F.col(_SLOT).bitwiseAND(F.lit((1 << 33) - 1))}
    )
    # One row per partition, whatever the size of the data.
    sizes = located.groupBy(_PART).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return (
        located.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col("__before") + F.col(_SLOT) + F.lit(1))
        .drop(_PART, _SLOT, "__before")
    )


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    totals: Mapping[str, str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running totals ``{output: input column}`` in the given order, per ``within`` group.

    Rows should be distinct in ``within + order_by`` (aggregate first), so that hot values are one
    row. A group of any size is spread over many partitions.
    """
    return _running(_place(df, order_by, within), order_by, totals, within)


def _place(df: DataFrame, order_by: Sequence[str | Column], within: Sequence[str] = ()) -> DataFrame:
    """Range-partition by group and order, and fix for good which partition a row is in."""
    keys = [F.col(c) for c in within] + _ordered(order_by)
    return freeze(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()))


def _running(
    placed: DataFrame, order_by: Sequence[str | Column], totals: Mapping[str, str], within: Sequence[str]
) -> DataFrame:
    keys = _ordered(order_by)
    sums = placed.groupBy(*within, _PART).agg(*[F.sum(col).alias(f"__sum_{out}") for out, col in totals.items()])
    chunks = Window.partitionBy(*[F.col(c) for c in within]).orderBy(_PART)
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    # Only a group that continues from an earlier partition has something before it, and a partition
    # can start inside at most one group: the table is never longer than the number of partitions.
    offsets = (
        sums.select(
            *within,
            _PART,
            F.row_number().over(chunks).alias("__chunk"),
            *[F.sum(f"__sum_{out}").over(earlier).alias(f"__before_{out}") for out in totals],
        )
        .where(F.col("__chunk") > 1)
        .select(
            *[F.col(c).alias(f"__key_{c}") for c in (*within, _PART)],
            *[f"__before_{out}" for out in totals],
        )
    )
    local = (
        Window.partitionBy(*[F.col(c) for c in within], F.col(_PART))
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same_chunk = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in (*within, _PART)]
    joined = placed.join(F.broadcast(offsets), same_chunk, "left")
    for out, col in totals.items():
        joined = joined.withColumn(
            out, F.coalesce(F.col(f"__before_{out}"), F.lit(0)) + F.sum(col).over(local)
        )
    return joined.drop(_PART, *[f"__key_{c}" for c in (*within, _PART)], *[f"__before_{out}" for out in totals])


def previous_in_group(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Add the previous ``order`` value of the same group; rows must be distinct in both columns.

    A plain window would sort a hot group in one task. Here a group may span many partitions, and
    the first row of each further chunk takes the last value of the chunk before it.
    """
    placed = _place(df, [order], [group])
    chunks = Window.partitionBy(group).orderBy(_PART)
    tails = (
        placed.groupBy(group, _PART)
        .agg(F.max(order).alias("__tail"))
        .select(group, _PART, F.lag("__tail").over(chunks).alias("__tail"))
        .where(F.col("__tail").isNotNull())
    )
    local = Window.partitionBy(group, _PART).orderBy(order)
    return (
        placed.join(F.broadcast(tails), [group, _PART], "left")
        .withColumn(name, F.coalesce(F.lag(order).over(local), F.col("__tail")))
        .drop(_PART, "__tail")
    )


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group with columns ``q0, q1, …``.

    Values are counted first, so a value held by a third of the rows is one weighted row.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    )
    placed = _place(counted, [value], by)
    ranked = _running(placed, [value], {"__upto": "__n"}, by)
    sizes = placed.groupBy(*by).agg(F.sum("__n").alias("__size"))
    if by:
        ranked = ranked.join(sizes, list(by))
    else:
        ranked = ranked.withColumn("__size", F.lit(sizes.first()["__size"]))
    first, last = F.col("__upto") - F.col("__n"), F.col("__upto")
    wanted = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("__size") - 1)
        number = F.col(value).cast("double")
        for side, at in (("low", F.floor(position)), ("high", F.ceil(position))):
            wanted.append(F.max(F.when((first <= at) & (at < last), number)).alias(f"__{side}{i}"))
        wanted.append(F.max(position - F.floor(position)).alias(f"__part{i}"))
    found = ranked.groupBy(*by).agg(*wanted)
    return found.select(
        *by,
        *[
            (
                F.col(f"__low{i}") + (F.col(f"__high{i}") - F.col(f"__low{i}")) * F.col(f"__part{i}")
            ).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def quartile_scores(df: DataFrame, key: str, scores: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Add quartile scores ``{output: (column, higher is better)}`` of the first-come rank.

    Equal-width quartiles of the rank put row ``r`` of ``n`` into ``ceil(4 (r - 1) / (n - 1))``, at
    least 1, which differs from ``ntile(4)``. Ties are broken by ``key``. Only the three rows at the
    least 1, which differs from ``ntile(4)``. Ties are broken by ``key``. The rows at the quartile borders of
    all scores are looked up in one ordered table of (score, value, key); scoring is then a comparison with
    constants, so the table itself is neither shuffled nor joined. ``df`` should be frozen or cheap: it is
    read once for the borders, and once by whoever uses the scores.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("__score"), F.col(column).cast("decimal(38,10)").alias("__value"))
            for name, (column, _) in scores.items()
        ]
    )
    long = df.select(F.explode(cells).alias("c"), F.col(key).alias("__key"), F.lit(1).cast("bigint").alias("__one"))
    placed = _place(long.select("c.*", "__key", "__one"), ["__value", "__key"], ["__score"])
    sizes = placed.groupBy("__score").agg(F.count(F.lit(1)).alias("n")).collect()
    total = max((r["n"] for r in sizes), default=0)
    borders = sorted({(q * (total - 1)) // 4 + 1 for q in (1, 2, 3)}) if total else []
    ranked = _running(placed, ["__value", "__key"], {"__rank": "__one"}, ["__score"])
    rows = {(r["__score"], r["__rank"]): r for r in ranked.where(F.col("__rank").isin(borders)).collect()}
    out = df
    for name, (column, ascending) in scores.items():
        score = F.lit(1)
        for q in (1, 2, 3):
            row = rows.get((name, (q * (total - 1)) // 4 + 1))
            if row is not None:
                value = F.lit(row["__value"]).cast("decimal(38,10)").cast(kinds[column])
                border = F.struct(value, F.lit(row["__key"]).cast(kinds[key]))
                score = score + (F.struct(F.col(column), F.col(key)) > border).cast("int")
        out = out.withColumn(name, (score if ascending else F.lit(5) - score).cast("int"))
    return out


def hashed_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """At most ``size`` rows, the same ones every time: those first in hash order.

    A hash threshold thins the rows before the top-k, so the final merge sees little more than
    ``size`` rows however large the table is.
    """
    total = df.count()
    if total <= size:
        return df
    wanted = min(1.0, (size + 8.0 * size**0.5 + 16.0) / total)
    tagged = df.withColumn("__hash", F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))))
    cut = f"{min(int(wanted * (1 << 48)), (1 << 48) - 1):012x}"
    thinned = tagged.where(F.substring("__hash", 1, 12) <= F.lit(cut))
    if thinned.count() < size:
        thinned = tagged
    return thinned.orderBy("__hash", key).limit(size).drop("__hash")
