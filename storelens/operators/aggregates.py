"""Grouped summaries: value counts, shares, equal-width histograms,
weighted means."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.sql import ident
from storelens.functions.sql import project


SHARE_GROUPS = 16


def value_counts(df: DataFrame, column: str, weight: str | None = None,
                 out: str = "n") -> DataFrame:
    """Count (or summed integer weight) per non-NULL value of ``column``,
    largest first, ties by value."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(F.col(weight))
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(agg.cast("bigint").alias(out))
            .orderBy(F.col(out).desc(), F.col(column).asc_nulls_last()))


def with_share(grouped: DataFrame, count_col: str = "n", out: str = "share") -> DataFrame:
    """Share of the total per row.  The total is a lazy scalar subquery
    (partial sums per task, one number back), so rows are never gathered
    into one task and no cross join is planned."""
    total = grouped.select(F.sum(F.col(count_col))).scalar()
    return grouped.withColumn(out, F.try_divide(F.col(count_col), total))


def share_of_total(df: DataFrame, label: str, weight: str, count_col: str = "n",
                   out: str = "share") -> DataFrame:
    """Summed integer weight per non-NULL ``label`` and its share of the total.
    Labels and total come from one ROLLUP, so from one shuffle of one run of
    the view.  The total's row then goes to each of ``SHARE_GROUPS`` groups of
    labels: no group gathers them all, however many labels there are."""
    rolled = (df.where(F.col(label).isNotNull()).rollup(label)
              .agg(F.expr(f"CAST(sum({ident(weight)}) AS BIGINT)").alias(count_col),
                   F.expr("max(grouping_id())").alias("_level")))
    groups = F.when(F.col("_level") == 1, F.sequence(F.lit(0), F.lit(SHARE_GROUPS - 1))).otherwise(
        F.array(F.pmod(F.hash(label), F.lit(SHARE_GROUPS))))
    dealt = rolled.withColumn("_group", F.explode(groups))
    total = F.max(F.when(F.col("_level") == 1, F.col(count_col))).over(Window.partitionBy("_group"))
    return dealt.withColumn("_total", total).where("_level = 0").select(
        label, count_col, F.try_divide(F.col(count_col), F.col("_total")).alias(out))


def equal_width_histogram(df: DataFrame, column: str, bins: int = 20,
                          lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Counts in ``bins`` equal bins over [lo, hi]; the last bin is closed,
    values outside are clamped into the edge bins, NULLs are dropped.
    Output: bin, bin_start, bin_end, n (non-empty bins only).

    For [0, 1] the arithmetic reduces exactly to ``floor(x * bins)`` and
    ``bin / bins``, so edges are not accumulated sums of a rounded width."""
    x = ident(column)
    span, base = f"CAST({float(hi - lo)!r} AS DOUBLE)", f"CAST({float(lo)!r} AS DOUBLE)"
    b = f"greatest(least(floor(({x} - {base}) / {span} * {bins}), {bins - 1}L), 0L)"
    return (df.where(f"{x} IS NOT NULL")
            .groupBy(F.expr(b).alias("bin"))
            .agg(F.expr("count(1)").alias("n"))
            .transform(project, "bin", f"{base} + bin * {span} / {bins} AS bin_start",
                       f"{base} + (bin + 1) * {span} / {bins} AS bin_end", "n"))


def weighted_mean(value: str, weight: str) -> Column:
    """sum(value * weight) / sum(weight where value is not NULL) — the mean
    over ``weight`` copies of each row, computed without the copies."""
    v, w = ident(value), ident(weight)
    return F.expr(f"try_divide(sum({v} * {w}), sum(CASE WHEN {v} IS NOT NULL THEN {w} END))")


def weighted_sum(value: str, weight: str) -> Column:
    """sum(value * weight) of integers as DECIMAL(38, 0), 0 when there is
    nothing to add (pandas rule).  Installs times frame rows pass BIGINT long
    before they pass 38 digits."""
    v, w = (f"CAST({ident(x)} AS DECIMAL(19, 0))" for x in (value, weight))
    return F.expr(f"CAST(coalesce(sum({v} * {w}), 0) AS DECIMAL(38, 0))")


def rounded_mean(value: str, weight: str, digits: int, scale: int = 6) -> Column:
    """Mean of ``value`` over ``weight`` copies, rounded half away from zero
    to ``digits`` decimals, computed exactly: each value is taken as an
    integer number of 10**-scale units, the weighted sums are exact decimals
    and the one division is an integer division.  The result does not depend
    on summation order (a plain double mean can land on either side of a
    rounding half when rows are summed in a different order)."""
    if not 0 <= digits <= scale:
        raise ValueError("need 0 <= digits <= scale")
    v, w = ident(value), ident(weight)
    # units of larger values might not fit; a mean that has one is a plain
    # double mean (such doubles have no decimals to round exactly)
    large = f"abs({v}) >= 1e15D AND abs({v}) < CAST('Infinity' AS DOUBLE)"
    plain = (f"round(sum(CASE WHEN abs({v}) < CAST('Infinity' AS DOUBLE) THEN {v} * {w} END) "
             f"/ sum(CASE WHEN abs({v}) < CAST('Infinity' AS DOUBLE) THEN {w} END), {digits})")
    finite = f"CASE WHEN abs({v}) < 1e15D THEN {v} END"
    units = f"CAST(round({finite} * {10 ** scale}D) AS DECIMAL(38, 0))"
    total = f"sum({units} * CAST({w} AS DECIMAL(38, 0)))"
    # exactly the rows that are summed: a non-finite value is in neither
    count = f"CAST(sum(CASE WHEN {units} IS NOT NULL THEN {w} END) AS DECIMAL(38, 0))"
    step = 10 ** (scale - digits)
    half_up = f"((2 * abs({total}) + {count} * {step}) div (2 * {count} * {step}))"
    return F.expr(
        f"CASE WHEN count_if({large}) > 0 THEN {plain} WHEN {count} > 0 THEN "
        f"CAST(CASE WHEN {total} < 0 THEN -{half_up} ELSE {half_up} END AS DOUBLE) "
        f"/ {10 ** digits}D END")


def exact_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None,
               out: str = "mean") -> DataFrame:
    """Rows (keys, n, ``out``): the mean of any doubles over ``weight`` copies of
    each row, free of the order of summation: the double nearest to the exact
    mean.  NULL and non-finite values are left out; a group of none (or of
    weight 0) has n = 0 and a NULL mean.

    A double is a whole number times a power of two.  Sums of the whole numbers
    are exact decimals, one per group and power (2,100 at most, so a partial
    aggregation combines a hot group in every task); a group's few sums are
    put together in big integers at the end."""
    v = ident(value)
    finite = f"abs({v}) < CAST('Infinity' AS DOUBLE)"
    # one bit more than a double has: log2 may be one off next to a power of two
    power = f"greatest(coalesce(CAST(floor(log2(nullif(abs({v}), 0D))) AS INT) - 53, 0), -1074)"
    # in two steps, as the whole scale may be no double; powers of two are exact
    whole = ("CAST(_v * pow(2D, CAST(-_power div 2 AS DOUBLE))"
             " * pow(2D, CAST(-_power - (-_power div 2) AS DOUBLE)) AS BIGINT)")
    rows = df.selectExpr(*map(ident, keys), f"CASE WHEN {finite} THEN {v} END AS _v",
                         f"CASE WHEN {finite} THEN {power} END AS _power",
                         f"CAST({'1' if weight is None else ident(weight)} AS DECIMAL(19, 0)) AS _w")
    sums = rows.groupBy(*keys, "_power").agg(
        F.expr(f"sum(CAST({whole} AS DECIMAL(19, 0)) * _w)").alias("_sum"),
        F.expr("sum(CASE WHEN _v IS NOT NULL THEN _w END)").alias("_w"))

    columns = [*keys, "n"]

    def put_together(batches):
        from fractions import Fraction

        for batch in batches:
            means = []
            for some, count in zip(batch["_parts"].to_pylist(), batch["_n"].to_pylist(), strict=True):
                total = sum(Fraction(int(x["_sum"])) * Fraction(2) ** x["_power"] for x in some)
                means.append(float(total / int(count)) if count else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(means, pa.float64())],
                                             names=[*columns, out])

    parts = F.collect_list(F.when(F.col("_sum").isNotNull(), F.struct("_power", "_sum")))
    groups = (sums.groupBy(*keys).agg(parts.alias("_parts"), F.sum("_w").alias("_n"))
              .select(*keys, F.expr("CAST(coalesce(_n, 0) AS BIGINT)").alias("n"), "_parts", "_n"))
    schema = ", ".join(f"{ident(c)} {groups.schema[c].dataType.simpleString()}" for c in columns)
    return groups.mapInArrow(put_together, f"{schema}, {ident(out)} double")
