"""Exact ranking, selection and prefix sums without a single-task window.

A window ``row_number() OVER (PARTITION BY class ORDER BY key)`` over a two-value class label
puts half of the table into one task. The operators here keep the result exact but only ever
window over (a) a table of counts by hash prefix or by range of rows, and (b) the rows of one such
bucket, whose number follows from the row count.

Order keys are seeded MD5 hex strings (``hash_key``): uniform, deterministic under any
partitioning or retry, and reproducible by any SQL engine (the oracle orders by the same
``md5(concat_ws('|', seed, key...))``). A hex prefix is an order-preserving bucket; prefixes
are refined level by level until the bucket that holds the n-th row is small; that row's key then
serves as a literal bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import cut_lineage, written_once

UNIT_HEX = 13  # 52 bits of the hash give a uniform number in [0, 1)


def hash_key(seed: int | str, *cols: str | Column) -> Column:
    """``md5('seed|c1|c2...')`` as lower-case hex (NULLs skipped, as in SQL ``concat_ws``)."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(h: Column | str) -> Column:
    """Uniform [0, 1) from the first 52 bits of a hex hash (exact in a double)."""
    hc = F.col(h) if isinstance(h, str) else h
    return F.conv(F.substring(hc, 1, UNIT_HEX), 16, 10).cast("bigint") / F.lit(float(16 ** UNIT_HEX))


def _cumulate(counts: DataFrame, group: list[str]) -> DataFrame:
    """Per group: the bucket where the running count reaches the target, and rows still needed."""
    w = Window.partitionBy(*group).orderBy("_p") if group else Window.orderBy("_p")
    c = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return c.filter((F.col("_before") < F.col("_n")) & (F.col("_before") + F.col("_cnt") >= F.col("_n"))).select(
        *group, "_p", (F.col("_n") - F.col("_before")).alias("_need"), "_cnt"
    )


BOUNDARY_ROWS = 10_000  # a prefix bucket this small is sorted to find the boundary row


def _same(group: Sequence[str], values: Sequence) -> Column:
    """The row's group is the one given; a NULL class is a class."""
    out = F.lit(True)
    for g, v in zip(group, values):
        out = out & F.col(g).eqNullSafe(F.lit(v))
    return out


def first_n_flag(
    df: DataFrame,
    h: str,
    n: int | DataFrame | None = None,
    group: Sequence[str] = (),
    flag: str = "selected",
    tie: Sequence[str] = (),
    fraction: float | None = None,
    level_digits: int = 4,
) -> DataFrame:
    """Add boolean ``flag``: the row is among the first ``n`` rows of its group by (h, *tie).

    ``n`` is an int (same for every group), a DataFrame (group cols..., n) with one row per
    group, or ``fraction`` gives n = floor(group size × fraction). A NULL group is a group like
    any other. (h, *tie) is unique per row; rows that share it are flagged alike. The groups are
    the classes of a label: one row of each comes to the driver.

    The n-th row's key is found level by level: rows are counted by hash prefix (a partial
    aggregate; the first level gives the groups' sizes too), a running count picks the prefix that holds the n-th row, and only rows of that
    prefix are counted by the next ``level_digits`` digits, until it holds ``BOUNDARY_ROWS`` rows
    at most. The key becomes a literal, so the result is a projection of ``df``: one scan, no
    shuffle, no join, no window over data rows.
    """
    group, keys = list(group), [h, *tie]
    # the first level counts every row, so it gives the sizes of the groups too
    first = cut_lineage(df.groupBy(*group, F.substring(h, 1, level_digits).alias("_p")).agg(F.count(F.lit(1)).alias("_cnt")))
    sizes = {tuple(r[:-1]): r[-1] for r in first.groupBy(*group).agg(F.coalesce(F.sum("_cnt"), F.lit(0)).alias("_c")).collect()}
    if fraction is not None:
        want = {g: int(c * fraction) for g, c in sizes.items()}
    elif isinstance(n, int):
        want = dict.fromkeys(sizes, n)
    else:
        given = {tuple(r[:-1]): int(r[-1] or 0) for r in n.select(*group, "n").collect()}
        want = {g: given.get(g, 0) for g in sizes}
    chosen = F.lit(False)
    open_ = {g: ("", want[g], c) for g, c in sizes.items() if 0 < want[g] < c}  # prefix, rows still wanted in it, rows in it
    while any(c > BOUNDARY_ROWS and len(p) < 32 for p, _, c in open_.values()):
        todo = {g: v for g, v in open_.items() if v[2] > BOUNDARY_ROWS and len(v[0]) < 32}
        width, digits = F.lit(None), F.lit(None)
        level = all(p == "" for p, _, _ in todo.values())  # the first one, counted above
        for g, (p, need, _) in todo.items():
            here = _same(group, g) if level else _same(group, g) & F.col(h).startswith(p)
            if not level:
                digits = F.when(here, F.substring(h, 1, min(32, len(p) + level_digits))).otherwise(digits)
            width = F.when(here, F.lit(need).cast("bigint")).otherwise(width)
        if level:
            counts = first.select(*group, F.when(width.isNotNull(), F.col("_p")).alias("_p"), width.alias("_n"), "_cnt").filter("_p IS NOT NULL")
        else:
            counts = df.groupBy(*group, digits.alias("_p"), width.alias("_n")).agg(F.count(F.lit(1)).alias("_cnt")).filter("_p IS NOT NULL")
        for r in _cumulate(counts, group).select(*group, "_p", "_need", "_cnt").collect():
            open_[tuple(r[:-3])] = (r["_p"], r["_need"], r["_cnt"])
    if open_:
        # the boundary rows of all groups by one run of df; a bucket holds BOUNDARY_ROWS at most, or rows of one hash
        need = F.lit(None).cast("bigint")
        for g, (p, k, _) in open_.items():
            need = F.when(_same(group, g) & F.col(h).startswith(p), F.lit(int(k)).cast("bigint")).otherwise(need)
        w = Window.partitionBy(*group).orderBy(*keys)
        edges = df.select(*group, *[c for c in keys if c not in group], need.alias("_need")).filter("_need IS NOT NULL")
        edges = edges.withColumn("_rn", F.row_number().over(w)).filter("_rn = _need").select(*group, *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
        for r in edges.collect():
            g, edge = tuple(r[: len(group)]), tuple(r[len(group) :])
            at_most = F.struct(*[F.col(k) for k in keys]) <= F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, edge)])
            chosen = F.when(_same(group, g), at_most).otherwise(chosen)
    for g, c in sizes.items():
        if want[g] >= c:
            chosen = F.when(_same(group, g), F.lit(True)).otherwise(chosen)
    return df.withColumn(flag, chosen)


def first_n(df: DataFrame, h: str, n: int | DataFrame, group: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """Rows among the first n of their group by hash order (M4, O7 with a hash order)."""
    return first_n_flag(df, h, n, group, "_sel", tie).filter("_sel").drop("_sel")


def fraction_sample(df: DataFrame, h: str, fraction: float | Column) -> DataFrame:
    """M5: Bernoulli-like sample by hash: keep rows whose hash unit is below ``fraction``."""
    fr = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return df.filter(hash_unit(h) < fr)


ROWS_A_PART = 100_000


def _in_parts(df: DataFrame, order: str, n_buckets: int | None) -> DataFrame:
    """The rows in ranges of ``order``, with the number of their range as ``_bk``.

    The number of ranges follows from the row count, so a range holds about ``ROWS_A_PART`` rows at any size, wherever
    the values lie. Range bounds are sampled anew by each run of the plan, so rows and numbers are written
    to the checkpoint folder once: all readers see the same ranges, also after a lost executor.
    """
    if n_buckets is None:
        n_buckets = max(1, -(-df.count() // ROWS_A_PART))
    return cut_lineage(df.repartitionByRange(n_buckets, order).withColumn("_bk", F.spark_partition_id()))


def dense_index(df: DataFrame, order: str | Column, name: str = "idx", n_buckets: int | None = None) -> DataFrame:
    """0-based dense position of every row by a unique ``order`` of any sortable type.

    Rows are shuffled once, into sorted ranges of about ``ROWS_A_PART``, and written with the number of their range and
    their place there; the counts of the ranges, one row each, give exact offsets. All readers see the same ranges.
    """
    if n_buckets is None:
        n_buckets = max(1, -(-df.count() // ROWS_A_PART))
    ranges = df.repartitionByRange(n_buckets, order).sortWithinPartitions(order)
    parts = written_once(ranges.withColumn("_at", F.monotonically_increasing_id()), "index")  # range << 33 | place
    bk = F.shiftright("_at", 33)
    counts = parts.groupBy(bk.alias("_bk")).agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_bk", F.coalesce(F.sum("_c").over(Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = parts.withColumn("_bk", bk).join(F.broadcast(offs), "_bk")
    out = j.withColumn(name, (F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")).drop("_bk", "_off", "_at")
    out.written_to = parts.written_to
    return out


def prefix_sums(df: DataFrame, order: str, values: Sequence[str], exclusive: bool = True, n_buckets: int | None = None) -> DataFrame:
    """Running sums of ``values`` in ``order`` (unique per row), as ``cum_<v>`` columns.

    A distributed scan: ranges of rows, a total for each range, running totals of these joined back, and a
    window inside each range. The number of ranges grows with the rows (``_in_parts``), so no window is over more
    than about ``ROWS_A_PART`` rows, but the one over the ranges' totals (one row a range).
    ``exclusive`` sums the rows strictly before; otherwise up to and including the row.
    """
    parts = _in_parts(df, order, n_buckets)
    tot = parts.groupBy("_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wt = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_bk", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}") for v in values])
    w = Window.partitionBy("_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    inside = parts.withColumns({f"cum_{v}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values})
    out = inside.join(offs, "_bk")
    return out.withColumns({f"cum_{v}": F.col(f"cum_{v}") + F.col(f"_o_{v}") for v in values}).drop("_bk", *[f"_o_{v}" for v in values])
