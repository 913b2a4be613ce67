"""Exact seeded samples and splits.

Rows are ordered by ``md5(seed:id)``. To take the first m rows of a stratum without
sorting it in one task, the order is cut into cells by the leading hex digits: counting
cells shows which cell holds rank m, the same is done inside that cell with the next
digits, and only the few rows left are sorted. The result is one threshold per cut, and
rows are then assigned by comparing with it, with no shuffle of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import order_key, turn_in_table, whole_table
from cohortix.session import frame_of, small_side

DIGITS = 4
SORT_ROWS = 1_000


def cell_levels(n: int, sort_rows: int = SORT_ROWS) -> int:
    levels = 0
    while n > sort_rows and levels < 32 // DIGITS:
        n //= 16 ** DIGITS
        levels += 1
    return levels


def rank_cuts(
    df: DataFrame,
    ranks: DataFrame,
    *,
    strata: Sequence[str],
    seed: int = S.SEED,
    id_col: str = S.ID,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """The order key and id at each rank: ``ranks(strata.., n, rank)`` -> ``strata.., rank, k, i``.

    ``n`` is the size of the stratum. Each level of cells divides what one task has to
    sort by 65,536, and levels are added until that is about ``sort_rows``.
    """
    rows = df.select(*strata, F.col(id_col).alias("i"), order_key(id_col, seed).alias("k"))
    # Two ranks of a stratum may fall into one cell, so cells are followed per rank.
    wanted = small_side(ranks.select(*strata, "n", "rank", F.col("rank").alias("left")))
    largest = wanted.agg(F.max("n")).first()[0] or 0
    wanted = wanted.drop("n")
    path = list(strata)
    for level in range(cell_levels(largest, sort_rows)):
        cell = f"c{level}"
        rows = rows.withColumn(cell, F.substring("k", level * DIGITS + 1, DIGITS))
        cells = (
            rows.groupBy(*path, cell).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(W.partitionBy(*path).orderBy(cell)))
        )
        wanted = small_side(
            cells.join(wanted, path)
            .where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
            .select(*path, cell, "rank", (F.col("left") - F.col("upto") + F.col("n")).alias("left"))
        )
        path.append(cell)
        rows = rows.join(wanted.select(*path).distinct(), path, "left_semi")
    return (
        rows.withColumn("at", F.row_number().over(W.partitionBy(*path).orderBy("k", "i")))
        .join(wanted, path)
        .where(F.col("at") == F.col("left"))
        .select(*strata, "rank", "k", "i")
    )


def cut_lists(cuts: DataFrame, strata: Sequence[str]) -> DataFrame:
    points = F.sort_array(F.collect_list(F.struct("k", "i"))).alias("cuts")
    return cuts.groupBy(*strata).agg(points)


def part_of(
    df: DataFrame,
    ranks: DataFrame,
    out: str,
    *,
    strata: Sequence[str],
    seed: int = S.SEED,
    id_col: str = S.ID,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Add the 0-based part of each row: how many cuts of its stratum lie before it."""
    cuts = small_side(cut_lists(
        rank_cuts(df, ranks, strata=strata, seed=seed, id_col=id_col, sort_rows=sort_rows), strata))
    most = cuts.agg(F.max(F.size("cuts"))).first()[0] or 0
    me = F.struct(order_key(id_col, seed).alias("k"), F.col(id_col).alias("i"))
    part = F.lit(0)
    for j in range(most):
        part = part + F.coalesce((F.col("me") > F.get("cuts", F.lit(j))).cast("int"), F.lit(0))
    return (
        df.join(cuts, list(strata), "left").withColumn("me", me)
        .withColumn(out, F.when(F.col("cuts").isNull(), F.lit(None)).otherwise(part))
        .drop("cuts", "me")
    )


def stratum_sizes(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))


def holdout_size(n: Column, fraction: float = S.HOLDOUT_FRACTION) -> Column:
    """Half-even rounding, at least one row."""
    return F.greatest(F.bround(n * F.lit(fraction)).cast("long"), F.lit(1))


def assign_holdout(
    df: DataFrame, fraction: float = S.HOLDOUT_FRACTION, seed: int = S.SEED,
    strata: Sequence[str] = (S.SEGMENT,), id_col: str = S.ID, sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Stratified random control group: ``campaign_group`` is UCG or UTG."""
    ranks = stratum_sizes(df, strata).select(
        *strata, "n", holdout_size(F.col("n"), fraction).alias("rank"))
    marked = part_of(df, ranks, "part", strata=strata, seed=seed, id_col=id_col, sort_rows=sort_rows)
    group = F.when(F.col("part") == 0, F.lit(S.CONTROL)).otherwise(F.lit(S.TARGET))
    return marked.withColumn(S.GROUP, group).drop("part")


def test_sizes(df: DataFrame, strata: Sequence[str], fraction: float) -> DataFrame:
    """Rows per stratum of a test set of ``ceil(fraction * n)`` by largest remainder."""
    sizes = small_side(stratum_sizes(df, strata))
    total = F.sum("n").over(whole_table())
    target = F.ceil(total * F.lit(fraction))
    share = F.col("n") * target / total
    by_remainder = turn_in_table(F.col("rest").desc(), *strata)
    return (
        sizes.withColumn("target", target)
        .withColumn("base", F.floor(share)).withColumn("rest", F.round(share - F.floor(share), 9))
        .withColumn("short", F.col("target") - F.sum("base").over(whole_table()))
        .withColumn("turn", F.row_number().over(by_remainder))
        .select(*strata, "n",
                (F.col("base") + (F.col("turn") <= F.col("short")).cast("long")).alias("rank"))
    )


def stratified_split(
    df: DataFrame, fraction: float = S.TEST_FRACTION, seed: int = S.SEED,
    strata: Sequence[str] = (S.CHURN,), id_col: str = S.ID, out: str = "is_test",
) -> DataFrame:
    """Add a boolean test flag; the split is a column, so it never has to be re-derived."""
    ranks = test_sizes(df, strata, fraction).where("rank > 0")
    marked = part_of(df, ranks, out, strata=strata, seed=seed, id_col=id_col)
    return marked.withColumn(out, F.coalesce(F.col(out) == 0, F.lit(False)))


def stratified_folds(
    df: DataFrame, folds: int = S.CV_FOLDS, seed: int = S.SEED,
    strata: Sequence[str] = (S.CHURN,), id_col: str = S.ID, out: str = "fold",
) -> DataFrame:
    """Shuffled k-fold ids 0..k-1, sizes within a stratum differing by at most one."""
    n, k = F.col("n"), F.lit(folds)
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(folds - 1)),
        lambda j: F.floor(n / k) * j + F.least(j.cast("long"), n % k))
    ranks = (
        stratum_sizes(df, strata)
        .select(*strata, "n", F.explode(F.array_distinct(ends)).alias("rank")).where("rank > 0")
    )
    return part_of(df, ranks, out, strata=strata, seed=seed, id_col=id_col)


def exact_sample(
    df: DataFrame, rows: int, seed: int = S.SEED, id_col: str = S.ID
) -> DataFrame:
    """Exactly ``rows`` rows without replacement; the whole table if it has no more."""
    n = df.count()
    if n <= rows:
        return df
    whole = df.withColumn("whole", F.lit(0))
    ranks = frame_of(df.sparkSession, [(0, n, rows)], "whole int, n long, rank long")
    marked = part_of(whole, ranks, "part", strata=("whole",), seed=seed, id_col=id_col)
    return marked.where("part = 0").drop("part", "whole")
