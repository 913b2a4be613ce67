import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators import sample


def key(i, seed=S.SEED):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def people(spark):
    """A third of the rows and more sit in one segment."""
    return spark.range(3000).selectExpr(
        "id customer_id",
        "case when id % 10 < 7 then 'hot' when id % 10 < 9 then 'mid' else 'rare' end segment",
        "cast(id % 4 = 0 as int) churn").cache()


def members(people, col):
    out = {}
    for r in people.collect():
        out.setdefault(r[col], []).append(r[S.ID])
    return {g: sorted(ids, key=key) for g, ids in out.items()}


def test_cell_levels_bound_the_sort():
    assert sample.cell_levels(1000, 200_000) == 0
    assert sample.cell_levels(10**9, 200_000) == 1
    assert sample.cell_levels(10**12, 200_000) == 2


@pytest.mark.parametrize("sort_rows", [1, 10**6])
def test_cuts_are_the_order_statistics(spark, people, sort_rows):
    groups = members(people, S.SEGMENT)
    wanted = [(g, len(ids), rank) for g, ids in groups.items() for rank in (1, 7, len(ids) // 2, len(ids))]
    ranks = spark.createDataFrame(wanted, "segment string, n long, rank long")
    got = sample.rank_cuts(people, ranks, strata=(S.SEGMENT,), sort_rows=sort_rows).collect()
    assert {(r["segment"], r["rank"]): r["i"] for r in got} == {
        (g, rank): groups[g][rank - 1] for g, _, rank in wanted}


def test_holdout_is_exact_per_segment(people):
    out = sample.assign_holdout(people)
    got = Counter((r[S.SEGMENT], r[S.GROUP]) for r in out.collect())
    for g, ids in members(people, S.SEGMENT).items():
        assert got[g, S.CONTROL] == max(1, round(len(ids) * S.HOLDOUT_FRACTION))
    control = {r[S.ID] for r in out.where(F.col(S.GROUP) == S.CONTROL).collect()}
    assert control == {i for ids in members(people, S.SEGMENT).values()
                       for i in ids[:max(1, round(len(ids) * 0.03))]}


def test_holdout_rounds_half_to_even_and_never_empties(spark):
    sizes = spark.createDataFrame([(50,), (150,), (250,), (3,)], "n long")
    assert [r[0] for r in sizes.select(sample.holdout_size(F.col("n"))).collect()] == [2, 4, 8, 1]


def test_assignment_ignores_partitioning(people):
    a = sample.assign_holdout(people).where(f"{S.GROUP} = 'UCG'")
    b = sample.assign_holdout(people.repartition(7, "churn")).where(f"{S.GROUP} = 'UCG'")
    assert {r[S.ID] for r in a.collect()} == {r[S.ID] for r in b.collect()}


def test_seeds_give_different_groups(people):
    a, b = (sample.assign_holdout(people, seed=s).where(f"{S.GROUP} = 'UCG'") for s in (1, 2))
    assert {r[S.ID] for r in a.collect()} != {r[S.ID] for r in b.collect()}


def test_split_is_stratified_and_whole(people):
    out = sample.stratified_split(people.where("customer_id < 2997"))
    assert out.count() == 2997
    assert out.where("is_test").count() == math.ceil(2997 * 0.2)
    rates = {r["is_test"]: r["rate"] for r in out.groupBy("is_test").agg(F.avg("churn").alias("rate")).collect()}
    assert rates[True] == pytest.approx(rates[False], abs=2e-3)


def test_folds_are_even_within_each_label(people):
    got = Counter((r[S.CHURN], r["fold"]) for r in sample.stratified_folds(people, 7).collect())
    for label in (0, 1):
        sizes = [got[label, f] for f in range(7)]
        assert max(sizes) - min(sizes) <= 1


def test_fewer_rows_than_folds(spark):
    few = spark.range(3).selectExpr("id customer_id", "1 churn")
    assert sorted(r["fold"] for r in sample.stratified_folds(few, 5).collect()) == [0, 1, 2]


def test_exact_sample(people):
    assert sample.exact_sample(people, 5000).count() == 3000
    got = {r[S.ID] for r in sample.exact_sample(people, 123).collect()}
    assert got == set(sorted(range(3000), key=key)[:123])
