"""Proportional stratified interleaving: every shard gets the mixture of the whole table.

The rows of a source, in seeded random order, get the fractions (rank + 1/2) / size. Sorted by
fraction the sources interleave in proportion, and any run of that order holds each source
in its share. Both ranks are taken in buckets of even size whose totals are summed up first,
so neither a source nor the whole order is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix.llm.common import fresh, offsets

BUCKET_ROWS = 4_000


def interleave(docs: DataFrame, shards: int, *, seed: int = 7, source_col: str = "source",
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless in a shard).

    Row counts of shards differ by one at most. Missing sources are a source of their own.
    The order comes from a hash of seed, id and text, so it does not depend on the layout;
    rows equal in both are interchangeable but for other columns. Columns named like the
    new ones are replaced. An empty table stays empty.
    """
    kept = docs.drop("shard", "slot")
    draw, part, before, rank, size, turn, cell, whole, n, key, key_part = (
        fresh(kept, f"_{c}") for c in "draw part before rank size turn cell all n key key_part".split())
    rows = kept.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    dealt = kept.withColumn(
        draw, F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col))
    ).withColumn(part, F.expr(f"cast(shiftrightunsigned({draw}, 34) % {buckets} as int)"))

    # rank within the source: buckets of the draw, then the draw inside a bucket
    parts = dealt.groupBy(F.col(source_col).alias(key), F.col(part).alias(key_part)).agg(F.count("*").alias(n))
    parts = offsets(parts, [key], [key_part], n, before).withColumn(
        size, F.sum(n).over(W.partitionBy(key))).drop(n)
    same = F.col(source_col).eqNullSafe(F.col(key)) & (F.col(part) == F.col(key_part))
    ranked = dealt.join(parts, same).drop(key, key_part)
    inside = W.partitionBy(source_col, part).orderBy(draw)
    ranked = ranked.withColumn(rank, F.col(before) + F.row_number().over(inside) - 1)

    # rank of the fraction over all sources, in cells of even size
    ranked = ranked.withColumn(turn, (2 * F.col(rank) + 1) / (2 * F.col(size))).withColumn(
        cell, F.least(F.lit(buckets - 1), F.floor(F.col(turn) * buckets)).cast("int")).drop(part, before, rank, size)
    cells = ranked.groupBy(F.col(cell).alias(key)).agg(F.count("*").alias(n)).withColumn(whole, F.lit(0))
    cells = offsets(cells, [whole], [key], n, before).select(key, before)
    within = W.partitionBy(cell).orderBy(turn, F.col(source_col).asc_nulls_last(), draw)
    place = F.col(before) + F.row_number().over(within) - 1
    low, more = divmod(rows, shards)
    cut = F.lit(more * (low + 1))  # the first ``more`` shards hold one row more
    at = F.col(turn)
    placed = ranked.join(cells, F.col(cell) == F.col(key)).withColumn(turn, place)
    shard = F.when(at < cut, F.expr(f"{turn} div {low + 1}")).otherwise(
        more + F.expr(f"({turn} - {more * (low + 1)}) div {max(1, low)}"))
    slot = F.when(at < cut, at % (low + 1)).otherwise((at - cut) % max(1, low))
    return placed.select(*kept.columns, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
