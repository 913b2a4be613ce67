"""Mix sources to target weights from fixed-length blocks of words.

The words of a source, document after document, form a stream that is cut into blocks of a
fixed length. The target of a source says how many slots it fills over all output shards;
each shard draws its counts from the multinomial distribution of what the sources have left,
so the totals are met. Slot j of a source takes the block to which a keyed permutation of
its block numbers sends j, once around after another, and the last slot takes only the words
still missing. Slots and blocks are joined by block number.

Sources are rows of a table, however many there are. The driver sees two sums per round of the
targets and the slots of groups of ``GROUP`` sources; a multinomial draw among all sources is one
among the groups followed by one inside each group, which a task makes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import WORD, filled, fresh, give_back, offsets, ready, sole_cache
from cohortix.session import frame_of, written

BLOCK_WORDS = 512
SHARDS = 64
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
GROUP = 1_000
BUCKET_ROWS = 4_000
ROUNDS = 6
STRETCH = 1 << 16


@dataclass(frozen=True)
class Source:
    """What the slots of a source depend on: its words, how many the mix takes, its blocks."""

    number: int
    size: int
    words: int
    blocks: int


def draw_counts(slots: Sequence[int], needs: Sequence[int], seed: int | Sequence[int]) -> np.ndarray:
    """``counts[shard, source]``: multinomial draws from the slots each source has left.

    A shard draws as many slots as it ``needs``. A draw above what a source has left is cut
    and drawn anew among the others, so the columns add up to ``slots`` if the needs do.
    """
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    counts = np.zeros((len(needs), len(left)), np.int64)
    for shard, need in enumerate(needs):
        while need:
            drawn = np.minimum(rng.multinomial(need, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            need -= int(drawn.sum())
    return counts


def shard_counts(slots: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """``draw_counts`` for shards of equal lengths up to one slot."""
    total = sum(slots)
    return draw_counts(slots, [total * (k + 1) // shards - total * k // shards for k in range(shards)], seed)


def mix(docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        limit: int = LIMIT, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 11,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        ) -> tuple[DataFrame, DataFrame]:
    """``(documents, draws)`` of the mix.

    ``documents`` has every row of ``docs`` as ``doc_id, source, hash`` with ``size`` (words of the
    text, none if missing), ``source_size``, ``target`` of its source, and ``start``, the words
    of its source before it (null without words). ``draws`` has one row per document piece that a slot takes:
    ``source, start`` name the document, ``first`` and ``words`` the piece (word numbers within the
    document), ``round`` how often the source was gone through before, ``shard`` and ``slot``
    the place in the mix, slots from 0 in each shard's stretch of the source.

    Sources weigh ``weights`` in turn, by code point, missing source last. Repeated rows are
    documents of their own; a table without words gives targets of 0 and no draws.
    """
    text = filled(text_col)
    words = F.when(F.col(text_col).isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD)))
    sized = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.xxhash64(text).alias("hash"), words.cast("long").alias("size")), "sizes")
    plan = plan_sources(sized, weights, share, limit, block_words)
    rows = plan.agg(F.sum("rows")).first()[0] or 0
    documents = written(_starts(sized, plan, max(1, -(-rows // BUCKET_ROWS))).withColumn(
        "start", F.when(F.col("size") > 0, F.col("start"))), "mix-documents")

    slots = _slots(plan, block_words, shards, seed)
    covered = documents.where("size > 0").withColumn("block", F.explode(F.expr(
        f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    first = F.greatest(F.col("start"), F.col("block") * block_words)
    last = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("take"))
    draws = covered.join(slots.hint("merge"), ["source_number", "block"]).withColumn("from", first).withColumn(
        "words", last - F.col("from")).where("words > 0").select(
        "source", "source_number", "start", (F.col("from") - F.col("start")).alias("first"), "words", "round", "shard", "slot")
    return documents, draws


def plan_sources(sized: DataFrame, weights: Sequence[float], share: float, limit: float,
                 block_words: int) -> DataFrame:
    """The sources of ``sized`` (``source, size``), numbered from 0 in code point order, missing last.

    A row per source: ``source_number, name, rows, source_size``, the ``target``, the whole ``words``
    of it, ``blocks`` and ``slots``. Targets are shares of ``share`` times all sizes by weight,
    none above ``limit`` times its size; what lies above goes to the others by weight.
    """
    names = written(sized.groupBy(F.col("source").alias("name")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")), "source-sizes")
    turns = F.array(*(F.lit(float(w)) for w in weights))
    sources = _numbered(names).withColumn(
        "weight", F.element_at(turns, (F.col("source_number") % len(weights)).cast("int") + 1))
    sources = written(sources, "sources")

    size, words, blocks = F.col("source_size"), F.col("words"), F.col("blocks")
    target = F.when(size > 0, F.least(F.lit(float(limit)) * size, _level(sources, share, limit))).otherwise(0.0)
    # the slots that surely hold the rest of the words, should the short last block be among them
    short = size % block_words
    rest = F.col("rest") + F.when(short > 0, block_words - short).otherwise(0)
    last = F.when(F.col("rest") > 0, F.least(blocks, F.ceil(rest / block_words))).otherwise(0)
    full = F.when(size > 0, F.floor(words / size)).otherwise(0)
    planned = sources.withColumn("target", target).withColumns({
        "words": F.rint("target").cast("long"), "blocks": F.ceil(size / block_words)}).withColumn(
        "rest", F.when(size > 0, words % size).otherwise(0))
    return written(planned.withColumn("slots", full * blocks + last).drop("weight", "rest"), "source-plan")


def _numbered(names: DataFrame) -> DataFrame:
    """Add ``source_number``: ranges of names are numbered apart, their sizes summed up first."""
    from pyspark.sql import Window as W

    order = F.col("name").asc_nulls_last()
    ranges = max(1, -(-names.count() // BUCKET_ROWS))
    parted = written(names.repartitionByRange(ranges, order).withColumn("range", F.spark_partition_id()), "source-ranges")
    before = offsets(parted.groupBy("range").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)),
                     ["all"], ["range"], "n", "before").select("range", "before")
    place = F.row_number().over(W.partitionBy("range").orderBy(order)) - 1
    return parted.join(before, "range").withColumn("source_number", F.col("before") + place).drop("range", "before")


def _level(sources: DataFrame, share: float, limit: float) -> Column:
    """What a source gets by its weight when those above their limit are held to it.

    The level only rises, so sources once above it stay there; rounds end when no more are.
    """
    size, weight = F.col("source_size"), F.col("weight")
    filled_sources = sources.where(size > 0)
    totals = filled_sources.agg(F.sum(size), F.sum(weight)).first()
    all_words, all_weight = totals[0] or 0, totals[1] or 0.0
    left, free, held = share * all_words, all_weight, 0
    while free > 0:
        over = F.lit(float(left)) * weight / F.lit(float(free)) > F.lit(float(limit)) * size
        row = filled_sources.where(over).agg(F.count("*"), F.sum(size), F.sum(weight)).first()
        if row[0] <= held:
            return F.lit(float(left)) * weight / F.lit(float(free))
        held, left, free = row[0], share * all_words - limit * row[1], all_weight - row[2]
    return F.lit(float("inf"))


def _starts(sized: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    """Add number, size and target of the source, and ``start``, the words of the source before
    a row, in the order of a hash.

    A bucket holds few rows of a source; the totals of the buckets are summed up first and
    carry what is known of the source, so rows are never joined by the source alone.
    """
    from pyspark.sql import Window as W

    spread = sized.withColumn("draw", F.xxhash64("doc_id", "hash")).withColumn(
        "part", F.pmod(F.col("draw"), F.lit(buckets)).cast("int"))
    parts = spread.groupBy("source", "part").agg(F.sum("size").alias("n"))
    known = plan.select("name", "source_number", "source_size", "target")
    parts = offsets(parts, ["source"], ["part"], "n", "before").join(
        known, F.col("source").eqNullSafe(F.col("name"))).select(
        F.col("source").alias("s"), F.col("part").alias("p"), "before", "source_number", "source_size", "target")
    inside = W.partitionBy("source", "part").orderBy("draw", "doc_id", "hash").rowsBetween(W.unboundedPreceding, -1)
    joined = spread.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return joined.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).select(
        "doc_id", "source", "hash", "size", "source_size", "target", "start", "source_number")


class Permutation:
    """A keyed permutation of 0 to ``n`` - 1: a Feistel network over pairs, walked until it is inside."""

    def __init__(self, n: int, key: int):
        self.n, self.key = n, np.uint64(key & (1 << 64) - 1)
        self.a = np.uint64(max(1, int(np.ceil(np.sqrt(n)))))
        self.b = np.uint64(-(-n // int(self.a)))

    def _mix(self, round_: int, half: np.ndarray) -> np.ndarray:
        """The finishing steps of SplitMix64 over key, round and half."""
        x = half + self.key + np.uint64((round_ + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x // self.b, x % self.b
        for i in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
            if i % 2:
                step = self._mix(i, left) % self.b
                right = (right + (self.b - step if back else step)) % self.b
            else:
                step = self._mix(i, right) % self.a
                left = (left + (self.a - step if back else step)) % self.a
        return left * self.b + right

    def __call__(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = self._once(np.asarray(x, np.uint64), back)
            while (outside := out >= np.uint64(self.n)).any():
                out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)


def slots_of(source: Source, begin: int, n: int, block_words: int, seed: int) -> dict[str, np.ndarray]:
    """``block, take, round`` of the slots ``begin`` to ``begin + n - 1`` of a source.

    ``take`` is how many words, from the start of its block, a slot takes; the last round
    ends when the words of the target are reached, so its last slots may take none.
    """
    j = np.arange(begin, begin + n, dtype=np.int64)
    rounds, turn = j // source.blocks, j % source.blocks
    block, take = np.empty(n, np.int64), np.empty(n, np.int64)
    short = source.blocks * block_words - source.size
    for r in np.unique(rounds).tolist():
        here = rounds == r
        order = Permutation(source.blocks, (seed << 40) ^ (source.number << 16) ^ r)
        block[here] = order(turn[here])
        last = int(order(np.array([source.blocks - 1]), back=True)[0])
        before = turn[here] * block_words - np.where(turn[here] > last, short, 0)
        held = block_words - np.where(block[here] == source.blocks - 1, short, 0)
        wanted = min(source.size, source.words - r * source.size)
        take[here] = np.clip(wanted - before, 0, held)
    return {"block": block, "take": take, "round": rounds}


def _slots(plan: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """One row per slot of the mix, made by the executors from one row per shard and source."""
    spark = plan.sparkSession
    ready(spark)
    grouped = plan.where("slots > 0").withColumn("group", F.floor(F.col("source_number") / GROUP))
    # a row per GROUP sources
    totals = grouped.groupBy("group").agg(F.sum("slots").alias("slots")).orderBy("group").toArrow()
    counts = shard_counts(totals["slots"].to_pylist(), shards, seed)
    needs = frame_of(spark, [(g, counts[:, i].tolist()) for i, g in enumerate(totals["group"].to_pylist())],
                     "group long, needs array<long>")
    members = grouped.groupBy("group").agg(F.sort_array(F.collect_list(F.struct(
        "source_number", "source_size", "words", "blocks", "slots"))).alias("sources"))
    stretches = members.join(needs, "group").select("group", "sources", "needs").mapInArrow(
        _group_draws(seed), "source_number long, source_size long, words long, blocks long, shard int, begin long, n long")
    pieces = stretches.withColumn("at", F.explode(F.expr(f"sequence(0L, n - 1, {STRETCH}L)")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, size, words, blocks, shard, begin, n, at in zip(*(c.to_pylist() for c in batch.columns)):
                length = min(STRETCH, n - at)
                found = slots_of(Source(number, size, words, blocks), begin + at, length, block_words, seed)
                columns = {"source_number": np.full(length, number, np.int64), "shard": np.full(length, shard, np.int32),
                           "slot": np.arange(at, at + length), **found}
                yield pa.RecordBatch.from_pydict(columns)

    return pieces.repartition("source_number", "shard", "at").mapInArrow(
        spread, "source_number long, shard int, slot long, block long, take long, round long").where("take > 0")


def _group_draws(seed: int):
    """Draws the slots of each shard among the sources of a group, as many as the group gives it."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, sources, needs in zip(*(c.to_pylist() for c in batch.columns)):
                counts = draw_counts([s["slots"] for s in sources], needs, [seed, group])
                begins = np.cumsum(counts, axis=0) - counts
                shard, place = np.nonzero(counts)
                of = {k: np.array([s[k] for s in sources], np.int64)[place]
                      for k in ("source_number", "source_size", "words", "blocks")}
                yield pa.RecordBatch.from_pydict(
                    {**of, "shard": shard.astype(np.int32), "begin": begins[shard, place], "n": counts[shard, place]})

    return draw


def taken(documents: DataFrame, draws: DataFrame) -> DataFrame:
    """``documents`` with ``taken``, the words the mix takes of each, repeats counted."""
    sums = draws.groupBy("source_number", "start").agg(F.sum("words").alias("taken"))
    return documents.join(sums, ["source_number", "start"], "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``, one row per document and round that takes of it.

    The text is what the slots of the round take, in the order of the document: the whole
    text unchanged, or its taken stretches joined by a line break. Documents without words
    are not in the mix. A column ``n_chars`` is set to the length of the new text. Of rows equal
    in id, source and text one is taken for all, whatever their other columns hold.
    """
    documents, draws = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    text_hash, key_id, key_source, key_hash, taken_spans = (
        fresh(docs, c) for c in ("_hash", "_key_id", "_key_source", "_key_hash", "_spans"))
    spans = draws.groupBy("source_number", "start", "round").agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans"))
    picked = documents.join(spans, ["source_number", "start"]).select(
        F.col("doc_id").alias(key_id), F.col("source").alias(key_source), F.col("hash").alias(key_hash),
        F.col("spans").alias(taken_spans))
    texts = docs.withColumn(text_hash, F.xxhash64(filled(text_col))).dropDuplicates([id_col, source_col, text_hash])
    same = (F.col(id_col).eqNullSafe(F.col(key_id)) & F.col(source_col).eqNullSafe(F.col(key_source))
            & (F.col(text_hash) == F.col(key_hash)))
    joined = texts.join(picked, same).select(*docs.columns, taken_spans)
    return cut_texts(joined, docs, text_col)


def cut_texts(joined: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """Replace the text by its stretches, the last column, and drop that."""
    ready(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("none", dict)
        for batch in batches:
            *columns, spans = batch.columns
            texts = [stretches_of(t, [(s["first"], s["words"]) for s in s_])
                     for t, s_ in zip(columns[at].to_pylist(), spans.to_pylist())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    out = joined.mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return out


_word = re.compile("[^ \\t-\\r]+")


def stretches_of(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The words of the sorted ``spans`` (first, how many) with the white space between them."""
    merged: list[list[int]] = []
    for first, words in spans:
        if merged and merged[-1][1] == first:
            merged[-1][1] += words
        else:
            merged.append([first, first + words])
    places = [m.span() for m in _word.finditer(text)]
    if merged == [[0, len(places)]]:
        return text
    return "\n".join(text[places[a][0]:places[b - 1][1]] for a, b in merged)
