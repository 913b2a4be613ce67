"""Hard negatives by exact scores from subset-sum tables (the method of the Four Russians).

Components become integers, and a candidate is kept as bit planes: per plane, one byte holds
that bit of eight dimensions. For an anchor and eight of its dimensions a table has the sum of
every subset, 256 entries; a byte of a candidate's plane picks the sum it needs, and the
planes are added from the highest down, doubling in between. That gives the full integer
inner product without a multiplication.

Anchors and candidates are dealt to a grid of cells by hashes of their rows, each cell with a
bounded block of either. A task streams the candidates of a cell past the tables of its
anchors and keeps, per anchor, only the best it has met; the bests of all cells are ranked
once more. Scores are compared twice: within labels for the positives, then across labels for
the negatives of each of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix.llm.common import ready
from cohortix.session import written

GROUP = 8  # dimensions of a table
ANCHORS = 4_096  # of a cell
CANDIDATES = 8_192  # of a cell
TOGETHER = 64  # anchors whose tables are looked up at once
FIRST, CHUNK = 512, 4_096  # candidates scored at once: few until there is something to beat

CELL = "a int, c int, role int, id long, mark long, label long, planes binary, found array<struct<score: bigint, id: bigint>>"
PAIR = "anchor_id long, mark long, positive int, id long, score long"
_pair = pa.schema([("anchor_id", pa.int64()), ("mark", pa.int64()), ("positive", pa.int32()),
                   ("id", pa.int64()), ("score", pa.int64())])


@dataclass(frozen=True)
class Shape:
    """Bit planes and groups of eight dimensions of all rows, and whether scores fit 32 bits."""

    planes: int
    groups: int
    small: bool

    @property
    def kind(self) -> type:
        return np.int32 if self.small else np.int64


def coded(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> tuple[DataFrame, Shape]:
    """``id, label, mark, planes`` of the rows that take part, as a written table.

    Rows without id, label or vector, or with a missing or non-finite component, take no part.
    Component x becomes ``floor(scale * x)``, kept within 64 bits. Shorter vectors are filled
    up with zeros. Rows that agree in id, label and components count once. ``mark`` tells rows
    of one id apart.
    """
    ready(vectors.sparkSession)
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("x")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    ).select("id", "label", F.transform("x", lambda e: F.floor(e * F.lit(float(scale)))).alias("x"))
    size = F.transform("x", lambda e: F.when(e < 0, -1 - e).otherwise(e))
    most, longest = rows.agg(F.max(F.array_max(size)), F.max(F.size("x"))).first()
    planes, groups = int(most or 0).bit_length() + 1, max(1, -(-(longest or 0) // GROUP))
    shape = Shape(planes, groups, groups * GROUP * (int(most or 0) + 1) * (1 << planes) < 1 << 31)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed(whole, shape), pa.binary())], ["id", "label", "planes"])

    codes = rows.mapInArrow(pack, "id long, label long, planes binary").distinct()
    return written(codes.withColumn("mark", F.xxhash64("label", "planes")), "codes"), shape


def packed(whole: pa.ListArray, shape: Shape) -> list[bytes]:
    """Per row, plane by plane from the lowest, a byte for each eight dimensions."""
    sizes = np.asarray(whole.value_lengths())
    values = np.asarray(whole.flatten(), np.int64)
    square = np.zeros((len(sizes), shape.groups * GROUP), np.int64)
    square[np.arange(square.shape[1]) < sizes[:, None]] = values
    planes = [np.packbits((square >> k & 1).astype(bool), axis=1, bitorder="little") for k in range(shape.planes)]
    return [row.tobytes() for row in np.concatenate(planes, axis=1)]


def plane_bytes(planes: list[bytes], shape: Shape) -> np.ndarray:
    """``[plane, group, row]``"""
    flat = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), shape.planes, shape.groups)
    return np.ascontiguousarray(flat.transpose(1, 2, 0))


def components_of(planes: list[bytes], shape: Shape) -> np.ndarray:
    """The integers that were packed, a row per vector."""
    flat = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), shape.planes, shape.groups)
    bits = np.unpackbits(flat, axis=2, bitorder="little").astype(np.int64)
    out = -bits[:, -1]  # two's complement: the highest plane counts against
    for k in range(shape.planes - 2, -1, -1):
        out = (out << 1) + bits[:, k]
    return out


def tables(anchors: np.ndarray, shape: Shape) -> np.ndarray:
    """``[group, byte, anchor]``: the sum of the anchor's dimensions whose bits are set in the byte."""
    by_group = anchors.astype(shape.kind).T.reshape(shape.groups, GROUP, len(anchors))
    out = np.zeros((shape.groups, 1 << GROUP, len(anchors)), shape.kind)
    for i in range(GROUP):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + by_group[:, i, None]
    return out


def scores(sums: np.ndarray, candidates: np.ndarray, shape: Shape) -> np.ndarray:
    """``[candidate, anchor]`` inner products, from ``tables`` and ``plane_bytes``; sums wrap as 64-bit integers do."""
    n, anchors = candidates.shape[2], sums.shape[2]
    total, looked = np.zeros((n, anchors), shape.kind), np.empty((n, anchors), shape.kind)
    for k in range(shape.planes - 1, -1, -1):
        for g in range(shape.groups):
            np.take(sums[g], candidates[k, g], axis=0, out=looked, mode="clip")
            total += looked
        if k == shape.planes - 1:
            np.negative(total, out=total)
        if k:
            total <<= 1
    return total


def leading(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` of each slot by descending score, then ascending id."""
    order = np.lexsort((ids, ~score, slot))
    ranked = slot[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, int)
    rank = np.arange(len(ranked)) - np.repeat(first, np.diff(np.r_[first, len(ranked)]))
    return order[rank < most]


class Bests:
    """The best of what some anchors have met so far; a slot is an anchor or one of its windows of scores."""

    def __init__(self, least: np.ndarray, highest: np.ndarray, most: int, kind: type):
        info = np.iinfo(kind)
        self.least, self.highest = (np.clip(v, info.min, info.max).astype(kind) for v in (least, highest))  # [window, anchor]
        self.never = (least > info.max) | (highest < info.min)  # a bound that scores of this kind cannot reach
        self.most = most
        self.slot, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def meet(self, found: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        slots, values, names = [self.slot], [self.score], [self.ids]
        for w in range(len(self.least)):
            row, anchor = np.nonzero((found >= self.least[w]) & (found <= self.highest[w]) & ~self.never[w])
            other = ids[row] != own[anchor]
            row, anchor = row[other], anchor[other]
            slots.append(anchor * len(self.least) + w)
            values.append(found[row, anchor].astype(np.int64))
            names.append(ids[row])
        slot, value, name = map(np.concatenate, (slots, values, names))
        if len(slot) == len(self.slot):
            return
        kept = leading(slot, value, name, self.most)
        self.slot, self.score, self.ids = slot[kept], value[kept], name[kept]
        full = np.flatnonzero(np.r_[self.slot[self.most - 1:] == self.slot[:len(self.slot) - self.most + 1]]) if len(
            self.slot) >= self.most else np.zeros(0, int)
        anchor, window = np.divmod(self.slot[full], len(self.least))
        self.least[window, anchor] = self.score[full + self.most - 1]


def _cells(within: bool, shape: Shape, most: int, low: int, high: int):
    """The function of a grid task: rows ordered by cell, anchors before candidates."""

    class Cell:
        def __init__(self, anchors: list[dict]):
            anchors.sort(key=lambda r: r["label"])
            self.anchors, self.groups, self.waiting, self.first = anchors, [], [], True
            vectors = components_of([r["planes"] for r in anchors], shape)
            label = np.array([r["label"] for r in anchors])
            for value in np.unique(label):
                for at in np.array_split(own := np.flatnonzero(label == value), -(-len(own) // TOGETHER)):
                    self.groups.append((value, at, np.array([anchors[i]["id"] for i in at]),
                                        tables(vectors[at], shape), self.bests(at)))

        def bests(self, at: np.ndarray) -> Bests:
            if within:
                bounds = np.full((1, len(at)), np.iinfo(np.int64).min), np.full((1, len(at)), np.iinfo(np.int64).max)
            else:
                widest = max(len(self.anchors[i]["found"]) for i in at)
                info = np.iinfo(np.int64)
                least, highest = np.full((widest, len(at)), info.max), np.full((widest, len(at)), info.min)
                for column, i in enumerate(at):
                    for w, p in enumerate(self.anchors[i]["found"]):
                        least[w, column] = min(info.max, max(info.min, -(-low * p["score"] // 100)))
                        highest[w, column] = min(info.max, max(info.min, high * p["score"] // 100))
                bounds = least, highest
            return Bests(*bounds, most, shape.kind)

        def meet(self, rows: pa.Table) -> None:
            ids, label = np.asarray(rows["id"]), np.asarray(rows["label"])
            bits = plane_bytes(rows["planes"].to_pylist(), shape)
            at = 0
            while at < len(ids):
                upto = at + (FIRST if self.first else CHUNK)
                self.first = False
                for value, _, own, sums, bests in self.groups:
                    use = at + np.flatnonzero((label[at:upto] == value) == within)
                    if len(use):
                        bests.meet(scores(sums, bits[:, :, use], shape), ids[use], own)
                at = upto

        def result(self) -> Iterator[pa.RecordBatch]:
            for _, at, own, _, bests in self.groups:
                anchor, window = np.divmod(bests.slot, len(bests.least))
                mark = np.array([self.anchors[i]["mark"] for i in at], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[anchor], pa.int64()), pa.array(mark[anchor], pa.int64()),
                     pa.array(window + 1, pa.int32()), pa.array(bests.ids, pa.int64()), pa.array(bests.score, pa.int64())],
                    schema=_pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, cell = None, [], None
        waiting: list[pa.Table] = []

        def flush() -> None:
            if waiting and cell:
                cell.meet(pa.concat_tables(waiting))
            waiting.clear()

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            place = np.stack([np.asarray(rows[c]) for c in ("a", "c", "role")], axis=1)
            cuts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(axis=1)])
            for start, stop in zip(cuts, np.r_[cuts[1:], len(place)]):
                a, c, role = (int(v) for v in place[start])
                if (a, c) != key:
                    flush()
                    if cell:
                        yield from cell.result()
                    key, anchors, cell = (a, c), [], None
                part = rows.slice(start, stop - start)
                if role == 0:
                    anchors += part.select(["id", "mark", "label", "planes", "found"]).to_pylist()
                elif anchors:
                    cell = cell or Cell(anchors)
                    waiting.append(part.select(["id", "label", "planes"]))
                    if sum(t.num_rows for t in waiting) >= CHUNK:
                        flush()
        flush()
        if cell:
            yield from cell.result()

    return run


def _grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Every block of anchors beside every block of candidates, each cell whole in one task, anchors first."""
    down, across = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))

    def block(n: int):
        return F.pmod(F.xxhash64("id", "mark"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    no_pairs = F.lit(None).cast("array<struct<score: bigint, id: bigint>>").alias("found")
    left = anchors.select(block(down).alias("a"), every(across).alias("c"), F.lit(0).alias("role"), "id", "mark", "label", "planes", "found")
    right = rows.select(every(down).alias("a"), block(across).alias("c"), F.lit(1).alias("role"), "id", "mark", "label", "planes", no_pairs)
    return left.union(right).repartition(down * across, "a", "c").sortWithinPartitions("a", "c", "role")


def _ranked(pairs: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   anchor_every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``anchor_every`` divides. Their positives are the first
    ``positives`` other rows of their label by score, ties by smaller id; the negatives of a
    pair are the first ``negatives`` rows of other labels whose score lies between ``low`` and
    ``high`` per cent of the positive's, both included. See ``coded`` for rows that take no
    part and repeated rows; rows of the anchor's own id are never its partners. Rows that
    share an id but differ otherwise are rows of their own. An anchor without a positive, a
    positive without a negative and an empty table give no row. Other columns are ignored.
    """
    rows, shape = coded(vectors, id_col, label_col, vector_col, scale)
    anchors = rows.where(F.col("id") % anchor_every == 0)
    n_anchors, n_rows = anchors.count(), rows.count()
    no_pairs = F.lit(None).cast("array<struct<score: bigint, id: bigint>>")
    near = _grid(anchors.withColumn("found", no_pairs), rows, n_anchors, n_rows).mapInArrow(
        _cells(True, shape, positives, low, high), PAIR)
    # at most `positives` rows of a key reach the list
    chosen = _ranked(near, ["anchor_id", "mark"], positives).groupBy("anchor_id", "mark").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("found"))
    with_positives = written(
        anchors.join(chosen.withColumnRenamed("anchor_id", "id"), ["id", "mark"]).select(
            "id", "mark", "label", "planes", F.transform("found", lambda p: F.struct(p.score, p.id)).alias("found")), "anchors")
    far = _grid(with_positives, rows, n_anchors, n_rows).mapInArrow(_cells(False, shape, negatives, low, high), PAIR)
    pairs = _ranked(far, ["anchor_id", "mark", "positive"], negatives)
    partners = with_positives.select(F.col("id").alias("anchor_id"), "mark", F.posexplode("found").alias("at", "partner"))
    return pairs.join(partners.withColumn("positive", F.col("at") + 1), ["anchor_id", "mark", "positive"]).select(
        "anchor_id", F.col("partner.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("partner.score").alias("positive_score"), F.col("score").alias("negative_score"))
