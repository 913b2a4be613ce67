"""Pack documents into sequences of a fixed length by first-fit decreasing.

Rows are dealt at random, each task cuts its rows into groups of bounded size, and every
group is packed on its own: whole multiples of the length are cut off, the remainders go,
longest first, into the first sequence with room. A tournament tree over the free places of
the sequences finds that sequence in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import filled, give_back, ready
from cohortix.llm.tokens import encoder

LENGTH = 2_048
GROUP_DOCS = 2_048
GROUP_TOKENS = 2 << 20
BYTES_PER_TASK = 32 << 20


class Tournament:
    """Free places of the sequences; every inner node holds the larger of its two."""

    def __init__(self, leaves: int, free: int):
        self.size = 1
        while self.size < leaves:
            self.size *= 2
        self.tree = [free] * (2 * self.size)

    def first_with(self, need: int) -> int:
        """The leftmost sequence with at least ``need`` free places, which it takes."""
        node = 1
        while node < self.size:
            node *= 2
            if self.tree[node] < need:
                node += 1
        self.tree[node] -= need
        leaf = node - self.size
        while node := node // 2:
            self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])
        return leaf


def first_fit_decreasing(sizes: Sequence[int], length: int) -> list[tuple[int, int]]:
    """``(sequence, offset)`` of each piece, no piece longer than ``length``."""
    place: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    if not sizes:
        return place
    tree = Tournament(len(sizes), length)
    used = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        leaf = tree.first_with(sizes[i])
        place[i] = leaf, used[leaf]
        used[leaf] += sizes[i]
    return place


def pieces_of(totals: Sequence[int], length: int) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, size, sequence, offset)`` for one group, sequences from 0.

    A sequence at most half full would be more padding than tokens. Its pieces are cut
    where its length, written as powers of two, says, and each part stands as a sequence of
    that length, which needs no padding.
    """
    cut = [(d, s, min(length, n - s)) for d, n in enumerate(totals) for s in range(0, n, length)]
    place = first_fit_decreasing([size for *_, size in cut], length)
    held: dict[int, list[tuple[int, int, int, int]]] = {}
    for (d, s, size), (sequence, offset) in zip(cut, place):
        held.setdefault(sequence, []).append((offset, d, s, size))
    out, number = [], 0
    for sequence in sorted(held):
        filled_to = sum(p[3] for p in held[sequence])
        shapes = _powers(filled_to) if 2 * filled_to <= length else [length]
        room, offset = shapes.pop(0), 0
        for _, d, s, size in sorted(held[sequence]):
            while size:
                if not room:
                    number, room, offset = number + 1, shapes.pop(0), 0
                part = min(size, room)
                out.append((d, s, part, number, offset))
                s, size, room, offset = s + part, size - part, room - part, offset + part
        number += 1
    return out


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, *, end_id: int, length: int = LENGTH,
         id_col: str = "doc_id", text_col: str = "text",
         group_docs: int = GROUP_DOCS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: its document, where it lies, and its ids (binary, 32 bits each).

    ``start`` is where the piece begins in its document, ``sequence_id`` and ``offset``
    where it lies; the places of a sequence are taken from 0 without a gap. Missing and empty
    texts are their end id alone. Repeated rows are packed as often as they come, missing ids
    stay missing, other columns are dropped, and an empty table gives no sequence.

    A group ends at ``group_docs`` documents or ``group_tokens`` ids, so its memory is bounded
    by that and its longest document.
    """
    ready(docs.sparkSession)
    text = filled(text_col)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    dealt = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).repartition(
        max(1, -(-size // BYTES_PER_TASK)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers = TaskContext.get().partitionId() << 40
        ids, raws, held = [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal numbers, ids, raws, held
            rows = pieces_of([len(r) // 4 for r in raws], length)
            for at in range(0, len(rows), 2_048):
                yield _pieces([
                    (ids[d], s, n, numbers + q, o, len(raws[d]) // 4, raws[d][4 * s:4 * (s + n)])
                    for d, s, n, q, o in rows[at:at + 2_048]])
            numbers += 1 + max((r[3] for r in rows), default=-1)
            ids, raws, held = [], [], 0

        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist())):
                ids.append(doc_id)
                raws.append(raw + end)
                held += len(raw) // 4 + 1
                if len(ids) >= group_docs or held >= group_tokens:
                    yield from close()
        if ids:
            yield from close()
        give_back()

    return dealt.mapInArrow(
        packed, "doc_id long, start long, length long, sequence_id long, offset long, "
                "doc_tokens long, ids binary")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, size, sequence, offset, total, ids = zip(*rows)
    longs = {"doc_id": doc, "start": start, "length": size, "sequence_id": sequence,
             "offset": offset, "doc_tokens": total}
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in longs.values()], pa.array(ids, pa.binary())],
        [*longs, "ids"])


