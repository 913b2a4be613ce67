"""Similarity digests from improbable features.

A feature is a window of 64 bytes. How rare its Shannon entropy is among all windows of the
corpus gives its rank; in every run of 64 features the rarest wins, and a feature that wins
often enough is selected (Roussev, 2010). Selected features go, in order, into a chain of
Bloom filters of 2048 bits and 160 features each. Two digests are compared by the bit overlap
of their filters beyond chance, normalised to the largest possible.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix.functions.running import slice_bounds, sliced
from cohortix.llm.common import filled, ready

WIDTH = 64
RUN = 64
WINS = 16
FILTER_BITS = 2_048
FILTER_FEATURES = 160
HASHES = 5
BINS = 1_000
CHUNK_BYTES = 1 << 19
PART_ROWS = 1_000
MAX_PARTS = 20_000

_counts = np.arange(WIDTH + 1)
# c log2 c in steps of 2**-16, whole numbers so that running sums are exact
_mass = np.rint((1 << 16) * _counts * np.log2(np.maximum(_counts, 1))).astype(np.int64)
_gain = (_mass[1:] - _mass[:-1]).astype(np.int32)
_full = int(_mass[-1])


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The entropy bin, 0 to ``BINS`` - 1, of every window of ``data``.

    Moving a window takes one byte out and one in; how often each occurs in the rest comes
    from comparing the data with itself shifted by 1 to 63 places.
    """
    n = len(data)
    ahead, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, WIDTH):
        same = (data[:-k] == data[k:]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    steps = np.zeros(n - WIDTH + 1, np.int64)
    steps[0] = _mass[np.bincount(data[:WIDTH])].sum()
    steps[1:] = _gain[behind[WIDTH:]] - _gain[ahead[:n - WIDTH]]
    mass = np.cumsum(steps)
    return np.minimum(BINS - 1, (_full - mass) * BINS // _full)


def laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, with begins and ends; texts shorter than a window are padded with zeros."""
    padded = [t.ljust(WIDTH, b"\0") if t else t for t in texts]
    ends = np.cumsum([len(t) for t in padded])
    return np.frombuffer(b"".join(padded), np.uint8), ends - [len(t) for t in padded], ends


def histogram(texts: Sequence[bytes]) -> np.ndarray:
    """How many windows of the texts fall into each entropy bin."""
    data, begins, ends = laid_out(texts)
    if not len(data):
        return np.zeros(BINS, np.int64)
    bins, inside = entropy_bins(data), _inside(len(data), begins, ends)
    return np.bincount(bins[inside], minlength=BINS)


def _inside(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which windows lie in one text."""
    change = np.zeros(n + 2, np.int32)
    filled_ = ends > begins
    np.add.at(change, begins[filled_], 1)
    np.add.at(change, ends[filled_] - WIDTH + 1, -1)
    return np.cumsum(change)[:n - WIDTH + 1] > 0


def selected(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, ranks: np.ndarray,
             scaled: bool = False) -> np.ndarray:
    """Positions of the windows with ``WINS`` wins, ascending.

    ``scaled`` selects at least one for each text that is not empty: in a text of fewer than
    ``RUN`` runs as large a share of them is enough, and where no feature has it, those with
    most wins are selected.
    """
    rank = ranks[entropy_bins(data)]
    n = len(rank)
    low = max(1, int(n - 1).bit_length())
    kind = np.int32 if low + int(ranks.max()).bit_length() < 31 else np.int64
    keys = (rank.astype(kind) << kind(low)) | np.arange(n, dtype=kind)  # the leftmost of equals wins
    least, width = keys, 1
    while width < RUN:
        least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    features = ends - begins - WIDTH + 1
    long = features >= RUN
    change = np.zeros(n + 2, np.int32)
    np.add.at(change, begins[long], 1)
    np.add.at(change, begins[long] + features[long] - RUN + 1, -1)
    runs = np.cumsum(change)[:len(least)] > 0
    wins = np.bincount(least[runs] & kind((1 << low) - 1), minlength=n)
    few = [b + int(np.argmin(keys[b:b + f])) for b, f in zip(begins[~long].tolist(), features[~long].tolist()) if f > 0]
    often = np.flatnonzero(wins >= WINS)
    if scaled:
        winners = np.flatnonzero(wins)
        owner = np.searchsorted(ends, winners, side="right")
        most = np.zeros(len(ends), np.int64)
        np.maximum.at(most, owner, wins[winners])
        enough = np.minimum(most, np.clip(-(-WINS * (features - RUN + 1) // RUN), 1, WINS))
        often = winners[wins[winners] >= enough[owner]]
    return np.sort(np.concatenate([often, np.array(few, np.int64)]))


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits for each window at ``at``, from multiplications and shifts over its eight words."""
    words = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[at].copy().view("<u8")
    out = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for c in range(words.shape[1]):
            out = (out ^ words[:, c]) * np.uint64(0xFF51AFD7ED558CCD)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xC4CEB9FE1A85EC53)
    return out ^ (out >> np.uint64(29))


def digests(texts: Sequence[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """For each text its chain of filters as rows of ``FILTER_BITS / 8`` bytes; none for an empty text.

    A feature that occurs again in a text is inserted once.
    """
    data, begins, ends = laid_out(texts)
    empty = np.zeros((0, FILTER_BITS // 8), np.uint8)
    if not len(data):
        return [empty] * len(texts)
    at = selected(data, begins, ends, ranks, scaled=True)
    owner = np.searchsorted(ends, at, side="right")
    hashes = _hashes(data, at)
    order = np.lexsort((at, hashes, owner))
    again = np.zeros(len(at), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    owner, hashes = owner[~again], hashes[~again]
    sizes = np.bincount(owner, minlength=len(texts))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    chains = -(-sizes // FILTER_FEATURES)
    first = np.cumsum(chains) - chains
    row = first[owner] + nth // FILTER_FEATURES
    bits = np.zeros((int(chains.sum()), FILTER_BITS), bool)
    for i in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * i)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[f:f + c] if c else empty for f, c in zip(first.tolist(), chains.tolist())]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the mean, over the shorter chain, of each filter's best overlap with the other chain.

    The overlap of two filters counts beyond what chance gives, relative to the most there
    could be. Equal digests have 1, and an empty one has 0 with any that is not.
    """
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    size_a, size_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    wide_a, wide_b = a.view(np.uint64), b.view(np.uint64)
    best = np.empty(len(a))
    for i in range(len(a)):
        both = np.bitwise_count(wide_a[i] & wide_b).sum(axis=1, dtype=np.int64)
        chance = size_a[i] * size_b / FILTER_BITS
        most = np.minimum(size_a[i], size_b)
        best[i] = ((both - chance) / np.maximum(most - chance, 1e-9)).max()
    return float(np.clip(best, 0.0, 1.0).mean())


def rarity_ranks(docs: DataFrame, text_col: str) -> np.ndarray:
    """The rank of each entropy bin: 0 for the one with fewest windows over all whole texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for texts in _chunks(batch.column(0).to_pylist()):
                total += histogram(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(BINS), pa.int32()), pa.array(total)], ["bin", "n"])

    ready(docs.sparkSession)
    table = docs.select(filled(text_col)).mapInArrow(count, "bin int, n long").groupBy("bin").agg(
        F.sum("n").alias("n")).toArrow()
    total = np.zeros(BINS, np.int64)
    total[table["bin"].to_numpy()] = table["n"].to_numpy()
    ranks = np.empty(BINS, np.int32)
    ranks[np.argsort(total, kind="stable")] = np.arange(BINS)
    return ranks


def _chunks(texts: Sequence[str]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t.encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``part, guest, doc_id, text``, each part in descending order of the id, missing ids last.

    Parts are ranges of the id. A part ends with a guest, a copy of the first row of the next
    part (the first part for the last), so each row has its successor in its part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    parts = min(MAX_PARTS, max(1, rows.count() // PART_ROWS))
    bounds = slice_bounds(rows.where("doc_id is not null"), "doc_id", parts)
    number = rows.withColumn("number", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    rows = sliced(number, "number", [float(b) for b in bounds], "part").drop("number").withColumn(
        "tie", F.xxhash64("text"))
    present = F.col("doc_id").isNotNull()
    heads = rows.groupBy("part").agg(F.max(F.struct(present.alias("known"), "doc_id", "tie")).alias("head"))
    # one row per part, at most MAX_PARTS
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("part"))
    ends = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = heads.select(
        F.col("part").alias("own"), F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie"),
        F.coalesce(F.lag("part").over(order), F.last("part").over(ends)).alias("goes"))
    same = ((F.col("part") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
            & (F.col("tie") == F.col("head_tie")))
    guests = rows.join(F.broadcast(heads), same).dropDuplicates(["goes"]).select(
        F.col("goes").alias("part"), F.lit(1).alias("guest"), "doc_id", "text", "tie")
    both = rows.select("part", F.lit(0).alias("guest"), "doc_id", "text", "tie").unionByName(guests)
    return both.repartition("part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), F.desc("tie")).select("part", "guest", "doc_id", "text")


def edited_text(text: str, following: str) -> str:
    """The last third of the characters replaced by the first as many of the following text."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the digests of its text and of its edited text, and how alike they are.

    ``near_edited`` compares with the edited text, ``near_next`` with the next document in
    descending order of the id; the first follows the last. Digests are base64, empty for an
    empty or missing text. A text shorter than a window is one feature. Rows with equal ids
    follow the hash of their text, repeated rows follow each other, a single row follows
    itself. Other columns are ignored; an empty table gives an empty result.
    """
    ready(docs.sparkSession)
    ranks = rarity_ranks(docs, text_col)
    ordered = with_successors(docs, id_col, text_col)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[3])
                if size >= CHUNK_BYTES:
                    if out := _compared(held, ranks):
                        yield _batch(out)
                    held, size = held[-1:], len(held[-1][3])
        if out := _compared(held, ranks):
            yield _batch(out)

    return ordered.mapInArrow(
        digest, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                "edited_fingerprint string, near_edited double, near_next double")


def _compared(held: Sequence[tuple], ranks: np.ndarray) -> list[tuple]:
    """The results of all rows but the last and the guests."""
    own = [i for i in range(len(held) - 1) if not held[i][1]]
    if not own:
        return []
    originals = [r[3].encode("utf-8", "surrogatepass") for r in held]
    edits = [edited_text(held[i][3], held[i + 1][3]).encode("utf-8", "surrogatepass") for i in own]
    found = digests([*originals, *edits], ranks)
    return [
        (held[i][2], len(held[i][3]), hashlib.sha256(edit).hexdigest(), _written(found[i]), _written(changed),
         likeness(found[i], changed), likeness(found[i], found[i + 1]))
        for i, edit, changed in zip(own, edits, found[len(held):])
    ]


def _written(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                       "edited_fingerprint", "near_edited", "near_next"])
