"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the principal directions is learnt so that the signs of the rotated vectors
make balanced binary codes (Gong and Lazebnik, 2011). A code is cut into substrings, one
table per substring. A vector lies in the bucket of its substring and probes those within a
radius; vectors of a label that meet pass the Hamming distance of the whole code, and are
compared as they are, in double precision. How long the substrings are and how far is probed
follows from how many bits of the learnt codes differ between vectors at the wanted cosine,
and from the rows of the largest label. A bucket is worked off inside a task, in blocks of
bounded size, and gives one row per vector, never one per pair: the pair counts in the
first table where it meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import components, ready
from cohortix.session import written

COSINE = 0.93
BITS = 64
RECALL = 0.98  # of vectors at the cosine itself; closer ones are found more surely
SETTINGS = tuple((width, radius) for width in (32, 16, 12, 10, 8, 6, 4) for radius in range(4) if comb(width, radius) < 600)
COPY, PAIR = 1e-5, 5e-9  # seconds for a copy of a vector in a bucket, and for comparing two codes
PARTNERS = 4_000
FIT_VECTORS = 10_000
FIT_ROUNDS = 50
BLOCK = 2_048
SEED = 5
NO_ID = 1 << 61  # nodes of vectors without any id begin here


@dataclass(frozen=True)
class Codes:
    """``bit j = ((x - mean) @ rotation)[j] > 0``."""

    mean: np.ndarray
    rotation: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def learn_codes(x: np.ndarray, bits: int = BITS, rounds: int = FIT_ROUNDS, seed: int = SEED) -> Codes:
    """Principal directions, then the rotation that brings them closest to their own signs.

    With fewer dimensions than bits the directions are repeated under further rotations.
    """
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    centred = x - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    parts, left = [], bits
    while left:
        k = min(left, x.shape[1])
        w = directions[:, ::-1][:, :k]
        v = centred @ w
        r = np.linalg.qr(rng.standard_normal((k, k)))[0]
        for _ in range(rounds):
            u, _, t = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ t).T
        parts.append(w @ r)
        left -= k
    return Codes(mean, np.hstack(parts))


@dataclass(frozen=True)
class Probing:
    """Substrings of ``width`` bits, looked up within ``radius`` bits; whole codes differ in ``hamming`` bits at most."""

    width: int
    radius: int
    hamming: int

    @property
    def tables(self) -> int:
        return BITS // self.width

    @property
    def ball(self) -> int:
        return sum(comb(self.width, r) for r in range(self.radius + 1))

    def masks(self) -> list[int]:
        """What turns a substring into those around it, itself left out."""
        return [sum(1 << b for b in bits) for r in range(1, self.radius + 1) for bits in combinations(range(self.width), r)]

    def cost(self, rows: int) -> float:
        """Seconds for a label of so many rows."""
        copies = self.tables * (self.ball if self.radius else 1)
        return rows * copies * COPY + rows * rows / 2 * self.tables * self.ball / (1 << self.width) * PAIR


def differing_bits(codes: Codes, x: np.ndarray, cosine: float, seed: int = SEED) -> np.ndarray:
    """Codes of some vectors xor those of made-up partners at exactly ``cosine``, in random directions."""
    rng = np.random.default_rng(seed)
    own = x[rng.choice(len(x), min(PARTNERS, len(x)), replace=False)]
    aside = rng.standard_normal(own.shape)
    aside -= (aside * own).sum(axis=1, keepdims=True) * own
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    return codes(own) ^ codes(cosine * own + np.sqrt(1 - cosine * cosine) * aside)


def substring_distance(apart: np.ndarray, table: int, width: int) -> np.ndarray:
    return np.bitwise_count((apart >> np.uint64(table * width)) & np.uint64((1 << width) - 1))


def learn_probing(apart: np.ndarray, rows: int) -> Probing:
    """The cheapest setting for a label of ``rows`` that meets ``RECALL`` of the pairs with these differing bits."""
    far = np.bitwise_count(apart)
    hamming = max(24, int(np.quantile(far, 0.998, method="higher"))) if len(far) else 24
    found = []
    for width, radius in SETTINGS:
        p = Probing(width, radius, hamming)
        nearest = np.min([substring_distance(apart, t, width) for t in range(p.tables)], axis=0)
        recall = np.mean((nearest <= radius) & (far <= hamming)) if len(far) else 1.0
        found.append((recall >= RECALL, p.cost(rows) if recall >= RECALL else -recall, p))
    enough = [f for f in found if f[0]] or found
    return min(enough, key=lambda f: f[1])[2]


def unit_vectors(batch: pa.RecordBatch, at: int, width: int) -> np.ndarray:
    """The vectors of a column in double precision, scaled to length 1 and padded with zeros.

    Rows that link with nothing (null, zero, or with a null or non-finite component) are zero.
    """
    column = batch.column(at)
    out = np.zeros((batch.num_rows, width))
    for i, v in enumerate(column.to_pylist()):
        if v and None not in v:
            out[i, :len(v)] = v
    out[~np.isfinite(out).all(axis=1)] = 0.0
    out /= np.where((big := np.abs(out).max(axis=1, initial=0.0)) > 0, big, 1.0)[:, None]
    norm = np.linalg.norm(out, axis=1)
    return out / np.where(norm > 0, norm, 1.0)[:, None]


def linked(codes: np.ndarray, x: np.ndarray, own: np.ndarray, other: np.ndarray, table: int, probing: Probing,
           cosine: float) -> np.ndarray:
    """Which rows ``own`` (down) link with which rows ``other`` (across), in one bucket of ``table``.

    A pair counts only where ``table`` is the first in which its substrings are within the radius.
    """
    out = np.zeros((len(own), len(other)), bool)
    for at in range(0, len(own), 256):
        part = own[at:at + 256]
        apart = codes[part, None] ^ codes[None, other]
        near = (np.bitwise_count(apart) <= probing.hamming) & (part[:, None] != other)
        for earlier in range(table):
            near &= substring_distance(apart, earlier, probing.width) > probing.radius
        if near.any():
            out[at:at + 256] = near & (x[part] @ x[other].T >= cosine)
    return out


def smallest_reached(ids: np.ndarray, own: np.ndarray, other: np.ndarray, link: np.ndarray) -> np.ndarray:
    """The smallest id each row reaches over the links of one block."""
    least = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        before = least.copy()
        for rows, across, there in ((own, other, link), (other, own, link.T)):
            some = there.any(axis=1)
            reached = np.where(there[some], least[across], far).min(axis=1)
            least[rows[some]] = np.minimum(least[rows[some]], reached)
        if (before == least).all():
            return least


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Only vectors with equal, present labels and equal lengths are compared. Equal vectors of
    a label are linked without comparing them. ``component_id`` is the smallest id reachable;
    ``kept`` says that it is the row's own. A vector that cannot be compared (null, zero, null or
    non-finite components, no label) has no link and stays. Ids should be unique: rows with
    equal ids count as vectors of their own but share a node of the components. Missing ids
    stay missing and their rows have no component. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ready(spark)
    width = vectors.agg(F.coalesce(F.max(F.size(vector_col)), F.lit(0))).first()[0]
    width = max(1, width)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.size(vector_col).alias("length"), F.col(vector_col).alias("vector"))
    codes, sample = _fit(rows, width)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit_vectors(batch, 3, width)
            found = codes(x).view(np.int64)
            usable = np.abs(x).max(axis=1) > 0
            raw = [r.tobytes() if ok else None for r, ok in zip(x, usable)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found), pa.array(raw, pa.binary())],
                ["id", "label", "length", "code", "unit"])

    coded = written(rows.mapInArrow(encode, "id long, label string, length int, code long, unit binary"), "codes")
    group = ["label", "length", "code", "unit"]
    usable = coded.where("unit is not null and label is not null")
    classes = written(usable.groupBy(*group).agg(
        F.min("id").alias("first"), F.count("*").alias("copies")).withColumn(
            "first", F.coalesce("first", NO_ID + F.pmod(F.xxhash64("label", "unit"), F.lit(NO_ID)))), "vectors")
    largest = classes.groupBy("label", "length").count().agg(F.max("count")).first()[0] or 0
    probing = learn_probing(differing_bits(codes, sample, cosine) if len(sample) else np.zeros(0, np.uint64), largest)
    found = written(_bucket_links(classes, width, probing, cosine), "bucket-links")
    links = found.groupBy("first", *group[:3]).agg(F.sum("added").alias("added"))
    near = components(found, "first", "least")
    root = F.coalesce("root", "first")
    named = (
        classes.join(links, ["first", *group[:3]], "left")
        .join(near, F.col("first") == F.col("node"), "left")
        .select(*[F.col(c).alias(f"c_{c}") for c in group],
                (F.col("copies") - 1 + F.coalesce("added", F.lit(0))).alias("n"),
                F.when(root < NO_ID, root).alias("component")))
    same = [F.col(c) == F.col(f"c_{c}") for c in group]
    component = F.coalesce("component", "id")
    return coded.join(named, same, "left").select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _fit(rows: DataFrame, width: int) -> tuple[Codes, np.ndarray]:
    """Codes, and the vectors they are learnt from: about ``FIT_VECTORS`` vectors drawn by a hash of the id, at most twice that."""
    total = rows.count()
    share = min(1.0, FIT_VECTORS / max(1, total))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("id")), F.lit(1 << 30)) < int(share * (1 << 30))
    table = rows.where(draw).select("vector").limit(2 * FIT_VECTORS).toArrow()
    parts = [unit_vectors(b, 0, width) for b in table.to_batches()] or [np.zeros((0, width))]
    x = np.concatenate(parts)
    x = x[np.abs(x).max(axis=1, initial=0.0) > 0]
    return learn_codes(x if len(x) else np.eye(width)), x


def _bucket_links(classes: DataFrame, width: int, probing: Probing, cosine: float) -> DataFrame:
    """``first, label, length, code, added, least`` of every class with a link, per bucket and pair of blocks.

    A bucket holds the vectors at home in it and those that probe it. Two at home are
    compared, and one at home with one that probes; the latter pair meets in the home of either
    and counts in that of the smaller id.
    """
    key = F.expr(f"shiftrightunsigned(code, t * {probing.width}) & {(1 << probing.width) - 1}L")
    home = classes.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(probing.tables - 1)))).withColumn("key", key)
    spread = home.withColumn("probe", F.lit(False))
    if masks := probing.masks():
        around = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
        spread = spread.union(home.withColumn("mask", around).withColumn("key", F.col("key").bitwiseXOR(F.col("mask"))).drop("mask")
                              .withColumn("probe", F.lit(True)))
    bucket = ["label", "length", "t", "key"]
    shared = spread.groupBy(*bucket).agg(F.count_if(~F.col("probe")).alias("homes"), F.count_if(F.col("probe")).alias("probes")).where(
        "homes > 0 and homes + probes > 1")
    homes, probes = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("homes", "probes"))
    mine = F.pmod(F.xxhash64("first", "unit"), F.when(F.col("probe"), probes).otherwise(homes)).cast("int")
    dealt = spread.join(shared, bucket).withColumn("mine", mine)

    def cells(n, cell):
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda j: j < n), cell)

    def cell(kind: int, a, b):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))

    # every pair of blocks meets once, a block of homes also with itself
    own = F.concat(cells(homes, lambda j: cell(0, F.least("mine", j), F.greatest("mine", j))),
                   cells(probes, lambda j: cell(1, F.col("mine"), j)))
    met = dealt.select("*", F.inline(F.when(F.col("probe"), cells(homes, lambda j: cell(1, j, F.col("mine")))).otherwise(own))).drop(
        "homes", "probes")

    def links(group: pa.Table) -> pa.Table:
        columns = {c: group[c].to_numpy() for c in ("first", "code", "copies", "mine", "probe", "kind", "a", "b", "t")}
        ids, codes, copies = columns["first"], columns["code"].view(np.uint64), columns["copies"]
        x = np.frombuffer(b"".join(group["unit"].to_pylist()), np.float64).reshape(-1, width)
        kind, a, b, table = (int(columns[c][0]) for c in ("kind", "a", "b", "t"))
        own = np.flatnonzero((columns["mine"] == a) & ~columns["probe"])
        across = np.flatnonzero((columns["mine"] == b) & (columns["probe"] == bool(kind)))
        link = linked(codes, x, own, across, table, probing, cosine)
        if kind:
            link &= ids[own][:, None] < ids[across][None, :]
        added = np.zeros(len(ids), np.int64)
        added[own] += link @ copies[across]
        if kind or a != b:
            added[across] += link.T @ copies[own]
        some = np.flatnonzero(added)
        least = smallest_reached(ids, own, across, link) if len(some) else ids
        return pa.table({
            "first": group["first"].take(some), "label": group["label"].take(some), "length": group["length"].take(some),
            "code": group["code"].take(some), "added": added[some], "least": least[some]})

    return met.groupBy(*bucket, "kind", "a", "b").applyInArrow(
        links, "first long, label string, length int, code long, added long, least long")
