"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the allowed distance. Two
fingerprints within the distance meet in a variant, and all that meet there are within the
distance of one another, so a link to the smallest of them keeps the group together. A
variant holds at most as many fingerprints as a ball has members, whatever the table, so
copies and popular texts never make a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix.llm.common import components, filled, fresh, give_back, ready, sole_cache
from cohortix.session import written

BITS = 64
SEED = 42
_lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, width: int = 3) -> int:
    """The majority bits of the XXH64 of all ``width``-word shingles, as a signed 64-bit integer.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than ``width``
    make one shingle; no word gives zero.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_lower).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    begins = (ends - size).tolist()
    last = ends[width - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(begins, last)), np.uint64, len(last))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, out: str, width: int = 3) -> DataFrame:
    """Add the fingerprint of the whole text as a long; missing text counts as empty."""
    ready(docs.sparkSession)
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("none", dict)
        for batch in batches:
            found = [fingerprint(t or "", width) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, out])
        give_back()

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())]))


def balls(radius: int) -> list[int]:
    """The bit patterns that move a fingerprint to each member of its ball."""
    out = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def links(prints: DataFrame, col: str, distance: int) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints within ``distance`` to join them.

    Every pair within the distance is joined directly or through the smallest fingerprint of
    a shared variant, to which both are within the distance too.
    """
    if distance < 0 or distance % 2:
        raise ValueError("the distance must be even: half of it is the radius of the balls")
    masks = F.array(*[F.lit(m).cast("long") for m in balls(distance // 2)])
    spread = prints.select(F.col(col).alias("a")).distinct().withColumn("mask", F.explode(masks))
    spread = spread.select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("a").over(W.partitionBy("variant"))
    return (
        spread.select("a", least.alias("b")).where("b < a").distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )


def roots(prints: DataFrame, col: str, distance: int) -> DataFrame:
    """``(print, root)`` of every fingerprint that has a link."""
    return components(links(prints, col, distance), "a", "b").select(
        F.col("node").alias("print"), "root")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   width: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (hex) and ``component_id``.

    ``component_id`` is the smallest id reachable by links, null when no document of the
    group has an id. Missing and empty texts have fingerprint zero and link with each other.
    Repeated rows come back repeated; an empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = written(with_fingerprints(narrow, "text", "print", width).select("id", "print"), "prints")
    by_print = prints.groupBy("print").agg(F.min("id").alias("first"))
    labelled = by_print.join(roots(by_print, "print", distance), "print", "left")
    labelled = labelled.select("print", "first", F.coalesce("root", "print").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.join(least, "root").select("print", "component_id")
    return prints.join(named, "print").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     width: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row per group: the one with the smallest id (missing ids last).

    Equal ids are told apart by the hash of the text; of rows equal in both one stays.
    """
    mark, text_hash = fresh(docs, "_print"), fresh(docs, "_hash")
    marked = written(
        with_fingerprints(docs, text_col, mark, width)
        .withColumn(text_hash, F.xxhash64(filled(text_col))), "prints")
    prints = marked.select(F.col(mark).alias("print"), F.col(id_col).alias("id"),
                           F.col(text_hash).alias("hash"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "print")).alias("first")
    by_print = prints.groupBy("print").agg(first)
    labelled = by_print.join(roots(by_print, "print", distance), "print", "left")
    key_mark, key_id, key_hash = (fresh(marked, c) for c in ("_key_print", "_key_id", "_key_hash"))
    kept = (
        labelled.groupBy(F.coalesce("root", "print").alias("root")).agg(F.min("first").alias("first"))
        .select(F.col("first.print").alias(key_mark), F.col("first.id").alias(key_id),
                F.col("first.hash").alias(key_hash))
    )
    match = ((F.col(mark) == F.col(key_mark)) & (F.col(text_hash) == F.col(key_hash))
             & F.col(id_col).eqNullSafe(F.col(key_id)))
    one = marked.join(kept, match, "left_semi").dropDuplicates([mark, text_hash, id_col])
    return one.select(*docs.columns)
