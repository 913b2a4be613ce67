"""Token ids as compressed documents with a shared dictionary, readable one by one.

The file format is two Parquet tables below one folder, written by Spark's committer, so a
lost executor leaves nothing half written and any store Spark reaches will do:

``dictionary``  one row: ``dict_hash`` (SHA-256 of the dictionary), ``dictionary``, ``id_bytes``
``blocks``      one row per block of consecutive documents: ``part`` and ``block`` (their order),
                ``dict_hash``, ``payload`` and the offset index. Every document is a zstandard
                frame of its own inside ``payload``; the index holds, per document, ``doc_id``,
                ``at`` and ``size`` (the frame), ``start`` (ids before it in its part) and
                ``n_tokens``. Parquet keeps the index apart from the payload: looking up one
                document reads the index and then one payload.

Ids are little-endian unsigned integers of ``id_bytes`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import filled, give_back, offsets, ready
from cohortix.llm.tokens import encoder

SAMPLE_DOCS = 1_500
SAMPLE_IDS = 2_048
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4_096
# Batches encoded together: what several of them have in common is looked up once.
GATHER_DOCS = 4_096
GATHER_BYTES = 14 << 20
LEVEL = 2  # with the dictionary, files no larger than at level 3

ENTRY = "struct<doc_id: bigint, at: bigint, size: bigint, start: bigint, n_tokens: bigint>"
BLOCKS = (f"part int, block bigint, dict_hash string, n_docs bigint, n_tokens bigint, "
          f"index array<{ENTRY}>, payload binary")
_entry = pa.struct([(n, pa.int64()) for n in ("doc_id", "at", "size", "start", "n_tokens")])
_blocks = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("dict_hash", pa.string()), ("n_docs", pa.int64()),
    ("n_tokens", pa.int64()), ("index", pa.list_(_entry)), ("payload", pa.binary())])


def id_width(path: str) -> int:
    return 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, text_col: str, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary from the first ``SAMPLE_IDS`` ids of about ``SAMPLE_DOCS`` documents.

    The documents are drawn by a hash of their text, at most twice ``SAMPLE_DOCS``. Which
    they are changes the size of the files, never their content. Too few samples to train
    on give an empty dictionary.
    """
    import zstandard

    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    draw = F.pmod(F.xxhash64(filled(text_col), F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = encoder(tokenizer).encode(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([narrowed(r[:4 * SAMPLE_IDS], end_id, width) for r in raw], pa.binary())], ["ids"])

    drawn = docs.where(draw).limit(2 * SAMPLE_DOCS).select(F.substring(filled(text_col), 1, 8 * SAMPLE_IDS))
    samples = [bytes(r) for r in drawn.mapInArrow(ids, "ids binary").toArrow().column(0).to_pylist()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def narrowed(raw: bytes, end_id: int, width: int) -> bytes:
    """Ids of 32 bits plus the end id, stored in ``width`` bytes each."""
    ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
    return ids.astype(f"<u{width}").tobytes()


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of as many batches as stay within ``GATHER_DOCS`` and ``GATHER_BYTES``, one at least."""
    ids, texts, size = [], [], 0
    for batch in batches:
        if ids and (len(ids) + batch.num_rows > GATHER_DOCS or size + batch.nbytes > GATHER_BYTES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids += batch.column(0).to_pylist()
        texts += batch.column(1).to_pylist()
        size += batch.nbytes
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write them in ascending id order (missing ids last).

    Missing text counts as empty: the document is its end id alone. Rows of equal id follow
    the hash of their text; repeated rows are written as often as they come. Other columns
    are ignored. An empty table writes a dictionary and no block.
    """
    import zstandard

    spark = docs.sparkSession
    ready(spark)
    width = id_width(tokenizer)
    dictionary = train_dictionary(docs, text_col, tokenizer, end_id, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    row = pa.table({"dict_hash": [digest], "dictionary": [dictionary], "id_bytes": [width]})
    (spark.createDataFrame(row, "dict_hash string, dictionary binary, id_bytes int")
     .coalesce(1).write.parquet(f"{path}/dictionary"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        number = done = held = 0
        doc_ids, frames, counts = [], [], []

        def close() -> pa.RecordBatch:
            sizes, n = np.fromiter(map(len, frames), np.int64, len(frames)), np.array(counts, np.int64)
            columns = (pa.array(doc_ids, pa.int64()), np.cumsum(sizes) - sizes, sizes, done - n.sum() + np.cumsum(n) - n, n)
            index = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_entry))
            lists = pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), index)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number]), pa.array([digest]), pa.array([len(n)]),
                 pa.array([int(n.sum())]), lists, pa.array([b"".join(frames)], pa.binary())], schema=_blocks)

        for ids, texts in gathered(batches):
            for doc_id, raw in zip(ids, encoder(tokenizer).encode(texts)):
                stored = narrowed(raw, end_id, width)
                doc_ids.append(doc_id)
                frames.append(press.compress(stored))
                counts.append(len(stored) // width)
                held, done = held + len(frames[-1]), done + counts[-1]
                if held >= BLOCK_BYTES or len(frames) >= BLOCK_DOCS:
                    yield close()
                    number, held, doc_ids, frames, counts = number + 1, 0, [], [], []
        if frames:
            yield close()
        give_back()

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_last(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "tie").select("doc_id", "text")
    )
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the written documents; ``ids`` is binary, 32 bits each.

    ``start`` counts the ids of all documents before this one. Part totals are added up, one
    row per part, and joined back. With ``doc_ids`` only blocks whose index names one are
    decoded, and of them only those frames.
    """
    import zstandard

    ready(spark)
    header = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, digest, width = bytes(header.dictionary), header.dict_hash, header.id_bytes
    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError("the dictionary does not have the hash it was written with")
    wanted = None if doc_ids is None else frozenset(doc_ids)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpress = zstandard.ZstdDecompressor(dict_data=trained)
        for batch in batches:
            for block in range(batch.num_rows):
                found, before, index, payload = (c[block] for c in batch.columns)
                if found.as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                held = memoryview(payload.as_buffer())
                out, size = [], 0
                for e in index.as_py():
                    if wanted is not None and e["doc_id"] not in wanted:
                        continue
                    raw = unpress.decompress(held[e["at"]:e["at"] + e["size"]])
                    out.append((e["doc_id"], before.as_py() + e["start"], e["n_tokens"],
                                np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()))
                    size += len(out[-1][3])
                    if size > 4 * BLOCK_BYTES:
                        yield _documents(out)
                        out, size = [], 0
                if out:
                    yield _documents(out)

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    if wanted is not None:
        named = F.array(*[F.lit(i).cast("long") for i in sorted(wanted)])
        blocks = blocks.where(F.arrays_overlap(F.col("index.doc_id"), named))
    sums = (spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
            .groupBy("part").agg(F.sum("n_tokens").alias("n"))
            .withColumn("all", F.lit(0)))
    before = offsets(sums, ["all"], ["part"], "n", "before").select("part", "before")
    return (
        # one row per part, and a part is what one task wrote
        blocks.join(F.broadcast(before), "part").select("dict_hash", "before", "index", "payload")
        .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
    )


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids"])
