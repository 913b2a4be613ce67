"""The prefix trie of conversations by truncation peeling.

A conversation is the sequence of the digests of its turns. Peeling starts at the greatest
depth and goes up: at each depth the conversations that end there join the nodes that
survive from below, rows with one prefix form a node, its aggregates are done at that moment,
and the last turn is stripped. So nodes are discovered and aggregated in the same pass.

The rows are put in order and cut into slices, and every slice is peeled by one task. A node
whose prefix is neither that of the first nor of the last row of its slice lies in the slice
alone and is finished. What is known of the others is left as two spines, the first and the
last row with the aggregates along them, which are rows to peel again: a few slices' spines
at a time, until one task has the rest. A prefix that a third of all conversations share
spans many slices, and each leaves only its spine.

The ids of conversations that end in a node are hashed where the node is finished. Of an
unfinished node every slice writes its run of ids as one string, and the strings of a node
are hashed one after another, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix.llm.common import filled, fresh, ready
from cohortix.session import written

SLICE_TURNS = 500_000
TOGETHER = 512  # spines that one task peels
OUT_ROWS = 10_000
KEY_BYTES = 16
NO_ENDS = hashlib.sha256().hexdigest()
UNSEEN = np.iinfo(np.int64).max

WEIGHTS = ("n", "low", "kids", "leaves", "saved", "ended")
_spine = pa.struct([("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())),
                    *((w, pa.list_(pa.int64())) for w in WEIGHTS)])
_found = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("key", pa.binary()), ("up", pa.binary()), ("first_id", pa.int64()), ("ids", pa.string()), ("spine", _spine)])
FOUND = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, key binary, up binary, first_id long, ids string, "
         "spine struct<path: array<binary>, sizes: array<bigint>, " + ", ".join(f"{w}: array<bigint>" for w in WEIGHTS) + ">")


def paths(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, path, sizes``: per conversation the digests of its turns and the bytes of their texts.

    Turns are in the order of the turn column, missing first; equal turns follow their
    digests. Missing role or text is empty. Rows without a conversation id belong to none and
    are left out. Texts are hashed where they are read and never shuffled.
    """
    role, text = filled(role_col), filled(text_col)
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(said, 256), 1, 2 * KEY_BYTES))
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t")
    ).where("conv_id is not null")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.digest").alias("path"), F.col("t.size").alias("sizes"))


def grafted(own: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Replace the first ``heads`` turns of each conversation by as many of conversation ``base``.

    ``heads`` is at most ``most``. All are taken if the base has fewer, none if it is absent.
    """
    turns = own.withColumns({"t": F.arrays_zip("path", "sizes"), "base": base, "h": heads})
    lead = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("t", 1, most)), ignorenulls=True).over(W.partitionBy("base"))
    rest = F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0)))
    whole = turns.withColumn("lead", lead).withColumn(
        "t", F.concat(F.coalesce(F.slice("lead", F.lit(1), F.col("h")), F.slice("t", 1, 0)), rest))
    return whole.select("conv_id", F.col("t.path").alias("path"), F.col("t.sizes").alias("sizes"))


class Rows:
    """Rows of a slice in order: paths, what each shares with the row before, and weights by depth."""

    def __init__(self, rows: pa.Table):
        path = rows["path"].combine_chunks()
        self.length = np.asarray(path.value_lengths(), np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.turns = np.frombuffer(b"".join(path.flatten().to_pylist()), "<u8").reshape(-1, KEY_BYTES // 8)
        self.sizes = np.asarray(rows["sizes"].combine_chunks().flatten(), np.int64)
        self._common()
        width = np.asarray(rows["n"].combine_chunks().value_lengths(), np.int64)
        row = np.repeat(np.arange(len(self.length)), width)
        begun = np.concatenate([[0], np.cumsum(width)])[:-1]
        depth = (self.length - width + 1)[row] + np.arange(len(row)) - begun[row]
        order = np.lexsort((row, -depth))
        self.row, self.depth = row[order], depth[order]
        self.weights = {w: np.asarray(rows[w].combine_chunks().flatten(), np.int64)[order] for w in WEIGHTS}

    def _common(self) -> None:
        """``common[i]``: turns that row i shares with the row before it, and range minima over them."""
        n = len(self.length)
        row = np.repeat(np.arange(n), self.length)
        place = np.arange(self.at[-1]) - self.at[row]
        before = np.maximum(row - 1, 0)
        same = (row > 0) & (place < self.length[before])
        same[same] = (self.turns[same] == self.turns[(self.at[before] + place)[same]]).all(axis=1)
        end = np.where(same, self.length[row], place)
        common = np.zeros(n, np.int64)
        some = self.length > 0
        if len(end):
            common[some] = np.minimum.reduceat(end, self.at[:-1][some])
        self.minima = [common]
        while 1 << len(self.minima) <= n:
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))
        first, last = common.copy(), np.append(common[1:], self.length[-1])
        first[0] = self.length[0]
        self.with_first = np.minimum.accumulate(first)
        self.with_last = np.minimum.accumulate(last[::-1])[::-1]

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Turns that rows a < b and all between share; unbounded where a is b."""
        out = np.full(len(a), UNSEEN)
        apart = np.flatnonzero(b > a)
        level = np.frexp((b - a)[apart].astype(float))[1] - 1
        for k in np.unique(level):
            i = apart[level == k]
            out[i] = np.minimum(self.minima[k][a[i] + 1], self.minima[k][b[i] + 1 - (1 << k)])
        return out

    def key(self, row: int, depth: int) -> bytes:
        return hashlib.sha256(self.turns[self.at[row]:self.at[row] + depth].tobytes()).digest()[:KEY_BYTES]


class Out:
    """Found nodes and runs of ids, as columns."""

    def __init__(self):
        self.parts: list[dict] = []

    def add(self, n: int, **columns) -> None:
        self.parts.append({"n": n, **columns})

    def batches(self) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in self.parts:
            n = part["n"]
            held.append(pa.RecordBatch.from_arrays(
                [pa.array(part[f.name], f.type) if f.name in part else pa.nulls(n, f.type) for f in _found], schema=_found))
            if sum(b.num_rows for b in held) >= OUT_ROWS:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches(OUT_ROWS)
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(OUT_ROWS)


def peel(rows: pa.Table, *, raw: bool, whole: bool) -> Iterator[pa.RecordBatch]:
    """Peel a slice: finished nodes, runs of ids of unfinished ones, and at most two spines.

    ``raw`` rows are conversations (their ids are at hand); others are spines. With ``whole``
    there is no other slice, and everything is finished.
    """
    r, out = Rows(rows), Out()
    last = len(r.length) - 1
    spines = {i: {w: np.full(r.length[i] + 1, UNSEEN if w == "low" else 0, np.int64) for w in WEIGHTS} for i in {0, last}}
    used: set[int] = set()
    none = np.zeros(0, np.int64)
    below = {"row": none, "conv_id": none, "n_convs": none, "n_children": none, "n_leaves": none, "saved_tokens": none,
             "ends_sha256": [], "key": []}
    at = 0
    for depth in range(int(r.length.max()), -1, -1):
        upto = at + int(np.searchsorted(-r.depth[at:], -depth, side="right"))
        ended, at = slice(at, upto), upto
        kids = len(below["row"])
        item = np.concatenate([below["row"], r.row[ended]])
        order = np.argsort(item, kind="stable")
        item = item[order]
        if not len(item):
            continue
        new = np.concatenate([[True], r.shared(item[:-1], item[1:]) < depth])
        start = np.flatnonzero(new)
        group = np.empty(len(item), np.int64)
        group[order] = np.cumsum(new) - 1
        own = {w: v[ended] for w, v in r.weights.items()}

        def total(from_below: np.ndarray, weight: str, how=np.add) -> np.ndarray:
            return how.reduceat(np.concatenate([from_below, own[weight]])[order], start)

        n, low = total(below["n_convs"], "n"), total(below["conv_id"], "low", np.minimum)
        n_children, leaves = total(np.ones(kids, np.int64), "kids"), total(below["n_leaves"], "leaves")
        saved, ends = total(below["saved_tokens"], "saved"), total(np.zeros(kids, np.int64), "ended", np.maximum)
        top = item[start]
        from_first = np.zeros(len(top), bool) if whole else r.with_first[top] >= depth
        open_ = from_first | (np.zeros(len(top), bool) if whole else r.with_last[top] >= depth)
        keys = {g: r.key(top[g], depth) for g in np.flatnonzero(open_ if raw else np.ones(len(top), bool))}

        # the children's parents are known now
        parent = group[:kids]
        pending = open_[parent]
        if kids:
            out.add(kids, depth=np.full(kids, depth + 1), parent_conv_id=pa.array(low[parent], mask=pending),
                    up=[keys[g] if p else None for g, p in zip(parent, pending)] if pending.any() else pa.nulls(kids, pa.binary()),
                    **{k: v for k, v in below.items() if k != "row"})

        # runs of ids that end here, by group
        ids: dict[int, list[int]] = {}
        if raw:
            for g, conv_id in zip(group[kids:].tolist(), own["low"].tolist()):
                ids.setdefault(g, []).append(conv_id)
        for g in np.flatnonzero(open_):
            spine = 0 if from_first[g] else last
            used.add(spine)
            for w, v in zip(WEIGHTS, (n, low, n_children, leaves, saved, ends)):
                spines[spine][w][depth] = v[g]
            if g in ids:
                out.add(1, key=[keys[g]], first_id=[ids[g][0]], ids=[",".join(map(str, ids[g]))])

        done = np.flatnonzero(~open_)
        size = r.sizes[r.at[top[done]] + depth - 1] if depth else np.zeros(len(done), np.int64)
        below = {
            "row": top[done], "conv_id": low[done], "n_convs": n[done], "n_children": n_children[done],
            "n_leaves": np.where(n_children[done] == 0, 1, leaves[done]), "saved_tokens": saved[done] + (n[done] - 1) * size,
            "ends_sha256": [hashlib.sha256(",".join(map(str, ids[g])).encode()).hexdigest() if g in ids
                            else None if ends[g] else NO_ENDS for g in done.tolist()],
            "key": [None] * len(done) if raw else [keys[g] for g in done.tolist()]}
    root = len(below["row"])
    if root:
        out.add(root, depth=np.zeros(root, np.int64), **{k: v for k, v in below.items() if k != "row"})
    for i in sorted(used):
        path = [t.tobytes() for t in r.turns[r.at[i]:r.at[i + 1]]]
        out.add(1, spine=[{"path": path, "sizes": r.sizes[r.at[i]:r.at[i + 1]].tolist(),
                           **{w: v.tolist() for w, v in spines[i].items()}}])
    yield from out.batches()


def _peeled(rows: DataFrame, *, raw: bool, whole: bool) -> DataFrame:
    """Peel each partition of ordered rows; the result is a written table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from peel(pa.Table.from_batches(held), raw=raw, whole=whole)

    return written(rows.mapInArrow(task, FOUND), "peeled")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, whose runs come in order."""
    key, state, done = None, None, []
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            if k != key:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
    if state:
        done.append((key, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())],
                                     ["key", "hashed"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (or ``grafted``) conversations.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (null at the root),
    ``n_leaves`` and ``saved_tokens`` are of the subtree with its top, ``ends_sha256`` hashes
    the ascending ids of the conversations that end in the node. Conversation ids are unique.
    A conversation without turns is a member of the root alone. No conversation, no node.
    """
    spark = conversations.sparkSession
    ready(spark)
    one = F.array(F.lit(1).cast("long"))
    zero = F.array(F.lit(0).cast("long"))
    rows = written(conversations.select(
        "path", "sizes", one.alias("n"), F.array("conv_id").alias("low"), zero.alias("kids"), zero.alias("leaves"),
        zero.alias("saved"), one.alias("ended")), "paths")
    turns = rows.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()[0]
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SLICE_TURNS))
    order = ["path", "low"]
    rounds = [_peeled(rows.repartitionByRange(slices, *order).sortWithinPartitions(*order), raw=True, whole=False)]
    spines = rounds[0].where("spine is not null").select("spine.*")
    while (n := spines.count()) > TOGETHER:
        again = spines.repartitionByRange(-(-n // TOGETHER), *order).sortWithinPartitions(*order)
        rounds.append(_peeled(again, raw=False, whole=False))
        spines = rounds[-1].where("spine is not null").select("spine.*")
    rounds.append(_peeled(spines.coalesce(1).sortWithinPartitions(*order), raw=False, whole=True))

    runs = rounds[0].where("ids is not null").select("key", "ids", "first_id")
    hashed = runs.repartition("key").sortWithinPartitions("key", "first_id").select("key", "ids").mapInArrow(
        _hashed, "key binary, hashed string")
    late = rounds[1].where("n_convs is not null")
    for found in rounds[2:]:
        late = late.union(found.where("n_convs is not null"))
    early = rounds[0].where("n_convs is not null")
    salts = 16  # the children of one node, the root say, may be most nodes
    salt = fresh(early, "salt")
    parents = late.select(F.col("key").alias("up"), F.col("conv_id").alias("parent"),
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(salt))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    def placed(nodes: DataFrame) -> DataFrame:
        known = nodes.where("up is null").select(*columns)
        waiting = nodes.where("up is not null").withColumn(salt, F.pmod(F.xxhash64("conv_id"), F.lit(salts)).cast("int"))
        return known.union(waiting.join(parents, ["up", salt]).withColumn("parent_conv_id", F.col("parent")).select(*columns))

    late = late.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "hashed")).drop("hashed")
    return placed(early).union(placed(late))
