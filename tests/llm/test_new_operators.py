"""The conversation trie, hard negatives and WARC records against brute force, and on odd tables."""

import base64
import gzip
import hashlib
import json
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect
from pyspark.sql import functions as F

from cohortix.llm import negatives, trie, warc
from cohortix.llm.queries import llm_oracles, llm_queries

CONVERSATIONS = "conv_id long, turn long, role string, text string, path string, salt int, up string"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, sf_dir, name):
    got = llm_queries()[name](spark, sf_dir)
    cursor = connect(sf_dir).execute(llm_oracles()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


# ---- conversations ----------------------------------------------------------
def brute_rebuilt(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in said.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    return out


def brute_trie(rebuilt):
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(node))
        leaves = [n for n in below if not any(m[:-1] == n for m in below if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_conversations(seed, convs=60):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 500), convs):
        for turn in range(rnd.randint(1, 6) if c % 17 else 40):
            rows.append((c, turn if rnd.random() < 0.9 else None, rnd.choice(["user", "é", None]), rnd.choice(["a", "bb", "", None])))
    copies = [(1000 + i, t, "user", x) for i in range(30) for t, x in enumerate(["same", "first", "turns"][:1 + i % 3])]
    rnd.shuffle(rows)
    return rows + copies + rows[:5] + [(None, 0, "user", "no conversation"), (None, None, None, None)]


def trie_of(spark, rows):
    table = spark.createDataFrame([(*r, "own", 1, "up") for r in rows], CONVERSATIONS)
    own = trie.paths(table)
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    found = trie.prefix_trie(trie.grafted(own, F.col("conv_id") - F.col("conv_id") % 5, heads, 8))
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = random_conversations(seed)
    assert trie_of(spark, rows) == brute_trie(brute_rebuilt(rows))


def test_trie_in_many_slices_and_rounds(spark, monkeypatch):
    """More slices than one task peels, so that spines are peeled several times."""
    monkeypatch.setattr(trie, "SLICE_TURNS", 12)
    monkeypatch.setattr(trie, "TOGETHER", 6)
    rows = random_conversations(3)
    assert trie_of(spark, rows) == brute_trie(brute_rebuilt(rows))


def test_trie_without_conversations(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "a")]) == []


def test_a_conversation_can_lose_all_turns(spark):
    """Its base is absent and it is no longer than the replaced head."""
    c = next(c for c in range(11, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    assert trie_of(spark, [(c, 0, "user", "a"), (c, 1, "user", "b")]) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_long_turns_and_deep_conversations(spark):
    rows = [(5 * c, t, "user", "x" * (200_000 if t == 2 else 1)) for c in range(2) for t in range(3)]
    rows += [(15, t, "user", str(t)) for t in range(3_000)]
    found = {(r[0], r[1]): r for r in trie_of(spark, rows)}
    assert len(found) == 1 + 3 + 3_000 and found[(0, 0)][6] == 200_002 and found[(0, 3)][3] == 2
    assert found[(15, 3_000)][2] == 15 and found[(0, 0)][5] == 2


# ---- hard negatives ---------------------------------------------------------
def brute_negatives(rows, every, positives=5, negatives_=10):
    whole = []
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = tuple(math.floor(256 * x) for x in v)
        if (i, label, ints) not in seen:
            seen.add((i, label, ints))
            whole.append((i, label, ints))
    out = []
    for a, la, va in whole:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in whole if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            fit = [x for x in scored if x[2] != la and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives_]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i, _) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dims, spread=1.0):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 3), [rnd.gauss(0, spread) for _ in range(rnd.choice([dims, dims, 3]))]) for i in range(n)]
    rows += [(None, 1, [1.0]), (4, None, [1.0]), (8, 2, None), (10, 1, [float("nan"), 1.0]), (20, 1, [None, 1.0]),
             (30, 1, [float("-inf")]), (50, 1, []), rows[10], rows[0]]
    return rows


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, 1, 2, "own") for r in rows],
                                  "vec_id long, label int, embedding array<double>, a int, c int, id string")
    got = negatives.hard_negatives(table, **more)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("dims, spread", [(13, 1.0), (8, 0.02), (5, 3e6)])
def test_negatives_equal_brute_force(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "CANDIDATES", 90)
    monkeypatch.setattr(negatives, "FIRST", 16)
    monkeypatch.setattr(negatives, "CHUNK", 32)
    rows = vectors(7, 400, dims, spread)
    assert mined(spark, rows, anchor_every=20) == brute_negatives(rows, 20)


def test_equal_scores_go_by_id(spark):
    rows = [(i, i % 2, [1.0, 0.0] if i % 2 == 0 else [0.5, 0.0]) for i in range(60)]
    got = mined(spark, rows, anchor_every=50)
    assert got == brute_negatives(rows, 50) and [r[3] for r in got if r[0] == 0 and r[1] == 2] == list(range(1, 20, 2))


def test_no_anchor_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    assert mined(spark, [(100, 1, [1.0]), (2, 2, [0.5])]) == []  # no positive


def test_planes_hold_all_integers_and_scores_are_exact():
    rnd = np.random.default_rng(3)
    for most in (0, 1, 160, 2**20, 2**62):
        values = rnd.integers(-most - 1, most + 1, (50, 11), dtype=np.int64)
        bits = max(int(v if v >= 0 else -1 - v).bit_length() for v in values.flat) + 1
        shape = negatives.Shape(bits, 2, most < 1000)
        packed = negatives.packed(pa.array(values.tolist(), pa.list_(pa.int64())), shape)
        assert (negatives.components_of(packed, shape)[:, :11] == values).all()
        got = negatives.scores(negatives.tables(negatives.components_of(packed[:7], shape), shape), negatives.plane_bytes(packed, shape), shape)
        assert (got == values @ values[:7].T).all()  # both wrap beyond 64 bits


# ---- WARC -------------------------------------------------------------------
PAGES = "page_id long, url string, html string, first string, row int, same string, heavy int"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def written_pages(spark, rows, folder, **more):
    path = str(folder / "archive")
    warc.write_warc(spark.createDataFrame([(*r, "own", 1, "own", 2) for r in rows], PAGES), path, **more)
    return path


TRICKY = ["<p>one</p>", "", None, "line\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\n", "\r\n\r\n",
          "ends in a line end\n", "ends in two\r\n\r\n", "é" * 1000, "x" * 300_000 + "\n" * 50, "\0\x01\x02", "<p>one</p>", "<p>one</p>"]


def test_round_trip_of_odd_payloads(spark, tmp_path):
    rows = [(100 - i, f"http://h.example/{i} a\r\nX: y" if i % 3 else None, p) for i, p in enumerate(TRICKY)]
    rows += [rows[0], (None, "http://h.example/", "<p>one</p>"), (None, None, "no id")]
    path = written_pages(spark, rows, tmp_path)
    found = warc.resolved(warc.captures(warc.read_records(spark, path))).collect()
    assert len(found) == len(rows)
    first = {}
    for i, _, p in rows:
        payload = (p or "").encode()
        first[payload] = min((v for v in (first.get(payload), i) if v is not None), default=None)
    seen = []
    for r in found:
        about = json.loads(bytes(r.metadata[0].fields))
        payload = bytes(r.response.payload) if r.response.type == "response" else None
        assert len(r.requests) == len(r.metadata) == 1 and r.requests[0].head.startswith("GET ")
        assert r.requests[0].head.count("\n") == 1  # no header of the url's own
        if payload is not None:
            assert r.response.payload_digest == sha(payload) and r.response.intact and r.response.payload_bytes == len(payload)
            assert about["page_id"] == first[payload] and r.original is None
        else:
            payload = next(k for k in first if sha(k) == r.response.payload_digest)
            assert json.loads(bytes(r.original.metadata[0].fields))["page_id"] == first[payload]
            assert r.original.payload_bytes == len(payload)
        seen.append((about["page_id"], about["url"], payload))
    assert sorted(seen, key=repr) == sorted(((i, u, (p or "").encode()) for i, u, p in rows), key=repr)
    assert sum(r.response.type == "response" for r in found) == len(first)


def test_short_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "http://a/", "ab"), (2, "http://a/", "ab"), (3, "http://a/", "long one"), (4, "http://a/", "long one")]
    path = written_pages(spark, rows, tmp_path, least_bytes=3)
    types = [r.type for r in warc.read_records(spark, path).where("type in ('response', 'revisit')").collect()]
    assert sorted(types) == ["response"] * 3 + ["revisit"]


def test_no_pages(spark, tmp_path):
    path = written_pages(spark, [], tmp_path)
    assert warc.resolved(warc.captures(warc.read_records(spark, path))).count() == 0


def foreign(*records):
    out = []
    for kind, name, more, content, block in records:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n"
        head += "".join(f"WARC-Concurrent-To: <{m}>\r\n" for m in more)
        out.append(head.encode() + f"Content-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return out


HTTP = "application/http; msgtype=response"


def test_records_join_from_either_side_and_across_archives(spark, tmp_path):
    """Per-record compression, chains over a request, a response that names its request, members without a response."""
    a = foreign(("warcinfo", "w", [], "application/warc-fields", b"software: x\r\n"),
                ("metadata", "m1", ["q1"], "application/warc-fields", b"a: 1"),
                ("response", "r1", [], HTTP, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\xff\xfe\r\n\r\nmore"),
                ("request", "q2", [], "application/http; msgtype=request", b"GET / HTTP/1.1\r\n\r\n"))
    b = foreign(("request", "q1", ["r1"], "application/http; msgtype=request", b"GET /1 HTTP/1.1\r\n\r\n"),
                ("response", "r2", ["q2"], HTTP, b"HTTP/1.1 404 Not Found\r\n\r\n"),
                ("metadata", "m3", ["lost"], "text/plain", b""), ("request", "q3", ["lost"], "application/http", b"GET"),
                ("resource", "r4", [], "image/png", b"\x89PNG\n\n"))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, a)))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(b)))
    found = {r.capture: r for r in warc.captures(warc.read_records(spark, str(tmp_path))).collect()}
    assert set(found) == {"<r1>", "<r2>", "<r4>", "<lost>"}
    assert bytes(found["<r1>"].response.payload) == b"body\xff\xfe\r\n\r\nmore"
    assert [m.record_id for m in found["<r1>"].metadata] == ["<m1>"] and found["<r1>"].requests[0].record_id == "<q1>"
    assert found["<r2>"].requests[0].record_id == "<q2>" and found["<r2>"].response.payload_bytes == 0
    assert found["<lost>"].response is None and len(found["<lost>"].requests) == len(found["<lost>"].metadata) == 1
    assert bytes(found["<r4>"].response.payload) == b"\x89PNG\n\n"


def test_a_cut_archive_fails(spark, tmp_path):
    whole = foreign(("response", "r1", [], HTTP, b"HTTP/1.1 200 OK\r\n\r\nbody of some length"))[0]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(whole[:-12]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(tmp_path)).count()


def test_one_payload_on_most_pages(spark, tmp_path, monkeypatch):
    """The broadcast side of the join that a common key takes, beside the shuffled one."""
    monkeypatch.setattr(warc, "HEAVY", 4)
    rows = [(i, f"http://h/{i}", "same" if i % 3 else f"own {i % 12}") for i in range(90, 0, -1)]
    found = warc.resolved(warc.captures(warc.read_records(spark, written_pages(spark, rows, tmp_path), payloads=False))).collect()
    page = lambda m: json.loads(bytes(m[0].fields))["page_id"]
    got = {page(r.metadata): page(r.original.metadata) if r.original else None for r in found}
    first = {}
    for i, _, p in reversed(rows):
        first.setdefault(p, i)
    assert got == {i: None if first[p] == i else first[p] for i, _, p in rows}
