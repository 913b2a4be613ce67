"""Token files, packing, SimHash groups, digests, shards and mixes against brute force and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortix.llm import digests, mixing, packing, sharding, simhash, tokenbin
from cohortix.llm.queries import llm_queries
from cohortix.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text", "source").orderBy("doc_id").collect()]


# ---- token ids --------------------------------------------------------------
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_tokenizer(path):
    rnd = random.Random(3)
    marks = [" ", "  ", "\n", "\t", " ", "　", "a", "the", "É", "ß", "1", "12", "§", ".", "!?", "'s", "\x85",
             "\x1c", "́", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "日本", "😀", "​", "_", "\r\n", "º", "word.\nWord", "x,"]
    texts = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 25))) for _ in range(4_000)]
    whole = Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert Encoder(path).encode(texts) == want


def test_token_file_round_trip(spark, sf_dir):
    docs = documents(spark, sf_dir)
    whole = Tokenizer.from_file(BYTE)
    got = {r["doc_id"]: r for r in llm_queries()["op1_token_ids"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    start = 0
    for doc_id, text, _ in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        row = got[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_file_of_an_odd_table(spark, odd, none, tmp_path):
    tokenbin.write_tokens(odd, str(tmp_path / "odd"), BYTE, end_id=2)
    rows = tokenbin.read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [1, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, None, None]
    assert [r["n_tokens"] for r in rows][3:5] == [1, 1]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    some = tokenbin.read_tokens(spark, str(tmp_path / "odd"), [6, 99]).collect()
    assert [(r["doc_id"], r["ids"]) for r in some] == [(r["doc_id"], r["ids"]) for r in rows if r["doc_id"] == 6]
    tokenbin.write_tokens(none, str(tmp_path / "none"), BYTE, end_id=2)
    assert tokenbin.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_token_file_refuses_another_dictionary(spark, odd, tmp_path):
    for name, docs in (("a", odd), ("b", odd.where("doc_id = 6"))):
        tokenbin.write_tokens(docs, str(tmp_path / name), BYTE, end_id=2)
    other = spark.read.parquet(str(tmp_path / "b" / "dictionary")).withColumn("dictionary", F.lit(b"x").cast("binary"))
    other.write.parquet(str(tmp_path / "c" / "dictionary"))
    spark.read.parquet(str(tmp_path / "a" / "blocks")).write.parquet(str(tmp_path / "c" / "blocks"))
    with pytest.raises(ValueError, match="dictionary"):
        tokenbin.read_tokens(spark, str(tmp_path / "c")).collect()


# ---- packing ----------------------------------------------------------------
def brute_first_fit(sizes, length):
    free, place = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        q = next((q for q, f in enumerate(free) if f >= sizes[i]), len(free))
        if q == len(free):
            free.append(length)
        place[i] = q, length - free[q]
        free[q] -= sizes[i]
    return [place[i] for i in range(len(sizes))]


def test_tournament_is_first_fit_decreasing():
    rnd = random.Random(5)
    for _ in range(200):
        sizes = [rnd.randint(1, 64) for _ in range(rnd.randint(0, 60))]
        assert packing.first_fit_decreasing(sizes, 64) == brute_first_fit(sizes, 64)


def check_packed(pieces, ids_of, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, parts in by_doc.items():
        joined = b"".join(bytes(p["ids"]) for p in sorted(parts, key=lambda p: p["start"]))
        assert joined == ids_of[doc_id]
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and len(p["ids"]) == 4 * p["length"]
            at += p["length"]
        assert 0 < at <= length
    used = [sum(p["length"] for p in parts) for parts in by_sequence.values()]
    return sum(0 if n & (n - 1) == 0 else length - n for n in used) / max(1, sum(used))


def test_packing_holds_every_id_once(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = Tokenizer.from_file(WORD)
    ids = {d: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
           for d, t, _ in documents(spark, sf_dir)}
    pieces = [r.asDict() for r in packing.pack(table, WORD, end_id=1).collect()]
    assert {p["doc_id"] for p in pieces} == set(ids)
    assert check_packed(pieces, ids, 2_048) < 0.01


def test_packing_an_odd_table_in_small_groups(odd, none):
    pieces = packing.pack(odd, WORD, end_id=1, length=64, group_docs=3).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 3) == 1
    assert Counter(p["doc_id"] for p in pieces)[None] >= 2
    assert all(p["length"] <= 64 for p in pieces)
    starts = Counter((p["doc_id"], p["start"]) for p in pieces)
    assert starts[1, 0] == 2  # a repeated row is packed as often as it comes
    assert packing.pack(none, WORD, end_id=1).count() == 0


# ---- SimHash ----------------------------------------------------------------
def brute_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(ids, linked):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_simhash_groups_equal_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    prints = [brute_print(t) for _, t, _ in docs]
    want = brute_components([d for d, *_ in docs], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = {r["doc_id"]: r for r in llm_queries()["op5_simhash"](spark, sf_dir).collect()}
    for (doc_id, *_), p, c in zip(docs, prints, want):
        assert (got[doc_id]["fingerprint"], got[doc_id]["component_id"]) == (f"{p:016x}", c)


def test_simhash_links_chains_at_distance_two(spark):
    rnd = random.Random(9)
    prints = [rnd.getrandbits(64)]
    for _ in range(40):
        p = rnd.choice(prints)
        for b in rnd.sample(range(64), rnd.choice([1, 2, 3])):
            p ^= 1 << b
        prints.append(p)
    prints = sorted(set(prints))
    want = brute_components(list(range(len(prints))), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    root = dict(map(tuple, simhash.roots(table, "print", 2).collect()))
    found = defaultdict(set)
    for i, p in enumerate(signed):
        found[root.get(p, p)].add(i)
    expected = defaultdict(set)
    for i, c in enumerate(want):
        expected[c].add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    with pytest.raises(ValueError):
        simhash.links(table, "print", 3)


def test_simhash_on_an_odd_table(odd, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 8)}
    assert by_id[2]["component_id"] == 1  # only the case differs
    assert {by_id[i]["fingerprint"] for i in (3, 4, 5)} == {"0" * 16}
    assert {by_id[i]["component_id"] for i in (3, 4, 5)} == {3}
    assert simhash.simhash_groups(none).count() == 0


def test_dropping_near_copies_keeps_one_per_group(odd, none):
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert Counter(r[0] for r in rows)[1] == 1 and 2 not in [r[0] for r in rows]
    assert len([r for r in rows if not (r[1] or "").strip()]) == 1
    assert (None, "No id here at all") in rows
    assert simhash.drop_near_copies(none).count() == 0


# ---- digests ----------------------------------------------------------------
def test_digest_selection_equals_brute_force():
    rnd = random.Random(1)
    sizes = [0, 5, 63, 64, 65, 127, 128, 400, 900]
    texts = [bytes(rnd.choice(b"abcde  the") for _ in range(rnd.choice(sizes))) for _ in range(40)]
    ranks = np.array(rnd.sample(range(digests.BINS), digests.BINS), np.int32)
    together = digests.digests(texts, ranks)
    for text, chain in zip(texts, together):
        assert np.array_equal(chain, digests.digests([text], ranks)[0])
        padded = text.ljust(64, b"\0") if text else text
        data = np.frombuffer(padded, np.uint8)
        if not len(data):
            assert not len(chain)
            continue
        rank = ranks[digests.entropy_bins(data)].tolist()
        for i in rnd.sample(range(len(rank)), min(5, len(rank))):
            mass = sum(int(digests._mass[c]) for c in Counter(padded[i:i + 64]).values())
            assert rank[i] == ranks[min(digests.BINS - 1, (digests._full - mass) * digests.BINS // digests._full)]
        wins = Counter(min(range(s, s + 64), key=lambda i: (rank[i], i)) for s in range(len(rank) - 63))
        few = [min(range(len(rank)), key=lambda i: (rank[i], i))] if len(rank) < 64 else []
        want = sorted(i for i, n in wins.items() if n >= digests.WINS) + few
        assert digests.selected(*digests.laid_out([text]), ranks).tolist() == want


def test_no_text_but_the_empty_one_has_an_empty_digest():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"abcde  the") for _ in range(n)) for n in [0, 1, 63, 64, *range(120, 260), 400, 2_000]]
    texts += [b"x" * n for n in (64, 127, 200)] + [bytes(range(64, 128)) * 3, *texts[10:20]]
    ranks = np.array(rnd.sample(range(digests.BINS), digests.BINS), np.int32)
    found = digests.digests(texts, ranks)
    assert [len(d) > 0 for d in found] == [len(t) > 0 for t in texts]
    for text, chain in zip(texts, found):
        assert np.array_equal(chain, digests.digests([text], ranks)[0])
        strict, scaled = (digests.selected(*digests.laid_out([text]), ranks, scaled=s) for s in (False, True)) \
            if text else (np.zeros(0), np.zeros(0))
        assert set(strict) <= set(scaled) and (len(text) < 190 or not len(strict) or np.array_equal(strict, scaled))
    short = [d for t, d in zip(texts, found) if 127 <= len(t) <= 141 and len(set(t)) > 1]
    assert all(digests.likeness(a, b) < 1 for a, b in zip(short[:15], short[1:15]))


def test_digests_of_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)[::-1]
    got = {r["doc_id"]: r for r in llm_queries()["op9_digests"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for (doc_id, text, _), (next_id, following, _) in zip(docs, docs[1:] + docs[:1]):
        row, text, following = got[doc_id], text or "", following or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
        if len(text) > 2_000:
            assert row["near_edited"] > 0.3 and (row["near_next"] < 0.3 or row["fingerprint"] == got[next_id]["fingerprint"])


def test_digests_of_an_odd_table(odd, none, spark):
    rows = digests.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    one = [r for r in rows if r["doc_id"] == 1]
    assert one[0]["fingerprint"] == one[1]["fingerprint"] and 1.0 in [r["near_next"] for r in one]
    empty = [r for r in rows if r["n_chars"] == 0]
    assert {r["fingerprint"] for r in empty} == {""} and len(empty) == 3
    assert digests.fingerprints(none).count() == 0
    alone = digests.fingerprints(odd.where("doc_id = 6")).first()
    assert alone["near_next"] == 1.0


# ---- shards -----------------------------------------------------------------
def test_shards_hold_the_mixture(spark, sf_dir):
    rows = llm_queries()["op3_interleave"](spark, sf_dir).collect()
    source = {d: s for d, _, s in documents(spark, sf_dir)}
    text = {d: (t or "").encode() for d, t, _ in documents(spark, sf_dir)}
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    spread = defaultdict(Counter)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]]))
        spread[source[r["doc_id"]]][r["shard"]] += 1
    for counts in spread.values():
        assert max(counts.values()) - min(counts[s] for s in range(8)) <= 2


def test_shards_by_brute_force(spark):
    table = spark.range(5_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                      F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("source"))
    keyed = table.withColumn("draw", F.xxhash64(F.lit(7), "doc_id", F.xxhash64("text"))).collect()
    buckets = -(-5_000 // sharding.BUCKET_ROWS)
    by_source = defaultdict(list)
    for r in keyed:
        by_source[r["source"]].append((((r["draw"] % 2 ** 64) >> 34) % buckets, r["draw"], r["doc_id"]))
    order = []
    for source, rows in by_source.items():
        for rank, (_, draw, doc_id) in enumerate(sorted(rows)):
            order.append(((2 * rank + 1) / (2 * len(rows)), source, draw, doc_id))
    want = {doc_id: divmod(i, 625) for i, (*_, doc_id) in enumerate(sorted(order))}
    got = sharding.interleave(table, 8).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want


def test_shards_of_an_odd_table(odd, none):
    rows = sharding.interleave(odd, 4).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [3, 3, 4, 4]
    assert rows[0]["s"] == 8 and rows[0]["_draw"] == 6  # other columns are untouched
    assert sharding.interleave(none, 4).count() == 0
    assert sorted(r["shard"] for r in sharding.interleave(odd.limit(2), 8).collect()) == [0, 1]


# ---- mixes ------------------------------------------------------------------
def brute_targets(sizes, weights, share, limit):
    left, out = share * sum(sizes), [0.0] * len(sizes)
    free = [i for i, n in enumerate(sizes) if n]
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > limit * sizes[i]]
        for i in over or free:
            out[i] = float(limit * sizes[i]) if over else left * weights[i] / weight
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in over] if over else []
    return out


def planned(spark, sizes, names=None, weights=mixing.WEIGHTS, block_words=32):
    rows = [(n, int(s)) for n, s in zip(names or [f"s{i:06d}" for i in range(len(sizes))], sizes)]
    table = spark.createDataFrame(rows, "source string, size long")
    return [r.asDict() for r in mixing.plan_sources(table, weights, 1.5, 2, block_words).orderBy("source_number").collect()]


def test_targets_share_the_excess(spark):
    assert [r["target"] for r in planned(spark, [100, 100, 100])] == pytest.approx([200, 250 / 3, 500 / 3])
    assert [r["target"] for r in planned(spark, [10, 0, 5])] == pytest.approx([13.5, 0, 9])
    assert planned(spark, []) == []
    rnd = random.Random(3)
    for n in (1, 2, 7, 60):
        sizes = [rnd.choice([0, 1, 5, 40, 1_000, 90_000]) for _ in range(n)]
        want = brute_targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(n)], 1.5, 2)
        assert [r["target"] for r in planned(spark, sizes)] == pytest.approx(want)


def test_sources_are_numbered_by_code_point(spark):
    names = ["b", None, "é", "", "B", "\U0001F600", "\uFFFD", "a"]
    want = sorted((n for n in names if n is not None), key=lambda n: [ord(c) for c in n]) + [None]
    assert [r["name"] for r in planned(spark, range(1, 9), names)] == want


def test_many_sources_are_mixed_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 7)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    docs = spark.range(600).selectExpr("id doc_id", "repeat('w ', cast(1 + id % 90 as int)) text",
                                       "if(id % 3 = 0, 'hot', cast(id % 130 as string)) source")
    documents_, draws = mixing.mix(docs, block_words=16, shards=4)
    rows = mixing.taken(documents_, draws).collect()
    assert len(rows) == 600 and len({r["source"] for r in rows}) == 131
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    order = sorted(by_source)
    sizes = [sum(r["size"] for r in by_source[s]) for s in order]
    want = brute_targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(order))], 1.5, 2)
    for source, size, target in zip(order, sizes, want):
        group = by_source[source]
        assert {r["source_size"] for r in group} == {size} and group[0]["target"] == pytest.approx(target)
        assert sum(r["taken"] for r in group) == round(group[0]["target"])
        assert all(r["taken"] <= 2 * r["size"] for r in group)
    shards = Counter()
    for r in draws.select("shard", "source", "slot").distinct().collect():
        shards[r["shard"]] += 1
    assert len(shards) == 4


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 10, 97, 1_000):
        order = mixing.Permutation(n, 12345)
        image = order(np.arange(n))
        assert sorted(image.tolist()) == list(range(n))
        assert order(image, back=True).tolist() == list(range(n))
    assert mixing.Permutation(1_000, 1)(np.arange(20)).tolist() != mixing.Permutation(1_000, 2)(np.arange(20)).tolist()


def test_shard_counts_meet_the_slots():
    counts = mixing.shard_counts([50, 7, 0, 143], 9, 3)
    assert counts.sum(axis=0).tolist() == [50, 7, 0, 143]
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1


def test_mix_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents_, draws = mixing.mix(table, block_words=32, shards=5)
    rows = [r.asDict() for r in mixing.taken(documents_, draws).collect()]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    plan = planned(spark, [sum(r["size"] for r in by_source[s]) for s in order], order)
    assert [p["name"] for p in plan] == order
    for p in plan:
        source = mixing.Source(p["source_number"], p["source_size"], p["words"], p["blocks"])
        group = sorted((r for r in by_source[p["name"]] if r["size"]), key=lambda r: r["start"])
        owner = [i for i, r in enumerate(group) for _ in range(r["size"])]
        assert len(owner) == source.size and [r["start"] for r in group] == [owner.index(i) for i in range(len(group))]
        count, blocks = Counter(), Counter()
        if p["slots"]:
            slots = mixing.slots_of(source, 0, p["slots"], 32, 11)
            for b, t in zip(slots["block"].tolist(), slots["take"].tolist()):
                count.update(owner[32 * b:32 * b + t])
                blocks[b] += t > 0
        assert sum(count.values()) == source.words and max(blocks.values(), default=0) <= 2
        assert [r["taken"] for r in group] == [count[i] for i in range(len(group))]
        assert all(r["taken"] <= 2 * r["size"] for r in group)


def test_mix_of_an_odd_table(spark, odd, none):
    documents_, draws = mixing.mix(odd, block_words=8, shards=3)
    rows = mixing.taken(documents_, draws).collect()
    assert len(rows) == odd.count()
    again = mixing.taken(*mixing.mix(odd.repartition(5), block_words=8, shards=3)).collect()
    columns = ("doc_id", "source", "size", "taken", "target")
    key = lambda r: [str(r[c]) for c in columns]
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.taken(*mixing.mix(none)).count() == 0
    mixed = mixing.mixed_documents(odd, block_words=8, shards=3)
    assert mixed.columns == odd.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert words == sum(r["taken"] for r in rows)
    assert mixing.mixed_documents(none).count() == 0


def test_stretches_keep_the_space_between_words():
    text = "a  b\nc d\te"
    assert mixing.stretches_of(text, [(0, 2), (2, 3)]) == text
    assert mixing.stretches_of(text, [(0, 2), (3, 1)]) == "a  b\nd"
