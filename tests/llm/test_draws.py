"""Fingerprints, importance resampling and lexical search against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sectorloom.llm import fingerprints, lexical, ngram_table, resampling
from sectorloom.llm.terms import terms

from .conftest import prose

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return [w.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))) for w in WORD.findall((text or "").encode())]


def thue_morse(n):
    return "".join("ab"[i.bit_count() % 2] for i in range(n)), "".join("ba"[i.bit_count() % 2] for i in range(n))


# --- words -------------------------------------------------------------------


def test_terms():
    texts = ["Ab ÄB-c9", None, "", "zz", "zz. ", "日本 x", "--"]
    found = terms(pa.array(texts))
    got = found.array().to_pylist()
    assert got == [w for t in texts for w in words_of(t)]
    assert np.diff(found.offsets).tolist() == [len(words_of(t)) for t in texts]
    data, starts, ends = found.joined()
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == got
    assert len(terms(pa.array([], pa.string()))) == 0


# --- n-gram table ------------------------------------------------------------


def test_table_against_the_library():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(0, 3, 9000, dtype=np.uint8), np.zeros(8, np.uint8)])
    lengths = np.concatenate([rng.integers(0, 80, 3000), [255, 256, 257, 4000]])
    starts = rng.integers(0, 5000, len(lengths))
    cut = [data[a : a + n].tobytes() for a, n in zip(starts, lengths)]
    assert ngram_table.xxh64(data, starts, lengths).tolist() == [xxhash.xxh64_intdigest(x) for x in cut]
    # Also where all keys collide, so that only the bytes tell strings apart.
    for keys in (None, np.zeros(len(starts), np.uint64)):
        table = ngram_table.Interned(data, starts, lengths, keys)
        slot = dict(zip(cut, table.slots.tolist()))
        assert [slot[x] for x in cut] == table.slots.tolist()
        assert len(set(slot.values())) == len(slot) == len(table.used)
        assert Counter(cut) == {cut[table.owner[s]]: table.count[s] for s in table.used}


def test_joined_checksums():
    parts = [(b"", b""), (b"a", b""), (b"", b"xyz"), (b"hello", b" world" * 50_000)]
    a, b = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    got = ngram_table.crc_joined(a, b, np.array([len(p[1]) for p in parts]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in parts]


# --- importance resampling ---------------------------------------------------


def features_of(text):
    w = words_of(text)
    return [b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def drawn_by_hand(rows, targets):
    bucket = lambda f: zlib.crc32(f) % 10_000
    s = Counter(bucket(f) for _, t in rows for f in features_of(t))
    t = Counter(bucket(f) for x in targets for f in features_of(x))
    all_s, all_t = s.total() + 10_000, t.total() + 10_000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))
    out = []
    for doc_id, text in rows:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in features_of(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(features_of(text)), weight, score, None])
    able = [x for x, (_, text) in zip(out, rows) if len(words_of(text)) >= 20]
    able.sort(key=lambda x: (-x[3], x[0] is None, x[0]))
    for place, x in enumerate(able[: len(able) * 5 // 100]):
        x[4] = place + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling(spark, docs, no_docs):
    target = spark.createDataFrame([(1, prose(7, 80)), (2, None), (3, "")], "item_id bigint, text string")
    more = [(100 + i % 90, prose(i % 50, 15 + i % 12)) for i in range(300)]
    more += [(None, prose(3, 40))] * 150
    more.append((7, " ".join(thue_morse(4096)) + " x" * 30))
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = rows.withColumn("weight", F.lit("x")).withColumn("bucket", F.lit(1))
    expected = drawn_by_hand([(r.doc_id, r.text) for r in rows.collect()], [prose(7, 80)])
    assert sum(x[4] is not None for x in expected) > 10
    got = resampling.resample(rows, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert resampling.resample(no_docs, target).collect() == []
    assert {r.weight is None for r in resampling.resample(docs, target.where("false")).collect()} == {False}


# --- lexical search ----------------------------------------------------------


def found_by_hand(rows, items):
    held = [(i, Counter(words_of(t))) for i, t in rows if words_of(t)]
    n_docs, n_words = len(held), sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            norm = 50 + 50 * c.total() * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * norm))
                for w in set(words_of(text)) & c.keys()
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort()
        out += [(item_id, rank + 1, doc, -s) for rank, (s, _, doc) in enumerate(scores[:50])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("pass_bytes", [300, 1 << 20])
def test_search(spark, docs, no_docs, monkeypatch, pass_bytes):
    monkeypatch.setattr(lexical, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(lexical, "FLAG_BYTES", 1 << 12)
    monkeypatch.setattr(lexical, "GROUPS", 2)
    common = [(200 + i, f"the of w{i % 7} {prose(i % 5, i % 9)}") for i in range(400)] + [(None, "the of")] * 70
    a, b = thue_morse(4096)
    common += [(900, a), (901, b)]
    rows = docs.unionByName(
        spark.createDataFrame(common, "doc_id bigint, text string"), allowMissingColumns=True
    ).repartition(7)
    wide = " ".join(f"w{i}" for i in range(200))
    texts = ["the of", "The THE of", "one two", None, "", "...", "nowhere", prose(1, 30), wide, "日本語", a, "the w1"]
    items = [(i % 9, t) for i, t in enumerate(texts)] + [(None, "w2 w3")]
    found = lexical.search(rows, spark.createDataFrame(items, "item_id bigint, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = found_by_hand([(r.doc_id, r.text) for r in rows.collect()], items)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert lexical.search(rows, nothing).collect() == []
    assert lexical.search(no_docs, spark.createDataFrame(items, "item_id bigint, text string")).collect() == []


def test_chunk_is_left_when_the_rest_cannot_enter():
    """After the best are known, groups whose maximum is lower are not scored."""
    texts = ["rare common"] * 3 + [f"common filler{i}" for i in range(200)]
    items = lexical.Items.of([1], ["rare common"])
    part = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    chunk = lexical.Chunk(lexical._chunk(part, items.vocabulary), 2, len(texts), 2 * len(texts))
    scored = []
    best = lexical.Best(3)
    add = best.add
    best.add = lambda scores, *rest: (scored.append(len(scores)), add(scores, *rest))
    lexical.GROUPS, before = 1, lexical.GROUPS
    try:
        chunk.search(items.wanted[0], np.array([5000, 10]), best)
    finally:
        lexical.GROUPS = before
    assert scored == [3] and best.ids.tolist() == [0, 1, 2]


# --- fingerprints ------------------------------------------------------------


def spark_hash(values, seed=42):
    for value in values:
        seed = xxhash.xxh64_intdigest(value, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def fingerprint_by_hand(text):
    text = text or ""
    found = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w] or ([text] if text else [])
    shingles = [found[i : i + 5] for i in range(max(1, len(found) - 4))] if found else []
    lowest = {}
    for shingle in shingles:
        h = spark_hash([w.encode() for w in shingle])
        lowest[h >> 57] = min(h, lowest.get(h >> 57, 1 << 63))
    if not lowest:
        return ""
    out = ""
    for place in range(-64, 64):
        bits = lowest.get(place, 0) & 255
        if place not in lowest:
            ranks = [
                spark_hash([x.to_bytes(8, "little", signed=True)], pair_seed(place)) & ~255 | h & 255
                for x, h in lowest.items()
            ]
            bits = min(ranks) & 255
        out += f"{bits:02x}"
    return out


def pair_seed(place):
    seed = xxhash.xxh64_intdigest((place & 0xFFFFFFFF).to_bytes(4, "little"), 42)
    return seed


def test_fingerprint_against_brute_force(docs):
    rows = fingerprints.fingerprinted(docs.select("doc_id", "text"), "text", "fp").collect()
    assert len({len(r.fp) for r in rows} - {0, 256}) == 0
    for r in rows:
        assert r.fp == fingerprint_by_hand(r.text), r.doc_id


def test_likeness_is_unbiased(spark):
    base = [f"a{i}" for i in range(400)]
    rows = [
        (share, seed, " ".join(f"s{seed}{w}" for w in base), " ".join(f"s{seed}{w}" for w in base[: 4 * share] + [f"b{i}" for i in range(400 - 4 * share)]))
        for share in (0, 30, 60, 90, 100)
        for seed in range(40)
    ]
    df = spark.createDataFrame(rows, "share int, seed int, a string, b string")
    df = fingerprints.fingerprinted(fingerprints.fingerprinted(df, "a", "fa"), "b", "fb")
    means = df.groupBy("share").agg(F.avg(fingerprints.likeness(F.col("fa"), F.col("fb"))).alias("m")).collect()
    for share, mean in means:
        same = max(0, 4 * share - 4)
        true = 1.0 if share == 100 else same / (2 * 396 - same)
        assert abs(mean - true) < 0.03, (share, mean, true)


def neighbours_by_hand(rows):
    """What any order of rows with equal ids allows: edited digests by row."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(a, ordered[(i + 1) % len(ordered)]) for i, a in enumerate(ordered)]


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_compared(spark, n):
    rows = [((i * 37) % 1009 - 300, None if i == 5 else prose(i, i % 40) + "é" * (i % 3)) for i in range(n)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, fingerprint string")
    got = {r.doc_id: r for r in fingerprints.compared(df.repartition(5)).collect()}
    assert len(got) == n
    for (doc_id, text), (_, following) in neighbours_by_hand(rows):
        text, following = text or "", following or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprint_by_hand(text)
        assert r.edited_fingerprint == fingerprint_by_hand(edited)
        same = [
            sum(r.fingerprint[i : i + 2] == x[i : i + 2] for i in range(0, 256, 2)) / 128
            for x in (r.edited_fingerprint, fingerprint_by_hand(following))
        ]
        for value, p, x in zip((r.near_edited, r.near_next), same, (r.edited_fingerprint, fingerprint_by_hand(following))):
            if r.fingerprint == x:
                assert value == 1
            elif "" in (r.fingerprint, x):
                assert value == 0
            else:
                assert value == pytest.approx(max(0, (p - 1 / 256) / (255 / 256)))


def test_compared_with_shared_ids(spark, docs, no_docs):
    """A third of the rows without an id and a third with the same one: each row still has one next, in a ring."""
    rows = [(None, f"none {i}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)]
    rows += [(i - 150, f"own {i}") for i in range(300) if i - 150 != 7]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    placed, heads, copied = fingerprints._ranges(df)
    sizes = [r["count"] for r in placed.groupBy("__range").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 120 and not copied
    assert heads.count() == len(sizes)
    following = next_texts(df)
    assert sorted(following) == sorted(following.values()) == sorted(t for _, t in rows)
    text = min(following)
    seen = {text}
    while (text := following[text]) not in seen:
        seen.add(text)
    assert len(seen) == len(rows)
    got = fingerprints.compared(docs).collect()
    assert len(got) == docs.count()
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert fingerprints.compared(no_docs).collect() == []


def test_compared_with_many_equal_rows(spark):
    """Equal rows follow each other; only the last of them is followed by something else."""
    many = {(3, "c d e f g h i"): 200, (None, None): 200, (5, "x y"): 1, (1, "a b c d e f g"): 1}
    rows = [row for row, n in many.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    placed, _, copied = fingerprints._ranges(df.na.fill(""))
    assert sorted((x[0], x[2]) for x in copied) == [(-(2**63), 200), (3, 200)]
    expected = Counter()
    for (doc_id, text), (_, following) in neighbours_by_hand(rows):
        text, following = text or "", following or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        expected[doc_id, hashlib.sha256(edited.encode()).hexdigest(), fingerprint_by_hand(edited)] += 1
    got = fingerprints.compared(df).collect()
    assert Counter((r.doc_id, r.edited_sha256, r.edited_fingerprint) for r in got) == expected


def next_texts(df):
    """text -> the text after it, read from edited texts of which all but the marks is replaced."""
    marked = df.withColumn("text", F.concat("text", F.lit("|")))
    n = 200
    wide = marked.withColumn("text", F.rpad("text", n, "."))
    placed = {}
    edited = {r.edited_sha256: r.doc_id for r in fingerprints.compared(wide).collect()}
    texts = [r.text for r in wide.collect()]
    third = n // 3
    heads = {t[:third]: t for t in texts}
    for text in texts:
        for head, other in heads.items():
            digest = hashlib.sha256((text[: n - third] + head).encode()).hexdigest()
            if digest in edited:
                placed[text.split("|")[0]] = other.split("|")[0]
    return placed
