"""Token files, byte pairs and shards."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sectorloom.llm import bpe, sharding, token_output
from sectorloom.sources.shared import new_folder


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.integers(0, 1), max_size=400), st.integers(1, 70))
@settings(max_examples=150, deadline=None)
def test_words_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    words, blocks = token_output.pack(ids, block)
    assert (token_output.unpack(words, blocks, len(ids), block) == ids).all()
    assert len(blocks) == -(-len(ids) // block)


def test_escapes_that_look_like_escapes():
    ids = np.array([15 << 60, 15 << 60, 2**64 - 1, 1, 15 << 60] * 300, np.uint64)
    words, blocks = token_output.pack(ids)
    assert (token_output.unpack(words, blocks, len(ids)) == ids).all()


def library_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_files_equal_the_library(spark, docs, no_docs):
    got = [tuple(r) for r in token_output.listing(docs, new_folder(spark, "t")).collect()]
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for doc_id, text in rows:
        ids = library_ids(text)
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert token_output.listing(no_docs, new_folder(spark, "t")).collect() == []


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


AWKWARD = [
    "", " ", "  ", "a  b", " \n b", "a \nb", "a\n  b   c", "don't we'll  'x''s", "\x00a\x01", "tab\tx \x1c y",
    "é ñ x　y", "日本語 テキスト", "x" * 700, "a" + " " * 300 + "b", "👍🏽 ok", "<|endoftext|>", "end ", "\r\n\r\n x",
]


@given(st.lists(st.text(alphabet=" \n\t'abcdeéß.,1　\x85", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_any_text_equals_tiktoken(reference, texts):
    check(reference, [*texts, *AWKWARD])


def check(reference, texts):
    path = public_tokenizers.path(bpe.RANKS)
    ids, counts = bpe.encoder(path, public_tokenizers.PATTERN).encode(texts)
    expected = [reference.encode_ordinary(text) for text in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]
    assert bpe.tables(path).decode(ids, counts) == [text.encode() for text in texts]


def thue_morse(n, first):
    return "".join("ab"[(i.bit_count() + first) % 2] for i in range(n))


def test_words_that_collide_modulo_two_to_the_64(reference):
    """For such words every polynomial hash modulo 2**64 is the same."""
    words = [thue_morse(n, first) for n in (1024, 4096) for first in (0, 1)]
    check(reference, [*words, " ".join(words)])
    path = public_tokenizers.path(token_output.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    ids, counts = token_output.encode(pa.array(words), path)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
        tokenizer.encode(word, add_special_tokens=False).ids for word in words
    ]


def test_long_documents_decode_in_bounded_runs(reference, monkeypatch):
    monkeypatch.setattr(bpe, "TOKENS_AT_ONCE", 7)
    check(reference, ["", "one two three " * 30, "", "é日本" * 20, "x"])
    monkeypatch.undo()
    check(reference, ["word and word, " * 1_000_000, "z"])


def test_packing_of_a_run_does_not_depend_on_its_neighbours():
    small = np.ones(1024, np.uint64)
    alone, _ = token_output.pack(small)
    wide = np.full(64 * 1024, 50_000, np.uint64)
    words, blocks = token_output.pack(np.concatenate([wide, small]))
    assert words[blocks[64] :].tolist() == alone.tolist()


def test_cache_limits_change_nothing(reference, monkeypatch):
    monkeypatch.setattr("sectorloom.llm.pieces.MAX_PIECES", 3)
    for _ in range(3):
        check(reference, AWKWARD)


def test_digests(docs, no_docs, reference):
    expected = []
    for row in docs.collect():
        ids = np.array(reference.encode_ordinary(row.text or ""), "<u4").tobytes()
        expected.append(
            (row.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest())
        )
    assert sorted(map(repr, map(tuple, bpe.digests(docs).collect()))) == sorted(map(repr, expected))
    assert bpe.digests(no_docs).collect() == []


def test_binary_ids():
    got = bpe.binary(np.array([1, 2, 50_000]), np.array([2, 0, 1]))
    assert [len(x) for x in got.to_pylist()] == [8, 0, 4] and isinstance(got, pa.BinaryArray)


def brute_shards(rows, shards):
    """Rank within source by digest, order all by fractional rank, cut evenly."""
    def key(r):
        return (hashlib.md5(f"17:{'' if r[0] is None else r[0]}:{r[3]}:{r[2]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[3], r[2])

    placed = []
    for source in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == source), key=key)
        placed += [((2 * i + 1) / (2 * len(own)), "n" if source is None else "s" + source, key(r), r) for i, r in enumerate(own)]
    placed.sort(key=lambda x: x[:3])
    n = len(placed)
    return sorted((repr(r[0]), r[2], r[3], i * shards // n, i - -(-(i * shards // n) * n // shards)) for i, (*_, r) in enumerate(placed))


@pytest.mark.parametrize("bucket_rows", [2, 5, 4096])
def test_shards(docs, no_docs, bucket_rows):
    rows = [
        (r.doc_id, r.source, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()
    ]
    got = sharding.shard(docs, bucket_rows=bucket_rows).collect()
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot) for r in got) == brute_shards(rows, 8)
    assert sharding.shard(no_docs).collect() == []


def test_shards_match_the_mixture(spark):
    many = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text", "IF(id % 3 = 0, 'hot', 's' || id % 20) AS source")
    placed = sharding.shard(many, bucket_rows=100).join(many, "doc_id")
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    hot = [r["count"] for r in placed.where("source = 'hot'").groupBy("shard").count().collect()]
    assert max(hot) - min(hot) <= 1


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", "kato", " b", "é", "7"]), max_size=9), max_size=6))
@settings(max_examples=100, deadline=None)
def test_added_tokens_equal_the_unmodified_library(drawn):
    path = public_tokenizers.path(token_output.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    texts = ["".join(own) for own in drawn] + ["a<|endoftext|>b", "", "plain text", "<|endoftext|><|endoftext|>"]
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert expected[-4] == [64, 50256, 65]
    ids, counts = token_output.encode(pa.array([*texts, None]), path)
    assert ids.tolist() == [i for own in expected for i in own]
    assert counts.tolist() == [*map(len, expected), 0]


def test_added_tokens_in_files(spark):
    texts = ["a<|endoftext|>b", None, "x \n<|endoftext|>", "later"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    start, expected = 0, []
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_output.listing(docs, new_folder(spark, "t")).collect()
    assert sorted(map(tuple, got)) == expected


def test_rows_without_ids_are_spread_over_buckets(spark):
    """Half of the rows have no id: no bucket, and so no window task, holds many of them."""
    rows = spark.range(8000).selectExpr("IF(id % 2 = 0, NULL, id) AS doc_id", "'text ' || id AS text", "'s' AS source")
    placed = sharding.shard(rows, bucket_rows=200)
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    digest = "conv(substring(md5(encode(concat_ws(':', '17', coalesce(string(doc_id), ''), text_crc32, size), 'UTF-8')), 1, 8), 16, 10)"
    buckets = placed.selectExpr(f"floor(bigint({digest}) * 40 / 4294967296) AS b").groupBy("b").count()
    assert max(r["count"] for r in buckets.collect()) < 300


def test_letter_words_are_encoded_many_at_once(monkeypatch):
    """They give the ids that each has alone, next to words with other signs, which stay alone."""
    import tokenizers

    handed = []

    class Noted:
        def __init__(self, whole):
            self.whole = whole

        def __getattr__(self, name):
            return getattr(self.whole, name)

        def encode_batch_fast(self, texts, **options):
            handed.append(len(texts))
            return self.whole.encode_batch_fast(texts, **options)

        @staticmethod
        def from_file(path):
            return Noted(whole.from_file(path))

    whole = tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", Noted)
    path = public_tokenizers.path(token_output.TOKENIZER)
    encoder, _, _ = token_output._encoder(path)
    letters = [f"{gap}{a}{b}ölaй漢字ª" for gap in ("", " ") for a in "abcdefghijklmnopqrstuvwxyz" for b in "äßçдλאب中ｱʰ"]
    words = letters + ["'s", " 12", "\n", " \n\n", "!", " ", " ", "á", "  x", "漢", " x"]
    words = words[::-1] + words[:300]
    ids, counts = encoder.encode_words(words)
    tokenizer = whole.from_file(path)
    alone = [tokenizer.encode(word, add_special_tokens=False).ids for word in words]
    assert counts.tolist() == [len(own) for own in alone]
    assert ids.tolist() == [i for own in alone for i in own]
    assert max(handed) < 30 < len(words)
    for few in ([], ["!"], ["word"], ["!", "word"]):
        ids, counts = encoder.encode_words(few)
        alone = [tokenizer.encode(word, add_special_tokens=False).ids for word in few]
        assert (ids.tolist(), counts.tolist()) == ([i for own in alone for i in own], [len(own) for own in alone])


def test_selectors_hold_as_many_ids_as_fit():
    """Against the widths of every window, also in blocks shorter than a word and at their ends."""
    rng = np.random.default_rng(3)
    for block in (1, 7, 64, 1024):
        widths = rng.integers(0, 65, 2 * block + 5).astype(np.uint8)
        for number, most in token_output._widest(widths, block):
            count = token_output.SELECTORS[number][0]
            wanted = [
                max(widths[i : min(i + count, (i // block + 1) * block)].tolist()) for i in range(len(widths))
            ]
            assert most.tolist() == wanted
