"""Byte-level BPE as recursive DuckDB queries inside each Spark partition.

Words new to a partition become lists of byte tokens. One recursive query contracts them: each step lays the
lists out as rows of token position, joins neighbouring tokens to the merge table, and contracts the leftmost
pair of least rank of every word, until no pair of a word is in the table. Decoding joins rows of id and position
to the vocabulary and aggregates the pieces of each document in order.
"""

from __future__ import annotations

import base64
import warnings
from collections.abc import Sequence

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices, per_stage
from .pieces import PieceEncoder, flat

RANKS = "byte_bpe_50k.tiktoken"
WORDS_AT_ONCE = 20_000
WORD_BYTES_AT_ONCE = 1 << 20
TOKENS_AT_ONCE = 1 << 18

_CONTRACT = """
    WITH RECURSIVE state AS (
        SELECT word, tokens, true AS open FROM fresh
        UNION ALL
        SELECT s.word,
            CASE WHEN best IS NULL THEN tokens
                ELSE tokens[: best % 4294967296 - 1] || [(best // 4294967296)::INTEGER]
                    || tokens[best % 4294967296 + 2 :] END,
            best IS NOT NULL
        FROM state s LEFT JOIN (
            SELECT word, min(merged * 4294967296 + place) AS best
            FROM (
                SELECT word, unnest(range(1, len(tokens))) AS place,
                    unnest(tokens[: len(tokens) - 1])::BIGINT * 4294967296 + unnest(tokens[2:]) AS pair
                FROM state WHERE open AND len(tokens) > 1
            ) JOIN merges USING (pair)
            GROUP BY word
        ) contracted ON contracted.word = s.word
        WHERE open
    )
    SELECT tokens FROM state WHERE NOT open ORDER BY word"""

_DECODE = """
    SELECT doc, string_agg(piece, '' ORDER BY place) AS decoded
    FROM tokens JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc"""


class Tables:
    """The merge table and the vocabulary of a rank file in one in-memory database, on one thread.

    A token's rank is its id. A pair of tokens merges if its bytes are a token, so the merge table has every way
    to cut a token into two. Bytes are kept as the code points of the same number.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs = [
            ((self.ranks[token[:i]] << 32) + self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        merges = pa.table({"pair": pa.array([x[0] for x in pairs]), "merged": pa.array([x[1] for x in pairs])})
        vocabulary = pa.table(
            {
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "piece": pa.array([token.decode("latin-1") for token in self.ranks]),
            }
        )
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            result = self.db.execute(sql).to_arrow_table()
        self.db.unregister(name)
        return result

    def encode_words(self, words: list[str]) -> list[Sequence[int]]:
        """The ids of each word; a word that is a token as a whole is that token."""
        raw = [word.encode() for word in words]
        out: list[Sequence[int]] = [()] * len(raw)
        fresh, size = [], 0
        for i, word in enumerate(raw):
            if word in self.ranks:
                out[i] = (self.ranks[word],)
                continue
            fresh.append(i)
            size += len(word)
            if len(fresh) == WORDS_AT_ONCE or size > WORD_BYTES_AT_ONCE:
                self._contract(raw, fresh, out)
                fresh, size = [], 0
        self._contract(raw, fresh, out)
        return out

    def _contract(self, raw: list[bytes], fresh: list[int], out: list[Sequence[int]]) -> None:
        if not fresh:
            return
        data = np.frombuffer(b"".join(raw[i] for i in fresh), np.uint8)
        ends = np.cumsum([len(raw[i]) for i in fresh])
        tokens = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(self.byte_ids[data])
        )
        rows = pa.table({"word": pa.array(np.arange(len(fresh))), "tokens": tokens})
        for i, ids in zip(fresh, self._query("fresh", rows, _CONTRACT).column("tokens").to_pylist()):
            out[i] = ids

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each document, given the ids of all of them and how many each has.

        Each token decodes on its own, so tokens are decoded in runs of bounded number, whatever the documents' lengths.
        """
        document = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        parts: list[list[bytes]] = [[] for _ in counts]
        for start in range(0, len(ids), TOKENS_AT_ONCE):
            run = slice(start, start + TOKENS_AT_ONCE)
            rows = pa.table(
                {
                    "doc": pa.array(document[run]),
                    "place": pa.array(np.arange(len(ids[run]), dtype=np.int64)),
                    "id": pa.array(ids[run].astype(np.int32)),
                }
            )
            result = self._query("tokens", rows, _DECODE)
            for doc, decoded in zip(result.column("doc").to_pylist(), result.column("decoded").to_pylist()):
                parts[doc].append(decoded.encode("latin-1"))
        return [b"".join(own) for own in parts]


def tables(path: str) -> Tables:
    """One per Python worker and stage; Spark uses a worker for many tasks."""
    return per_stage(Tables, path)


def encoder(path: str, pattern: str) -> PieceEncoder:
    return per_stage(_encoder, path, pattern)


def _encoder(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(lambda words: flat(tables(path).encode_words(words)), pattern)


def binary(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary per document: its ids as little-endian unsigned 32-bit integers."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype("<u4").tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(counts), buffers)


def encode_column(path: str | None = None, pattern: str = public_tokenizers.PATTERN):
    """A function of a text column: its ids as little-endian unsigned 32-bit integers. A null text is empty."""
    path = path or public_tokenizers.path(RANKS)

    def encode(column: pa.Array) -> pa.Array:
        return binary(*encoder(path, pattern).encode(column))

    return F.arrow_udf(lambda texts: by_slices(encode, texts), "binary")


def decode_column(path: str | None = None):
    """A function of a column of ids as :func:`encode_column` gives them: the decoded bytes. Null gives no bytes."""
    path = path or public_tokenizers.path(RANKS)

    def decode(column: pa.Array) -> pa.Array:
        raw = [ids or b"" for ids in column.to_pylist()]
        counts = np.array([len(ids) // 4 for ids in raw], np.int64)
        ids = np.frombuffer(b"".join(raw), "<u4")
        return pa.array(tables(path).decode(ids, counts), pa.binary())

    return F.arrow_udf(lambda ids: by_slices(decode, ids), "binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the ids of the whole text, and the bytes decoded from them.

    A null or empty text has no ids. Repeated rows are encoded alike; no rows give none; other columns are
    ignored.
    """
    encoded = docs.select("doc_id", encode_column(path)("text").alias("ids"))
    return encoded.withColumn("decoded", decode_column(path)("ids"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of :func:`round_trip`."""
    return round_trip(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
