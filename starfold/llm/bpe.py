"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Each match of the pattern is merged on its own. Long texts are cut beforehand at safe boundaries, before white space that
follows anything else: no match of the pattern holds white space after another character, and no look-ahead reaches back
over such a place, so the pieces' tokens are the whole text's tokens. A piece without such a place stays whole.

Null is the empty text: no tokens. Special tokens are never read from a text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_CHARS = 1 << 16
ROWS_AT_ONCE = 256
_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")


@functools.lru_cache(maxsize=2)
def encoding(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file (base64 token, rank per line); read once per worker."""
    with open(rank_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(rank_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that tokenize like the whole."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(encoder: tiktoken.Encoding, text: str | None) -> array:
    ids = array("I")
    for piece in safe_pieces(text or ""):
        ids.extend(encoder.encode_ordinary(piece))
    return ids


def decode(encoder: tiktoken.Encoding, ids: Iterable[int], step: int = PIECE_CHARS) -> Iterator[bytes]:
    """The raw bytes of the ids, a step at a time; a token may end inside a character."""
    ids = array("I", ids)
    for start in range(0, len(ids), step):
        yield encoder.decode_bytes(ids[start : start + step].tolist())


def little_endian(ids: array) -> bytes:
    return np.frombuffer(ids, np.uint32).astype("<u4").tobytes()


def token_digests(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens`` and the SHA-256 of the ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_path, pattern)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                ids = encode(encoder, value.as_py())
                decoded = hashlib.sha256()
                for part in decode(encoder, ids):
                    decoded.update(part)
                rows.append((len(ids), hashlib.sha256(little_endian(ids)).hexdigest(), decoded.hexdigest()))
            counts, digests, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(run, schema)


def _added(docs: DataFrame, source: str, out: str, kind: T.DataType, make: Callable[[tiktoken.Encoding, pa.Array], pa.Array], rank_path: str, pattern: str) -> DataFrame:
    """``docs`` with column ``out`` (replaced if there) made from column ``source``, a few rows at a time."""
    names = [name for name in docs.columns if name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(low, ROWS_AT_ONCE)
                made = make(encoder, some.column(len(names)))
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], made], [*names, out])

    seen = docs.select(*(F.col(f"`{name}`") for name in names), F.col(source).alias("__source"))
    return seen.mapInArrow(run, seen.drop("__source").schema.add(out, kind))


def encode_column(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text in ``out``; a null text has no ids."""

    def make(encoder: tiktoken.Encoding, column: pa.Array) -> pa.Array:
        lists = [np.frombuffer(encode(encoder, value.as_py()), np.uint32).astype(np.int32) for value in column]
        ends = np.cumsum([0, *map(len, lists)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*lists, np.empty(0, np.int32)])))

    return _added(docs, text, out, T.ArrayType(T.IntegerType()), make, rank_path, pattern)


def decode_column(docs: DataFrame, rank_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the raw bytes of each list of ids in ``out``; null decodes to no bytes."""

    def make(encoder: tiktoken.Encoding, column: pa.Array) -> pa.Array:
        return pa.array([b"".join(decode(encoder, value.as_py() or ())) for value in column], pa.binary())

    return _added(docs, ids, out, T.BinaryType(), make, rank_path, pattern)
