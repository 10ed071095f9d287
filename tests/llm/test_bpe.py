import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import TEXTS, documents

from starfold.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests(spark, plain):
    docs = documents(spark)
    rows = bpe.token_digests(docs, PATH, PATTERN).collect()
    want = []
    for row in docs.collect():
        text = row["text"] or ""
        ids = plain.encode_ordinary(text)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((row["doc_id"], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.token_digests(documents(spark, []), PATH, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sllé1 2\n\t 　.,!日😀́"), max_size=60), st.integers(1, 9))
def test_pieces_tokenize_like_the_whole(text, size):
    encoder = bpe.encoding(PATH, PATTERN)
    pieces = list(bpe.safe_pieces(text, size))
    assert "".join(pieces) == text
    assert [i for piece in pieces for i in encoder.encode_ordinary(piece)] == encoder.encode_ordinary(text)


def test_round_trip_and_clashing_columns(spark):
    docs = documents(spark).withColumnRenamed("h", "ids")
    coded = bpe.decode_column(bpe.encode_column(docs, PATH, PATTERN), PATH, PATTERN)
    assert coded.columns.count("ids") == 1
    rows = coded.collect()
    assert len(rows) == docs.count()
    assert all(bytes(row["decoded"]).decode() == (row["text"] or "") for row in rows)


def test_bytes_that_are_no_character(plain):
    encoder = bpe.encoding(PATH, PATTERN)
    ids = bpe.encode(encoder, "日😀" * 50)
    assert b"".join(bpe.decode(encoder, ids, step=1)).decode() == "日😀" * 50
    assert max(map(len, TEXTS[9:11])) > bpe.PIECE_CHARS
