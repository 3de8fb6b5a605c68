import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from boardroll.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    dice = random.Random(5)
    made = ["".join(dice.choice("abcdefgh etaoin'sé\n") for _ in range(n)) for n in (1, 7, 60, 4000)]
    return [
        None, "", " ", "a" * 3000, "ab" * 900, " " * 2000 + "x", "é" * 700, "日本語テキスト" * 99,
        "don't 'S 12345 ²³ ½ <|endoftext|>", "x\x1cy \x0b z\xa0  w", "The cat_sat\r\n\r\non it!!  ", *made,
    ]


def test_ids_as_the_library(spark, documents, codec, library):
    texts = _texts() + _texts()[:4]
    docs = documents(*enumerate(texts))
    got = {r.doc_id: r.ids for r in bpe.encode(docs, codec).collect()}
    assert got == {k: library.encode_ordinary(t or "") for k, t in enumerate(texts)}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(bpe.encode(docs, codec), codec).collect()}
    assert back == {k: (t or "").encode() for k, t in enumerate(texts)}


def test_digests(documents, codec, library):
    (row,) = bpe.round_trip(documents((None, "One text, twice: one text.")), codec).collect()
    ids = library.encode_ordinary("One text, twice: one text.")
    assert row.doc_id is None and row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"One text, twice: one text.").hexdigest()


def test_short_and_long_rows_agree(codec, library):
    """Rows beyond the matrix width take the heap; both ways give the library's ids."""
    narrow = bpe.Codec(codec.ranks, codec.pattern, longest_row=4)
    for text in _texts():
        ids = struct.pack(f"<{len(x := library.encode_ordinary(text or ''))}I", *x)
        assert narrow.encoder()([text or ""]) == codec.encoder()([text or ""]) == [ids]


def test_empty_table_and_vocabulary_checks(documents, codec):
    assert bpe.round_trip(documents((1, "x")).where("false"), codec).count() == 0
    with pytest.raises(ValueError, match="no token for bytes"):
        bpe.Codec({b"a": 0}, "a")
