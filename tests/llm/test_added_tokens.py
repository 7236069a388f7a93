"""Texts that hold a vocabulary's added tokens, against the plain library."""

import array
import random
import zlib

import pytest

from factloom.llm import token_counts
from factloom.llm.packing import digest, pack
from factloom.llm.token_counts import SpanEncoder
from factloom.llm.tokens import Encoder, public_path

FILES = [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")]
PARTS = ["a", "\u00c9", "'s", " ", "  ", "\n", "12", "!?", "\u3000", "\u0301", "<|", "|>", "<|ENDOFTEXT|>"]
PARTS += ["<|endoftext|>", "<|startoftext|>", "don't"]


def plain(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path(name))


def texts(n):
    rng = random.Random(5)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", *some]


@pytest.mark.parametrize("name, cut", FILES)
def test_ids_are_the_librarys(name, cut):
    whole, encoder = plain(name), Encoder.of(public_path(name), cut)
    for text, ids in zip(texts(500), encoder.ids(texts(500))):
        assert list(array.array("I", ids)) == whole.encode(text, add_special_tokens=False).ids, text


def test_spans_are_the_librarys():
    whole, encoder = plain(FILES[0][0]), SpanEncoder.of(public_path(FILES[0][0]), "byte")
    for text, (starts, ends) in zip(texts(300), encoder.spans(texts(300))):
        offsets = whole.encode(text, add_special_tokens=False).offsets
        assert list(zip(starts.tolist(), ends.tolist())) == offsets, text


def test_operators_give_added_tokens_their_ids(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "plain text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.section_tokens(docs).collect()} == {1: 4, 2: 2}
    assert plain(FILES[0][0]).encode(rows[0][1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    packed = {r["doc_id"]: r["ids_crc32"] for r in digest(pack(docs)).collect()}
    ids = plain(FILES[1][0]).encode(rows[0][1], add_special_tokens=False).ids
    assert ids == [320, 49407, 321]
    assert packed[1] == zlib.crc32(array.array("I", [*ids, 1]).tobytes())


@pytest.mark.parametrize("name, cut", FILES)
def test_plain_and_other_characters_are_cut_as_the_file_cuts_them(name, cut):
    whole = plain(name)
    encoders = [Encoder(public_path(name), cut, added=added) for added in (True, False)]
    rng = random.Random(11)
    signs = [chr(c) for c in range(0x180)] + list("İK٠中́​  ''\n\n\t  ")
    signs += ["'S", "'ll", "''s", " '", "<|endoftext|>", "ı'd", "ǅ", "ﬁ", "\U0001f600"]
    some = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(4000)]
    some += [chr(c) * n + tail for c in range(0x180) for n in (1, 2) for tail in ("", "a", " b", "1")]
    for encoder, ordinary in zip(encoders, (False, True)):
        whole.encode_special_tokens = ordinary
        for text, ids in zip(some, encoder.ids(some)):
            assert list(array.array("I", ids)) == whole.encode(text, add_special_tokens=False).ids, (text, ordinary)
