"""Whole texts through the tokenizer itself."""

from __future__ import annotations

import hashlib
import random

import pytest
from llm_cases import edge_rows, frame, listed, prose
from surveyflow.llm import bpe
from tokenizers import Tokenizer, models


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.default_tokenizer())


def texts():
    passage = prose(9, 400)
    return [
        *(t or "" for _, t, *_ in edge_rows()), passage, "before " + passage + " after", passage[50:] + passage, "a" * 3000, " " * 3000,
        "a  b   c\n\n d \t e ", "don't we'll I'M 12345 x<|endoftext|><|endoftext|> y" * 40, "é" * 700, "日本 語" * 700,
        "word \x1c\x85  word " * 50, "� \x00 ok" * 30, "(a) [b] {c} d-e, f; g's h'S " * 60,
    ]


@pytest.mark.parametrize("rule", [bpe.ChunkRule(), bpe.ChunkRule(window=8, bits=4), bpe.ChunkRule(bits=3, held_chars=100, held_pieces=10)])
def test_round_trip_equals_the_tokenizer(tokenizer, rule):
    codec = bpe.ChunkCodec(Tokenizer.from_file(bpe.default_tokenizer()), rule)
    for text in texts():
        ids, decoded = codec.round_trip(text)
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected
        assert decoded == tokenizer.decode(expected, skip_special_tokens=False)


def test_chunks_follow_the_content():
    """A passage is cut alike wherever it stands, and never inside a character."""
    passage = ("ä " + prose(5, 3000)).encode()
    rule = bpe.ChunkRule(bits=6)
    alone = bpe.chunk_ends(passage, rule)
    moved = bpe.chunk_ends(b"x" * 777 + passage, rule) - 777
    assert len(alone) > 100 and set(alone[1:]) <= set(moved)
    wide = ("日本語é😀" * 400).encode()
    start = 0
    for end in bpe.chunk_ends(wide, bpe.ChunkRule(window=4, bits=2)):
        wide[start:end].decode()
        start = end


def test_shared_chunks_are_encoded_once(tokenizer):
    codec = bpe.ChunkCodec(tokenizer)
    passage = prose(6, 4000)
    codec.round_trip(passage)
    before = len(codec.chunks)
    codec.round_trip("Another beginning. " + passage)
    assert len(codec.chunks) <= before + 3


def test_digests(spark, tokenizer):
    found = listed(bpe.digests(bpe.encode_decode(frame(spark), bpe.default_tokenizer())), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expected = []
    for doc_id, text, *_ in edge_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(expected, key=repr)
    assert bpe.encode_decode(frame(spark, []), bpe.default_tokenizer()).count() == 0


def test_joins_that_do_not_agree_are_widened():
    """A tokenizer that merges across spaces has no safe cuts: windows grow until encodings agree."""
    vocab = {c: k for k, c in enumerate(["a", "b", "c", " ", "a ", "a b", "b ", "b c", "a ba b", "b cb c"])}
    merges = [("a", " "), ("a ", "b"), ("b", " "), ("b ", "c"), ("a b", "a b"), ("b c", "b c")]
    made = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    for rule in (bpe.ChunkRule(window=4, bits=2), bpe.ChunkRule(window=4, bits=1), bpe.ChunkRule()):
        codec = bpe.ChunkCodec(made, rule)
        asked = []
        widened = codec.widened
        codec.widened = lambda data: asked.append(data) or widened(data)
        for seed in range(30):
            rng = random.Random(seed)
            text = "".join(rng.choice(["a b", "b c", "a ", "c", "b ", "a"]) for _ in range(rng.randrange(60)))
            assert codec.round_trip(text)[0].tolist() == made.encode(text, add_special_tokens=False).ids
        assert asked or rule.bits == 10


def test_dictionaries_are_shared_by_the_documents_of_a_task(tokenizer):
    """Two tasks with the same passages encode them twice, one task once: no ids are shuffled to share more."""
    passages = [prose(100 + k, 3000) for k in range(4)]
    calls = []
    for parts in ([passages * 2], [passages, passages]):
        count = 0
        for part in parts:
            codec = bpe.ChunkCodec(tokenizer)
            for text in part:
                codec.round_trip(text)
            count += len(codec.chunks)
        calls.append(count)
    assert calls[1] == 2 * calls[0]
