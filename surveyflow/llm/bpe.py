"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text sets chunk ends where the content says so: passages that documents share fall
into the same chunks, wherever they stand. A chunk is encoded and decoded once and then taken from a dictionary. As a
chunk end may fall inside a word, only the part between a chunk's first and last safe cut is taken as it is; what lies
around a join is encoded anew, together with the pieces next to it, until both encodings agree.

A safe cut is a single space between two characters that aren't white space: the split of byte-level BPE always starts
a piece there, and merges never cross pieces. No rows move: the dictionary belongs to a task, has a fixed limit, and a
lost executor costs the tasks it ran.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyflow.llm.common import buffered, narrow, table, text_rows

#: How byte-level BPE splits a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class ChunkRule:
    """``window`` bytes are hashed; a chunk ends where the low ``bits`` of the hash are all set, after 2**bits bytes on average."""

    window: int = 32
    bits: int = 10
    #: Characters of chunks, and number of word pieces, that a task holds before it starts its dictionaries anew.
    held_chars: int = 12_000_000
    held_pieces: int = 200_000


def chunk_ends(data: bytes, rule: ChunkRule) -> np.ndarray:
    """Byte positions, each between two characters, at which chunks of ``data`` end; the last is its length."""
    size = len(data)
    if size <= rule.window:
        return np.array([size] if size else [], dtype=np.int64)
    octets = np.frombuffer(data, dtype=np.uint8)
    # hash of the window that ends at i, as a difference of prefix sums of hashed bytes times powers of an odd number:
    # sum of mixed(b[j]) * r**(i - j) over the window, kept relative by doubling
    mixed = (octets.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761)
    rolled, reach = mixed ^ (mixed >> np.uint32(15)), 1
    factor = 0x9E3779B1
    while reach < rule.window:
        earlier = rolled[:-reach] * np.uint32(pow(factor, reach, 1 << 32))
        rolled = rolled.copy()
        rolled[reach:] += earlier
        reach *= 2
    rolled ^= rolled >> np.uint32(16)
    mask = np.uint32((1 << rule.bits) - 1)
    ends = np.flatnonzero((rolled[rule.window - 1 :] & mask) == mask) + rule.window
    ends = ends[ends < size]
    ends = ends[(octets[ends] & 0xC0) != 0x80]  # not inside a character
    return np.append(ends, size)


def token_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes that each id stands for, as a byte-level decoder maps the characters of its token."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    octet = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*printable}))}
    out = []
    for k in range(tokenizer.get_vocab_size(with_added_tokens=True)):
        token = tokenizer.id_to_token(k) or ""
        known = all(c in octet for c in token)
        out.append(bytes(octet[c] for c in token) if known else token.encode())
    return out


class Pieces(dict):
    """Ids of word pieces, encoded when they are first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> list[int]:
        self[piece] = ids = self.encode(piece)
        return ids


def piece_encoder(tokenizer: Tokenizer, octets: list[bytes]):
    """str -> ids like ``tokenizer.encode``, and whether pieces between safe cuts are encoded independently of each other.

    The tokenizer's own merges run in the faster of two public libraries if its file says that both do the same:
    byte-level, no normaliser, merges numbered in the order of their ids."""

    def plain(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    made = json.loads(tokenizer.to_str())
    model, split, special = made["model"], made["pre_tokenizer"] or {}, [t["content"] for t in made["added_tokens"]]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    numbers = [model["vocab"]["".join(m)] for m in merges]
    simple = not (made["normalizer"] or made["post_processor"] or model.get("dropout") or model.get("ignore_merges"))
    level = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not (simple and level and numbers == sorted(numbers) and len(model["vocab"].keys() - {*special}) == len(merges) + 256):
        return plain, level and not made["normalizer"]
    ranks = {octets[k]: k for token, k in model["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return (lambda text: plain(text) if any(t in text for t in special) else fast(text)), True


class ChunkCodec:
    """Encodes and decodes whole texts; what it holds is bounded by its rule."""

    def __init__(self, tokenizer: Tokenizer, rule: ChunkRule = ChunkRule()):
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.rule, self.octets = rule, token_bytes(tokenizer)
        self.encode, self.safe = piece_encoder(tokenizer, self.octets)
        self.forget()

    def forget(self) -> None:
        self.pieces = Pieces(self.encode)
        self.chunks: dict[bytes, tuple[str, str, str | None, str, np.ndarray, bytes]] = {}
        self.joins: dict[tuple[str, str, str], tuple[np.ndarray, bytes]] = {}
        self.held = 0

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.octets.__getitem__, ids))

    def chunk(self, data: bytes) -> tuple:
        """(head, first piece of the core, tail or None, last piece of the core, ids and bytes of the core)."""
        if (known := self.chunks.get(data)) is not None:
            return known
        head, *core = SAFE_CUT.split(data.decode("utf-8", "surrogatepass"))
        tail = " " + core.pop() if core else None
        core = [" " + piece for piece in core]
        if not self.safe:  # merges may cross spaces, so a core is one piece, and joins are compared with whole cores
            if not core:
                head, tail = head + (tail or ""), None
            core = ["".join(core)] if core else []
        ids = list(chain.from_iterable(map(self.pieces.__getitem__, core)))
        packed = np.array(ids, dtype=np.int32)
        known = self.chunks[data] = (head, core[0] if core else "", tail, core[-1] if core else "", packed, self.decode(ids))
        self.held += len(data)
        return known

    def agree(self, before: str, window: str, after: str) -> list[int] | None:
        """Ids of ``window``, if encoding it by itself and together with its neighbours is the same."""
        ids, left, right = (self.encode(p) if p else [] for p in (window, before, after))
        return ids if self.encode(before + window + after) == left + ids + right else None

    def repaired(self, before: str, window: str, after: str) -> tuple[np.ndarray, bytes] | None:
        """Ids and bytes of what lies around a join: encoded again with its neighbours, and both encodings must agree."""
        if (known := self.joins.get((before, window, after))) is not None:
            return known
        ids = self.agree(before, window, after)
        if ids is None:
            return None
        known = self.joins[before, window, after] = (np.array(ids, dtype=np.int32), self.decode(ids))
        return known

    def parts(self, data: bytes) -> list[str]:
        """The text as what lies around its joins and the cores between, in turn."""
        out, start, open_text = [], 0, ""
        for end in chunk_ends(data, self.rule).tolist():
            head, _, tail, *_ = self.chunk(data[start:end])
            text = data[start:end].decode("utf-8", "surrogatepass")
            start, open_text = end, open_text + head
            if tail is not None:
                out += [open_text, text[len(head) : len(text) - len(tail)]]
                open_text = tail
        return [part for part in [*out, open_text] if part]

    def widened(self, data: bytes) -> list[int]:
        """Ids of a text in which an encoding around a join doesn't agree: windows take in their neighbours until all do,
        at last the whole text."""
        parts, at = self.parts(data), 0
        while at < len(parts):
            low, high = max(0, at - 1), min(len(parts), at + 2)
            sides = ("".join(parts[low:at]), parts[at], "".join(parts[at + 1 : high]))
            if high - low == 1 or self.agree(*sides) is not None:
                at += 1
                continue
            parts[low:high] = ["".join(sides)]
            at = max(0, low - 1)  # what stands before has another neighbour now
        return list(chain.from_iterable(map(self.encode, parts)))

    def round_trip(self, text: str) -> tuple[np.ndarray, str]:
        """(ids, decoded text): what the tokenizer's own encode and decode of the whole text give."""
        data = text.encode("utf-8", "surrogatepass")
        ids: list[np.ndarray] = [np.empty(0, dtype=np.int32)]
        octets: list[bytes] = []
        start, open_text, before = 0, "", ""
        joined = True

        def repair(after: str) -> bool:
            found = self.repaired(before, open_text, after)
            if found is not None:
                ids.append(found[0])
                octets.append(found[1])
            return found is not None

        for end in chunk_ends(data, self.rule).tolist():
            head, first, tail, last, core, decoded = self.chunk(data[start:end])
            start, open_text = end, open_text + head
            if tail is None:
                continue
            if open_text and not (joined := repair(first)):
                break
            ids.append(core)
            octets.append(decoded)
            before, open_text = last, tail
        if joined and open_text:
            joined = repair("")
        if not joined:
            wide = self.widened(data)
            ids, octets = [np.array(wide, dtype=np.int32)], [self.decode(wide)]
        if self.held > self.rule.held_chars or len(self.pieces) + len(self.joins) > self.rule.held_pieces:
            self.forget()
        return np.concatenate(ids), b"".join(octets).decode("utf-8", "replace")


def encode_decode(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", rule: ChunkRule = ChunkRule()
) -> DataFrame:
    """doc_id, token_ids array<int> and decoded string of every row.

    A null text is an empty one and has no ids. Repeated rows give repeated rows, an empty table none; a null doc_id is
    passed on. Further columns of the input are not returned. The file must be readable on all executors.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ChunkCodec(Tokenizer.from_file(tokenizer_file), rule)
        for batch, texts in text_rows(batches):
            rows = ((key, *codec.round_trip(t)) for key, t in zip(batch.column("doc_id").to_pylist(), texts))
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("token_ids", pa.list_(pa.int32())), ("decoded", pa.string())])
            yield from buffered(rows, schema, 1024, lambda row: 4 * len(row[1]) + len(row[2]))

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(work, f"doc_id {kind}, token_ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(table(spark, sf_dir, "documents"), default_tokenizer()))
