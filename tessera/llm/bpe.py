"""Byte-level BPE by a sentencepiece model that is serialised directly from a rank vocabulary.

No tokenizer is trained. Each byte sequence of the vocabulary becomes a piece whose bytes are mapped to
printable characters one by one; its score is its negative rank and its id the rank, so that
sentencepiece merges the pair of least rank, leftmost first. Normalisation is the identity. A text is
cut into pre-tokens, each is encoded by itself, and decoding is the inverse mapping of the pieces.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, read

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens that a worker remembers between texts; beyond that it forgets all and starts again, which changes no result.
REMEMBERED = 150_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else U+0100 and up in byte order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (chr(0x100 + i) for i in range(256))
    return [chr(b) if b in own else next(rest) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte sequences of a rank file, by rank; ranks must run from 0 without gaps."""
    found = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks have gaps")
    return [found[i] for i in range(len(found))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: pieces 0.. are the tokens, the last is the unknown piece."""
    chars = byte_characters()
    normal, unknown = 1, 2
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_bytes(1, _bytes(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, normal)))
    out.append(_bytes(1, _bytes(1, "⁇".encode()) + b"\x15" + struct.pack("<f", 0.0) + _number(3, unknown)))
    minus_one = (1 << 64) - 1
    trainer = _number(3, 2) + _number(4, len(tokens) + 1) + _number(40, len(tokens)) + b"".join(_number(f, minus_one) for f in (41, 42, 43)) + _bytes(45, "⁇".encode())
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _bytes(2, trainer) + _bytes(3, normalizer)


class Codec:
    """Encodes texts to ids and ids to bytes."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.mapped = {b: c for b, c in enumerate(byte_characters())}
        self.known: dict[str, bytes] = {}

    def _ids(self, pre_tokens: list[str]) -> Iterator[bytes]:
        """The ids of each pre-token as little-endian unsigned 32-bit integers; a pre-token that is a token is its id."""
        raw = [p.encode() for p in pre_tokens]
        for word, ids in zip(raw, self.model.encode([w.decode("latin-1").translate(self.mapped) for w in raw], num_threads=1), strict=True):
            rank = self.ranks.get(word)
            yield struct.pack("<I", rank) if rank is not None else struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        pre_tokens, known = self.pattern.findall(text), self.known
        if missing := [p for p in set(pre_tokens) if p not in known]:
            if len(known) + len(missing) > REMEMBERED:
                missing = list(set(pre_tokens))
                known.clear()
            known.update(zip(missing, self._ids(missing), strict=True))
        return b"".join(map(known.__getitem__, pre_tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (bytes).

    Null and empty texts have no ids. Texts of any length are encoded whole; rows repeat as they do in
    docs. path must be readable on the executors, as the installed vocabularies are. Other columns are
    not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [own.encode(text or "") for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, n_tokens long, ids binary, decoded binary")


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """encoded with its column ids decoded back to text, as column text; null ids stay null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([None if x is None else own.decode(x).decode("utf-8", "replace") for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded_text"])

    rows = encoded.drop("decoded_text")
    return arrow_map(rows, run, T.StructType([*rows.schema.fields, T.StructField("decoded_text", T.StringType())]))


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256; the ids and bytes themselves don't leave the task.

    Null and empty texts have no ids and the digests of no bytes. Texts of any length are encoded whole; null and
    repeated ids give a row each, and no rows none. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def installed() -> tuple[str, str]:
    """Path and pre-token pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents").select("doc_id", "text"), *installed())
