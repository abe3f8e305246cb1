"""Byte-level BPE encoding and decoding with a sentencepiece model built from the ranks of a vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Encoded pieces a worker remembers; the memory is emptied when full.
REMEMBERED = 400_000

def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: bytes, integers and floats."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def letters(raw: bytes) -> str:
    """Bytes as letters: the code point of each byte's value, and U+0100 for 0, which no piece may hold."""
    return raw.decode("latin-1").replace("\0", "\u0100")


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model: a piece of byte letters for each token, its score the negative rank.

    Identity normalisation, no dummy prefix, white space kept. Piece 0 is the required unknown piece; the token
    at place ``i`` of the ranks' order is piece ``i + 1``.
    """
    parts = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        parts.append(_field(1, _field(1, letters(token).encode()) + _field(2, -float(rank))))
    parts.append(_field(2, _field(3, 2) + _field(4, len(ranks) + 1)))
    parts.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(parts)


class Codec:
    """Encodes pre-tokens with the sentencepiece model and decodes ids by the inverse mapping."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        ordered = sorted(self.ranks.items(), key=lambda item: item[1])
        self.ids = np.array([rank for _, rank in ordered], np.uint32)
        self.tokens = {rank: token for token, rank in ordered}
        self.packed = [b""] + [struct.pack("<I", rank) for _, rank in ordered]  # by piece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        # White space as the Unicode property, which is what the pattern means outside Python.
        self.pattern = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.lengths = np.zeros(max(self.tokens) + 1, np.int64)
        self.lengths[self.ids] = [len(token) for token, _ in ordered]
        self.starts = np.zeros(len(self.lengths), np.int64)
        self.starts[self.ids] = np.cumsum(self.lengths[self.ids]) - self.lengths[self.ids]
        self.bytes = np.frombuffer(b"".join(token for token, _ in ordered), np.uint8)
        self.pretokens: dict[str, bytes] = {}
        self.spaced: dict[str, bytes | None] = {}

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens: the matches of the pattern."""
        body = text[1:] if text[:1] == " " else text
        if body.isalpha():
            return [text]
        if body[-1:] in (".", ",") and body[:-1].isalpha():
            return [text[:-1], body[-1]]
        return self.pattern.findall(text)

    def learn(self, pieces: set[str]) -> None:
        """Encode the pre-tokens that are not remembered, in one call."""
        new = [piece for piece in pieces if piece not in self.pretokens]
        if len(self.pretokens) + len(new) > REMEMBERED:
            self.pretokens.clear()
            new = pieces
        hard, mapped = [], []
        for piece in new:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.pretokens[piece] = struct.pack("<I", rank)
            else:
                hard.append(piece)
                mapped.append(letters(raw))
        packed = self.packed
        for piece, places in zip(hard, self.model.encode(mapped, out_type=int, num_threads=1) if hard else []):
            self.pretokens[piece] = b"".join([packed[place] for place in places])

    def encode_plain(self, text: str) -> bytes:
        pieces = self.pieces(text)
        out = []
        for low in range(0, len(pieces), REMEMBERED // 4):
            part = pieces[low : low + REMEMBERED // 4]
            self.learn(set(part))
            out += map(self.pretokens.__getitem__, part)
        return b"".join(out)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers.

        A single space between two characters that are not white space always begins a pre-token, so texts are
        cut there, and the distinct parts, each with its space, are encoded once; parts at other white space
        send their text through the pattern as a whole.
        """
        cut = [text.split(" ") for text in texts]
        known = self.spaced
        new = set()
        for parts in cut:
            new.update(parts[1:])
        new = {part for part in new if part not in known}
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            for parts in cut:
                new.update(parts[1:])
        inner = [part for part in new if _inner(part)]
        known.update(dict.fromkeys(new))
        pieces = [self.pieces(" " + part) for part in inner]
        self.learn({piece for each in pieces for piece in each})
        remembered = self.pretokens.get
        for part, each in zip(inner, pieces):
            ids = [remembered(piece) for piece in each]
            known[part] = b"".join(ids) if None not in ids else self.encode_plain(" " + part)
        out = []
        for text, parts in zip(texts, cut):
            ids = list(map(known.__getitem__, parts[1:]))
            if _inner(parts[0]) and None not in ids:
                out.append(self.encode_plain(parts[0]) + b"".join(ids))
            else:
                out.append(self.encode_plain(text))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of little-endian 32-bit ids, gathered from the tokens' bytes."""
        out = []
        for low in range(0, len(ids), 4 << 16):
            part = np.frombuffer(ids[low : low + (4 << 16)], "<u4")
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            where = np.repeat(self.starts[part] - ends + lengths, lengths) + np.arange(int(ends[-1]))
            out.append(self.bytes[where].tobytes())
        return b"".join(out)


def _inner(part: str) -> bool:
    """Whether spaces around a part begin pre-tokens whatever stands beyond them."""
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path, pattern)


def _apply(batches: Iterator[pa.RecordBatch], path: str, pattern: str, digests: bool) -> Iterator[pa.RecordBatch]:
    coder = codec(path, pattern)
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            ids = coder.encode_batch([text or "" for text in part.column(1).to_pylist()])
            decoded = map(coder.decode, ids)
            if digests:
                columns = [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                ]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                columns = [
                    pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())),
                    pa.array(list(decoded), pa.binary()),
                ]
                names = ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["key", *names])


def _run(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str, digests: bool) -> DataFrame:
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text"))
    kinds = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    path = public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary
    coded = source.mapInArrow(lambda batches: _apply(batches, path, pattern, digests), f"key bigint, {kinds}")
    return coded.withColumnRenamed("key", id_col)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Token ids of each text and the bytes they decode to: id, ``ids`` and ``decoded``.

    Each match of the pattern is encoded separately, without special tokens. A null text counts as empty and has
    no ids; ids of rows may be null or repeated; an empty table gives no rows; other columns are ignored. The
    vocabulary is a file name of the public tokenizers or a path that every executor can open.
    """
    return _run(docs, id_col, text_col, vocabulary, pattern, digests=False)


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """As :func:`encode`, with the number of ids and digests of ids and decoded bytes in place of both."""
    return _run(docs, id_col, text_col, vocabulary, pattern, digests=True)


def decode(ids: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Bytes for arrays of ids: id and ``decoded``; null ids decode to nothing."""
    path = public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, public_tokenizers.PATTERN)
        for batch in batches:
            out = [coder.decode(np.asarray(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "decoded"])

    source = ids.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{ids_col}`").alias("ids"))
    return source.mapInArrow(apply, "key bigint, decoded binary").withColumnRenamed("key", id_col)


