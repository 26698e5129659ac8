"""Byte-level BPE on a sentencepiece model written directly from a rank file."""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import map_texts, query, table

#: First code point of the 256 that stand for bytes.
BYTES_AT = 0x4E00
#: Pre-tokens kept per Python worker; beyond it the memory starts anew.
CACHE_SIZE = 500_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    return _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _varint(3 << 3) + _varint(kind))


def as_text(data: bytes) -> str:
    return "".join(chr(BYTES_AT + b) for b in data)


def serialise(tokens: list[bytes]) -> bytes:
    """Model file: piece i is token i in byte code points with score -i; identity normalisation; unknown comes last."""
    pieces = b"".join(_piece(as_text(t), -float(i), 1) for i, t in enumerate(tokens))
    trainer = _field(2, _varint(3 << 3) + _varint(2) + _varint(40 << 3) + _varint(len(tokens)))
    flags = b"".join(_varint(n << 3) + _varint(0) for n in (3, 4, 5))
    return pieces + _piece("<unk>", 0.0, 2) + trainer + _field(3, _field(1, b"identity") + flags)


class ByteBpe:
    """Encodes by ranks: each match of the pattern apart, no special tokens. Decodes by the inverse mapping."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        if [ranks[t] for t in self.tokens] != list(range(len(ranks))):
            raise ValueError("ranks must be gapless from 0")
        self.whole = {t: struct.pack("<I", r) for t, r in ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.find(text)
        new = [p for p in set(parts) if p not in self.known]
        if new:
            if len(self.known) > CACHE_SIZE:
                self.known, new = {}, list(set(parts))
            raw = [p.encode() for p in new]
            rest = [as_text(r) for r in raw if r not in self.whole]
            split = iter(self.model.encode(rest, num_threads=1) if rest else ())
            for p, r in zip(new, raw):
                self.known[p] = self.whole.get(r) or struct.pack(f"<{len(ids := next(split))}I", *ids)
        return b"".join(map(self.known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row; null and empty texts have no ids. Row by row, without a shuffle."""

    def work(texts: list[str]) -> list[pa.Array]:
        bpe = codec(path, pattern)
        ids = [bpe.encode(t) for t in texts]
        sizes = pa.array([len(i) // 4 for i in ids], pa.int64())
        return [sizes, pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.binary())]

    return map_texts(df, text, [key], work, "n_tokens long, ids binary, decoded binary")


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
