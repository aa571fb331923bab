"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file gives each byte string its rank. The library works on characters, so bytes go
through a byte-to-character table; a merge is every split of a ranked string into two ranked
strings, in rank order, which makes any adjacent pair mergeable as rank-based encoders do.
Texts are cut by the pattern and each distinct piece of a batch is encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Entries of a worker's table of pieces; it is emptied when full, so memory stays bounded.
CACHE_PIECES = 100_000
#: Longer pieces are encoded but not remembered.
CACHE_CHARS = 64


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encodes texts to ids with character offsets, and ids back to bytes."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer, models

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = read_ranks(path)
        table = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(table)}
        spell = lambda raw: "".join(map(self.to_chars.__getitem__, raw))
        merges = []
        for raw, rank in ranks.items():
            cuts = ((raw[:i], raw[i:]) for i in range(1, len(raw)))
            both = sorted((ranks[a], ranks[b], a, b) for a, b in cuts if a in ranks and b in ranks)
            merges += [(rank, k, spell(a), spell(b)) for k, (_, _, a, b) in enumerate(both)]
        merges.sort(key=lambda m: m[:2])
        vocab = {spell(raw): rank for raw, rank in ranks.items()}
        self.model = Tokenizer(models.BPE(vocab=vocab, merges=[m[2:] for m in merges], ignore_merges=True, cache_capacity=0))
        self.pattern = regex.compile(pattern)
        # decoding reverses the table: an id's characters, as the library spells them, back to bytes
        to_byte = {c: b for b, c in enumerate(table)}
        spelled = ((i, self.model.id_to_token(i)) for i in range(max(ranks.values()) + 1))
        self.raw = [bytes(map(to_byte.__getitem__, token or "")) for _, token in spelled]
        self.decimal = [str(i) for i in range(len(self.raw))]
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _encode_pieces(self, pieces: list[str]) -> dict[str, tuple[int, ...]]:
        spelled = ["".join(map(self.to_chars.__getitem__, p.encode("utf-8"))) for p in pieces]
        return {p: tuple(e.ids) for p, e in zip(pieces, self.model.encode_batch_fast(spelled, add_special_tokens=False))}

    def encode(self, text: str) -> list[int]:
        pieces = self.pattern.findall(text)
        known = self.pieces
        missing = [p for p in set(pieces) if p not in known]
        if missing:
            if len(known) + len(missing) > CACHE_PIECES:
                known.clear()
                missing = list(set(pieces))
            fresh = self._encode_pieces(missing)
            known.update((p, ids) for p, ids in fresh.items() if len(p) <= CACHE_CHARS)
            if any(len(p) > CACHE_CHARS for p in missing):
                known = {**{p: known[p] for p in set(pieces) if p in known}, **fresh}
        return list(chain.from_iterable(map(known.__getitem__, pieces)))

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """The ids and, for each, the characters [start, end) of the text that hold its bytes, from the
        library's own offsets: those count bytes of a piece (a character stands for each), and a
        piece's bytes are counted off along its characters. Ids that share a character overlap."""
        ids, spans = [], []
        for match in self.pattern.finditer(text):
            piece, begin = match.group(), match.start()
            found = self.model.encode("".join(map(self.to_chars.__getitem__, piece.encode("utf-8"))), add_special_tokens=False)
            ends = np.cumsum([len(ch.encode("utf-8")) for ch in piece])
            ids += found.ids
            for a, b in found.offsets:
                spans.append((begin + int(np.searchsorted(ends, a, side="right")), begin + int(np.searchsorted(ends, b - 1, side="right")) + 1))
        return ids, spans


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", with_offsets: bool = True) -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``offsets`` array<struct<start,end>> (characters).

    A null or empty text gives empty arrays. Columns called ids or offsets are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            both = [c.encode_with_offsets(t) if with_offsets else (c.encode(t), []) for t in texts]
            ids = [i for i, _ in both]
            spans = [[{"start": a, "end": b} for a, b in found] for _, found in both]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept.fields]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(ids, pa.list_(pa.int32())), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=[*kept.names, "ids", "offsets"],
            )

    docs = docs.drop("ids", "offsets")
    kept = docs.schema
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    out = T.StructType([*kept.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(span))])
    return docs.mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` binary: the bytes of the ids, joined before any reading as
    characters, so that characters split over ids come out whole. Null ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            raw = [c.decode_bytes(i or []) for i in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())], names=[*kept.names, "decoded"])

    encoded = encoded.drop("decoded")
    kept = encoded.schema
    return encoded.mapInArrow(run, T.StructType([*kept.fields, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each whole text and decode its ids: ``key``, ``n_tokens``, and SHA-256 digests of the
    comma-joined ids and of the decoded bytes. Null texts count as empty; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            counts, id_digests, digests = [], [], []
            for t in batch.column(1):
                ids = c.encode(t.as_py() or "")
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                digests.append(hashlib.sha256(c.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(digests, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    slim = docs.select(F.col(key), F.col(text).alias("text"))
    out = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])
    return slim.mapInArrow(run, out)
