"""Token ids with a public tokenizer, and directly addressable id files (operator 9).

Directly addressable codes: an id is cut into 8-bit chunks. Level 0 holds the
low chunk of every id and a bitmap telling which ids go on; level 1 holds the
next chunk of those, and so on. A rank directory (ones before every 512-bit
block) turns a position into its place on the next level, so any id is read
with a few look-ups, without decoding its neighbours.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise
from pluvio.session import scratch_path

END_ID = 0
BLOCK_BITS = 512
_MAGIC = b"DAC1"
_END = struct.pack("<I", END_ID)


def default_tokenizer() -> str:
    """Path of the default vocabulary file (a parameter everywhere)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Generations(dict):
    """A bounded cache: what was not used since the last turnover is dropped."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest follows 0xFF."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in shown)
    return {b: chr(0x100 + k) for k, b in enumerate(others)}


class Encoder:
    """Texts to packed little-endian 32-bit ids, equal to the tokenizer's own ``encode``.

    Text of plain letters, digits, punctuation, single spaces and line ends
    falls into the byte-level tokenizer's pieces by a small pattern (its own,
    on that alphabet); the model encodes a piece alone, and pieces recur and
    are cached. Other texts are cut at single spaces, where a new piece always
    starts; parts beyond the plain alphabet are encoded whole, and so are
    texts in which spaces meet. With ``added_tokens`` the tokenizer is left as
    it comes: a text that holds an added token's content (``<|endoftext|>``) is
    encoded whole and gets that token's id; without, such content is plain text.
    """

    _PIECE = re.compile(
        r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\n(?=\S)"
    )
    _LETTERS = _byte_letters()

    def __init__(self, path: str, limit: int = 450_000, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        if not added_tokens:
            self.whole.encode_special_tokens = True
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()] if added_tokens else []
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.model = self.whole.model
        self.part = _Generations(self._part, limit // 10)
        self.piece = _Generations(self._piece, limit)

    def _encode(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        pieces = self._PIECE.findall(part)
        if "".join(pieces) != part:
            return self._encode(part)
        return b"".join(map(self.piece.__getitem__, pieces))

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            letters = piece.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            letters = piece.encode().decode("latin-1").translate(self._LETTERS)
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            return self._encode(text)
        pieces = self._PIECE.findall(text)
        if "".join(pieces) == text:
            return b"".join(map(self.piece.__getitem__, pieces))
        if "  " in text or text[-1:] == " ":
            return self._encode(text)
        first, *later = text.split(" ")
        return b"".join([self._part(first), *(self.part[" " + p] for p in later)])


@functools.lru_cache(2)
def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """One encoder per worker process, so its caches outlive a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, added_tokens=added_tokens)


def dac_encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, continuation bitmap, rank directory)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, BLOCK_BITS // 8).sum(1, dtype=np.uint32)
        rank = np.zeros(len(ones) + 1, np.uint32)
        np.cumsum(ones, out=rank[1:])
        levels.append(((rest & 0xFF).astype(np.uint8), bits, rank))
        if not more.any():
            return levels
        rest = rest[more] >> 8


def dac_decode(levels) -> np.ndarray:
    """All ids, level by level."""
    out = levels[0][0].astype(np.uint32)
    at = np.arange(len(out))
    for k in range(1, len(levels)):
        here = np.unpackbits(levels[k - 1][1], count=len(at), bitorder="little").view(bool)
        at = at[here]
        out[at] |= levels[k][0].astype(np.uint32) << (8 * k)
    return out


def dac_get(levels, i: int) -> int:
    """One id by its position, without decoding others."""
    value = 0
    for k, (chunks, bits, rank) in enumerate(levels):
        value |= int(chunks[i]) << (8 * k)
        if not bits[i >> 3] >> (i & 7) & 1:
            break
        block = i // BLOCK_BITS
        lo = block * (BLOCK_BITS // 8)
        before = np.bitwise_count(bits[lo : i >> 3]).sum(dtype=np.int64)
        before += (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        i = int(rank[block]) + int(before)
    return value


def pack_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file image: header, document ids (with null flags), bounds, levels."""
    out = [_MAGIC, b""]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    out.append(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes())
    bounds = np.zeros(len(lengths) + 1, "<u8")
    np.cumsum(lengths, out=bounds[1:])
    out.append(bounds.tobytes())
    levels = dac_encode(ids)
    out[1] = struct.pack("<III", len(doc_ids), len(levels), zlib.crc32(b"".join(out[2:])))
    for chunks, bits, rank in levels:
        body = chunks.tobytes() + bits.tobytes() + rank.astype("<u4").tobytes()
        out.append(struct.pack("<QQQI", len(chunks), len(bits), len(rank), zlib.crc32(body)) + body)
    return b"".join(out)


def open_file(raw: bytes):
    """``(doc_ids, bounds, levels)`` of a file image; checksums are verified."""
    if raw[:4] != _MAGIC:
        raise ValueError("not an id file")
    n, n_levels, crc = struct.unpack_from("<III", raw, 4)
    at = 16
    size = 8 * n + n + 8 * (n + 1)
    if zlib.crc32(raw[at : at + size]) != crc:
        raise ValueError("id file: directory checksum differs")
    doc_ids = np.frombuffer(raw, "<i8", n, at)
    known = np.frombuffer(raw, np.uint8, n, at + 8 * n)
    bounds = np.frombuffer(raw, "<u8", n + 1, at + 9 * n).astype(np.int64)
    at += size
    levels = []
    for _ in range(n_levels):
        a, b, c, crc = struct.unpack_from("<QQQI", raw, at)
        at += 28
        if zlib.crc32(raw[at : at + a + b + 4 * c]) != crc:
            raise ValueError("id file: level checksum differs")
        levels.append((
            np.frombuffer(raw, np.uint8, a, at),
            np.frombuffer(raw, np.uint8, b, at + a),
            np.frombuffer(raw, "<u4", c, at + a + b),
        ))
        at += a + b + 4 * c
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], bounds, levels


def write_id_files(
    docs: DataFrame, root: str, tokenizer: str, file_tokens: int = 4_000_000, added_tokens: bool = False
) -> DataFrame:
    """Encode every text, end id 0 after each, into id files under ``root`` in doc_id order.

    Returns the manifest ``part, seq, file, n_docs, n_tokens``. A file is named
    by its attempt, so a retried task writes new ones and only the files of the
    attempt that counted are in the manifest. Null texts are empty; null
    doc_ids come first; repeated rows are written as often as they occur. A
    document is never split over files; a file holds about ``file_tokens`` ids.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encode = encoder(tokenizer, added_tokens)
        part = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        seq, doc_ids, lengths, held, n = 0, [], [], [], 0

        def flush():
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(pack_file(doc_ids, lengths, np.frombuffer(b"".join(held), "<u4")))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "file": [name], "n_docs": [len(doc_ids)], "n_tokens": [n]}
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + _END
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                held.append(ids)
                n += lengths[-1]
                if n >= file_tokens:
                    yield flush()
                    seq, doc_ids, lengths, held, n = seq + 1, [], [], [], 0
        if doc_ids:
            yield flush()

    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = placed.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return materialise(
        placed.mapInArrow(write, "part long, seq long, file string, n_docs long, n_tokens long"), "ids"
    )


def read_id_files(manifest: DataFrame, root: str) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = manifest.sparkSession
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = manifest.withColumn("inside", F.coalesce(inside, F.lit(0))).join(totals, "part")
    starts = starts.select("file", (F.col("base") + F.col("inside")).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, first in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                doc_ids, bounds, levels = open_file(raw.as_py())
                ids = dac_decode(levels).astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first + bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if manifest.isEmpty():  # no document, no file
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(root)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(starts, "file").select("content", "first").mapInArrow(read, schema)


def id_files(docs: DataFrame, tokenizer: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Write all documents to id files in the shared folder and read them back (operator 9; ``added_tokens``: see ``Encoder``)."""
    root = scratch_path(docs.sparkSession, "llm-id-files")
    manifest = write_id_files(docs, root, tokenizer or default_tokenizer(), added_tokens=added_tokens)
    return read_id_files(manifest, root)
