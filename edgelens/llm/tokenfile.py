"""Token ids as patched frame-of-reference blocks (operator 4).

A block of BLOCK ids stores their minimum, the differences packed at the width that PERCENTILE of them fit,
and the others as exceptions (position, full difference). A segment is a run of whole documents of at
least SEGMENT ids: magic, counts, the byte offset of every block, the blocks. Segments are the rows of a
Parquet table in the shared folder, so any store that Spark writes to holds them:

    shard int, segment int, first long (ids before it in its shard), doc_ids array<long>,
    doc_sizes array<long>, payload binary

Shards are ranges of doc_id in ascending order. A reader can decode one block, by its offset, or all.

Defined results: null and empty texts have no ids of their own, just the end id; rows are ordered by
(doc_id, text), null ids first, so repeated rows are written one after another; an empty table writes no
segment; one document of any length is one segment.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from edgelens.llm.bpe import ragged_take, spread
from edgelens.runtime import importable, shared_dir

BLOCK = 1024
GROUP_CHARS = 8 << 20
SEGMENT = 1 << 18
PERCENTILE = 0.95
MAGIC = b"PFR1"
HEAD = struct.Struct("<4sQI")
BLOCK_HEAD = struct.Struct("<IBHH")  # minimum, width, exceptions, ids


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = (ids - low).astype(np.uint32)
    fit = np.partition(rest, k := min(len(rest) - 1, int(PERCENTILE * len(rest))))[k]
    width = int(fit).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    kept = rest.copy()
    kept[odd] = 0
    bits = (kept[:, None] >> np.arange(width, dtype=np.uint32) & 1).astype(np.uint8)
    return b"".join((
        BLOCK_HEAD.pack(low, width, len(odd), len(ids)), odd.astype("<u2").tobytes(), rest[odd].astype("<u4").tobytes(),
        np.packbits(bits.reshape(-1), bitorder="little").tobytes(),
    ))


def unpack_block(data: memoryview, at: int) -> np.ndarray:
    low, width, n_odd, n = BLOCK_HEAD.unpack_from(data, at)
    at += BLOCK_HEAD.size
    odd, at = np.frombuffer(data, "<u2", n_odd, at), at + 2 * n_odd
    values, at = np.frombuffer(data, "<u4", n_odd, at), at + 4 * n_odd
    packed = np.frombuffer(data, np.uint8, -(-n * width // 8), at)
    bits = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    pad = np.zeros((n, 32), dtype=np.uint8)
    pad[:, :width] = bits
    out = np.packbits(pad, axis=1, bitorder="little").view("<u4").reshape(-1).copy()
    out[odd] = values
    return out + np.uint32(low)


def pack_segment(ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    body = HEAD.size + 8 * len(blocks)
    starts = body + np.cumsum([0, *map(len, blocks[:-1])]) if blocks else np.zeros(0)
    return HEAD.pack(MAGIC, len(ids), len(blocks)) + starts.astype("<u8").tobytes() + b"".join(blocks)


def block_starts(payload: bytes) -> np.ndarray:
    magic, _, n = HEAD.unpack_from(payload, 0)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    return np.frombuffer(payload, "<u8", n, HEAD.size)


def unpack_segment(payload: bytes) -> np.ndarray:
    data = memoryview(payload)
    parts = [unpack_block(data, int(at)) for at in block_starts(payload)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


class LibraryEncoder:
    """The tokenizers library over pieces of text that the byte-level splitter always separates.

    A blank before a non-blank begins a pre-token, whatever came before; so does a punctuation mark after a
    letter, and a single line feed between two other characters stands alone. Texts are cut at these places,
    and each different piece of a group of texts is encoded once; the latest REMEMBERED short ones are kept for the
    next groups. Words after a blank go through the library many to a text, and the ids are dealt back by the
    bytes that they stand for. Texts that hold an added token are encoded whole.
    """

    MARK = "\x01"
    APART = re.compile(r" \s|\x01")
    WORD = r"^ [\p{L}\p{M}\p{N}\p{P}\p{S}]+$"
    JOINED_BYTES = 1 << 16
    REMEMBERED, SHORT = 1_000_000, 32

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.no_truncation()
        self.t.no_padding()
        self.added = [a.content for a in self.t.get_added_tokens_decoder().values()]
        # a token of a byte-level vocabulary has a character for each byte
        vocab = self.t.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        self.bytes[list(vocab.values())] = list(map(len, vocab))
        self.known = pa.array([], type=pa.large_string())
        self.known_ids = (np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of words that begin with a blank."""
        ends = np.cumsum(pc.binary_length(words).to_numpy())
        cuts = np.unique(np.searchsorted(ends, np.arange(self.JOINED_BYTES, ends[-1] + self.JOINED_BYTES, self.JOINED_BYTES)).clip(0, len(ends) - 1))
        texts = [t.as_py() for t in pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], cuts + 1]).astype(np.int32), words.cast(pa.string())), "")]
        ids = np.concatenate(self.whole(texts))
        read = np.cumsum(self.bytes[ids])
        at = np.searchsorted(read, ends)
        if read[-1] != ends[-1] or (read[at] != ends).any():
            raise ValueError("a token of this file spans two words")
        return np.diff(at, prepend=-1), ids

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of different pieces, of which those seen lately are looked up."""
        at = pc.index_in(pieces, value_set=self.known)
        new = np.flatnonzero(pc.is_null(at).to_numpy(zero_copy_only=False))
        fresh = pieces.take(pa.array(new))
        offsets, ids = self.encoded(fresh)
        # the known pieces and the new ones in one ragged table, from which both are taken
        n, (seen, old) = len(self.known), self.known_ids
        offsets, ids = np.concatenate([seen, seen[-1] + offsets[1:]]), np.concatenate([old, ids])
        rows = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        rows[new] = n + np.arange(len(new))
        out = ragged_take(offsets, ids, rows)
        short = np.flatnonzero((pc.binary_length(fresh).to_numpy() <= self.SHORT))
        kept = np.concatenate([np.arange(n), n + short])
        if len(kept) > self.REMEMBERED:
            kept = kept[-self.REMEMBERED // 2 :]
        self.known = pa.concat_arrays([self.known, fresh]).take(pa.array(kept))
        self.known_ids = ragged_take(offsets, ids, kept)
        return out

    def encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of different pieces, encoded by the library."""
        word = pc.match_substring_regex(pieces, self.WORD)
        rows = np.flatnonzero(word.to_numpy(zero_copy_only=False))
        rest = np.flatnonzero(~word.to_numpy(zero_copy_only=False))
        alone = self.whole(pieces.take(pa.array(rest)).to_pylist())
        counts = np.zeros(len(pieces), dtype=np.int64)
        counts[rest] = [len(i) for i in alone]
        ids = np.zeros(0, dtype=np.int32)
        if len(rows):
            counts[rows], ids = self.joined(pieces.take(pa.array(rows)))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(offsets[-1], dtype=np.int32)
        out[spread(offsets[rows], counts[rows])] = ids
        if alone:
            out[spread(offsets[rest], counts[rest])] = np.concatenate(alone)
        return offsets, out

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts."""
        apart = [i for i, t in enumerate(texts) if self.APART.search(t) or any(a in t for a in self.added)]
        alone = dict(zip(apart, self.whole([texts[i] for i in apart]))) if apart else {}
        plain = pa.array(["" if i in alone else t for i, t in enumerate(texts)], type=pa.large_string())
        cut = pc.replace_substring_regex(plain, r"(\p{L})([,.;:!?])", rf"\1{self.MARK}\2")
        cut = pc.replace_substring_regex(cut, r"([\p{L}\p{N}\p{P}])\n([\p{L}\p{N}\p{P}])", f"\\1{self.MARK}\n{self.MARK}\\2")
        pieces = pc.split_pattern(pc.replace_substring(cut, " ", self.MARK + " "), self.MARK)
        coded = pieces.values.dictionary_encode()
        offsets, flat = self.pieces(coded.dictionary)
        offsets, ids = ragged_take(offsets, flat, coded.indices.to_numpy())
        offsets = offsets[pieces.offsets.to_numpy()]
        if alone:
            parts = [alone.get(i, ids[offsets[i] : offsets[i + 1]]) for i in range(len(texts))]
            offsets, ids = np.cumsum([0, *map(len, parts)]), np.concatenate(parts)
        return offsets, ids


def text_groups(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list[int], list[str]]]:
    """(ids, texts) of the rows (id, text) of all batches, in lists of about so many characters."""
    keys, texts, size = [], [], 0
    for b in batches:
        for key, t in zip(b.column(0).to_pylist(), b.column(1)):
            t = t.as_py()
            keys.append(key)
            texts.append(t)
            size += len(t)
            if size >= chars:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write(
    docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    encoder: Callable[[str], LibraryEncoder] = library_encoder,
) -> None:
    """Encode whole texts, end each document with end_id, and write them in ascending id order."""
    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["shard", "segment", "first", "doc_ids", "doc_sizes", "payload"]

    def run(batches: Iterator[pa.RecordBatch]):
        enc, shard = encoder(tokenizer_path), TaskContext.get().partitionId()
        segment, first = 0, 0
        doc_ids: list[int] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []

        def flush():
            nonlocal segment, first, doc_ids, sizes, held
            ids = np.concatenate(held)
            row = [[shard], [segment], [first], [doc_ids], [sizes], [pack_segment(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            segment, first, doc_ids, sizes, held = segment + 1, first + len(ids), [], [], []
            return pa.RecordBatch.from_arrays([pa.array(r, type=t) for r, t in zip(row, kinds)], names)

        pending = 0
        end = np.array([end_id], dtype=np.int32)
        for keys, group in text_groups(batches, GROUP_CHARS):
            offsets, ids = enc.encode_many(group)
            for key, a, z in zip(keys, offsets.tolist(), offsets[1:].tolist()):
                doc_ids.append(key)
                sizes.append(z - a + 1)
                held += [ids[a:z], end]
                pending += z - a + 1
                if pending >= SEGMENT:
                    yield flush()
                    pending = 0
        if doc_ids:
            yield flush()

    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    schema = "shard int, segment int, first long, doc_ids array<long>, doc_sizes array<long>, payload binary"
    ordered.mapInArrow(run, schema).write.parquet(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary of little-endian unsigned 32-bit) from the files."""
    return _decode(spark, path, "ids binary", lambda ids: ids.astype("<u4").tobytes())


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, without returning the ids."""
    return _decode(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _decode(spark: SparkSession, path: str, column: str, of: Callable) -> DataFrame:
    schema = "shard int, segment int, first long, doc_ids array<long>, doc_sizes array<long>, payload binary"
    files = spark.read.schema(schema).parquet(path)
    # a row for each shard; there are no more shards than the writer had partitions
    sizes = files.groupBy("shard").agg(F.sum(F.aggregate("doc_sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.join(F.broadcast(sizes.select("shard", before.alias("before"))), "shard")
    names = ["doc_id", "start", "n_tokens", column.split()[0]]

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = unpack_segment(r["payload"])
                ends = np.cumsum(r["doc_sizes"])
                starts = ends - r["doc_sizes"]
                values = [of(ids[a:z]) for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], type=pa.int64()), pa.array(starts + r["start"]), pa.array(r["doc_sizes"], type=pa.int64()), pa.array(values)], names
                )

    rows = placed.select((F.col("before") + F.col("first")).alias("start"), "doc_ids", "doc_sizes", "payload")
    return rows.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def new_path(spark: SparkSession) -> str:
    import uuid

    return f"{shared_dir(spark)}/token-file-{uuid.uuid4().hex}"
