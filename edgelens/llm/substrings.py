"""Substring dedup behind a count-min prefilter (operator 13).

Words are runs of bytes between ASCII white space, a window is `window` consecutive words of one document, and a word
goes if a window that covers it also starts in a document with a smaller id. Few windows repeat, so all pass a count-min
sketch first. A window's key in the sketch is the smallest hash among the grams of gram words in it: neighbouring windows
share it, so a document brings about 2 / (window - gram + 2) keys a word, each once. A key is seen in at least as many
documents as any window that has it, and a sketch never counts too few, so the sketch overestimates windows' counts and
loses none that repeats. Every partition counts its own keys; the partial sketches are sent as cells and summed slice by
slice. Cells seen twice become one bit each, and these bits are broadcast: their number follows the number of keys up
to MAX_CELLS (128 MiB of bits); beyond about MAX_CELLS / 3 keys the sketch lets more windows through, and loses none.

The second pass groups exactly what the sketch lets through, in runs: the windows beside each other that share a key. Runs of
the same words have the same hash and are counted as one, by key and run; keys of only one document end here. Where a key
has a single run, the run's first document tells for all its windows; where it has several, their windows are counted by key
and window hash, and each learns the smallest id among all the runs that hold it. Groups are aggregated before
they are shuffled, and joins back to them send keys with very many rows by broadcast.

Windows are told apart by two 64-bit values, the key's and their own, as polynomials of 64-bit word hashes.

Defined results: null texts have no words and stay null; documents of less than a window's words stay; rows with null ids are
neither compared nor edited, only their words are counted; rows of one id do not remove each other's words, and repeated rows
are edited alike; kept words are joined by one space; no rows give no rows; a column that is called as a new one is
replaced, others pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.llm.common import append_columns, hot_limit, join_hot
from edgelens.runtime import importable, stage

WINDOW, GRAM = 50, 25
#: Cells of the sketch: rows, cells a key and row, at most in all, and in one slice.
ROWS, CELLS_PER_KEY, MAX_CELLS, SLICE_CELLS = 3, 2, 1 << 30, 1 << 18
#: Bytes and words that are hashed at a time; keys that a task holds before it sends their cells.
PIECE, HELD_KEYS = 1 << 20, 1 << 21
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray, by: int = 0xBF58476D1CE4E5B9) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(by)
    return h ^ (h >> np.uint64(29))


#: A 64-bit value for each byte, and for each row of the sketch a factor.
BYTES = mixed(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)), 0x94D049BB133111EB)
FACTORS = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93]


@lru_cache(2)
def powers(base: int) -> np.ndarray:
    out = np.full(PIECE + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each pair, the same wherever the values stand; at most PIECE values."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASE)[: len(values)], out=total[1:])
    return mixed((total[end] - total[start]) * powers(pow(BASE, -1, 1 << 64))[start])


def word_bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of each word of a text, and the one after its last."""
    inside = np.zeros(len(text) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[text]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: np.ndarray) -> np.ndarray:
    start, end = word_bounds(text)
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, side="right")))
        a, z = start[i], end[j - 1]
        if z - a <= PIECE:
            out[i:j] = spans_hash(BYTES[text[a:z]], start[i:j] - a, end[i:j] - a)
        else:  # one word longer than a piece
            own = np.uint64(0)
            for p in range(a, z, PIECE):
                part = BYTES[text[p : min(z, p + PIECE)]]
                own = mixed((np.array([own]) + spans_hash(part, np.array([0]), np.array([len(part)]))) * np.uint64(BASE))[0]
            out[i] = own
        i = j
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every width values beside each other."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[:n], x[width - span : width - span + n])


def windows(words: np.ndarray, window: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first word, keys, hashes) of a document's windows, a piece at a time."""
    at = 0
    while at + window <= len(words):
        part = words[at : at + PIECE]
        i = np.arange(len(part) - window + 1)
        g = np.arange(len(part) - gram + 1)
        key = sliding_min(spans_hash(part, g, g + gram), window - gram + 1)
        yield at, key, spans_hash(part, i, i + window)
        at += len(i)


def texts_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each text's UTF-8 bytes, without a copy."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    known = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[off[i] : off[i + 1]] if known[i] else None


def document_keys(docs: DataFrame, text_col: str, window: int, gram: int) -> DataFrame:
    """(n, keys binary): the different keys of each document that has windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for text in texts_of(b.column(0)):
                parts = [np.unique(k) for _, k, _ in windows(word_hashes(text), window, gram)] if text is not None else []
                if parts:
                    sets.append(np.unique(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["n", "keys"])

    return docs.select(text_col).mapInArrow(run, "n long, keys binary")


def cells_of(keys: np.ndarray, width: int) -> list[np.ndarray]:
    """The keys' cell in each row of the sketch; a row has width cells, a power of two."""
    return [(mixed(keys, f) & np.uint64(width - 1)) + np.uint64(r * width) for r, f in enumerate(FACTORS[:ROWS])]


def sketch(keys: DataFrame, width: int) -> DataFrame:
    """(slice, bits binary): the cells that two or more documents' keys fall into, a bit each."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n_held = 0

        def send() -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate([c for k in held for c in cells_of(k, width)]), return_counts=True)
            first, where = np.unique(cell // np.uint64(SLICE_CELLS), return_index=True)
            ends = [*where[1:], len(cell)]
            own, twice = (cell % np.uint64(SLICE_CELLS)).astype(np.uint32), (n > 1).astype(np.uint8)
            cols = [first.astype(np.int64), [own[a:z].tobytes() for a, z in zip(where, ends)], [twice[a:z].tobytes() for a, z in zip(where, ends)]]
            return pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], ["slice", "cells", "twice"])

        for b in batches:
            for row in b.column(0):
                held.append(np.frombuffer(row.as_py(), dtype=np.uint64))
                n_held += len(held[-1])
                if n_held >= HELD_KEYS:
                    yield send()
                    held, n_held = [], 0
        if held:
            yield send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())], ["slice", "bits"])
        for b in batches:
            for slice_, cells, twice in zip(*[c.to_pylist() for c in b.columns]):
                if slice_ != now:
                    if now is not None:
                        yield out()
                    now, count = slice_, np.zeros(SLICE_CELLS, dtype=np.uint8)
                cells = np.frombuffer(cells, dtype=np.uint32)  # each once
                count[cells] = np.minimum(2, count[cells] + 1 + np.frombuffer(twice, dtype=np.uint8))
        if now is not None:
            yield out()

    parts = keys.select("keys").mapInArrow(partial, "slice long, cells binary, twice binary")
    return parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "slice long, bits binary")


def repeated_runs(docs: DataFrame, id_col: str, text_col: str, width: int, bits, window: int, gram: int) -> DataFrame:
    """(m, r, id, t, at, n, h): the runs of windows that the sketch (a broadcast of its bits) lets through. m: their key, r: hash of the
    run, t: of the text, at: first word, n: number of windows, h: their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, dtype=np.uint8)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for own, t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                for at, key, h in windows(word_hashes(text), window, gram):
                    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    end = np.append(start[1:], len(key))
                    k = key[start]
                    again = np.ones(len(k), dtype=bool)
                    for c in cells_of(k, width):
                        again &= (seen[c >> np.uint64(3)] >> (np.uint8(7) - (c & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)
                    start, end, k = start[again], end[again], k[again]
                    if not len(k):
                        continue
                    r = spans_hash(h, start, end) + (end - start).astype(np.uint64)
                    inside = np.zeros(len(h) + 1, dtype=np.int64)
                    np.add.at(inside, start, 1)
                    np.add.at(inside, end, -1)
                    cols = (k.view(np.int64), r.view(np.int64), np.full(len(k), own), np.full(len(k), t), at + start, end - start, h[np.cumsum(inside[:-1]) > 0].view(np.int64))
                    for col, x in zip(out, cols):
                        col.append(x.astype(np.int64))
            if out[0]:
                m, r, own, t, at, n, h = (np.concatenate(x) for x in out)
                off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(h))
                yield pa.RecordBatch.from_arrays([*map(pa.array, (m, r, own, t, at, n.astype(np.int32))), lists], ["m", "r", "id", "t", "at", "n", "h"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    return rows.mapInArrow(run, "m long, r long, id long, t long, at long, n int, h array<long>")


def repeated_spans(runs: DataFrame) -> DataFrame:
    """(id, t, spans array<struct<at, n>>): for each document the first words and numbers of its windows that a smaller id has."""
    limit = hot_limit(runs.count())
    same = stage(runs.groupBy("m", "r").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("rows")), "substring-runs")
    keys = same.groupBy("m").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("kinds"), F.sum("rows").alias("rows"))
    keys = stage(keys.where("low < high"), "substring-keys")
    places = runs.select("m", "r", "id", "t", "at", "n")
    whole = join_hot(places, keys.where("kinds = 1").select("m", "low", "rows"), ["m"], "rows", limit).where("id > low").select("id", "t", F.struct("at", "n").alias("span"))
    # keys of several runs: each different run's windows, and the least id of each window
    one = F.min_by("h", "id").alias("h")
    kinds = join_hot(runs.select("m", "r", "id", "h"), keys.where("kinds > 1").select("m", "rows"), ["m"], "rows", limit).groupBy("m", "r").agg(one, F.min("id").alias("low"), F.count("*").alias("rows"))
    kinds = stage(kinds, "substring-kinds")
    own = kinds.select("m", "r", "low", F.posexplode("h").alias("i", "w"))
    least = own.groupBy("m", "w").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.count("*").alias("kinds"))
    kind_limit = hot_limit(kinds.count() * (WINDOW - GRAM + 1))
    firsts = join_hot(own.select("m", "r", "i", "w"), stage(least, "substring-windows"), ["m", "w"], "kinds", kind_limit)
    firsts = firsts.groupBy("m", "r").agg(F.array_sort(F.collect_list(F.struct("i", "least"))).alias("firsts"))
    firsts = firsts.join(kinds.select("m", "r", "rows"), ["m", "r"])
    mixed_runs = join_hot(places.select("m", "r", "id", "t", "at"), stage(firsts, "substring-firsts"), ["m", "r"], "rows", limit)
    later = F.filter("firsts", lambda x: x["least"] < F.col("id"))
    parts = mixed_runs.select("id", "t", F.explode(F.transform(later, lambda x: F.struct((F.col("at") + x["i"]).alias("at"), F.lit(1).alias("n")))).alias("span"))
    # a document's spans are at most as many as its words
    return whole.unionByName(parts).groupBy("id", "t").agg(F.collect_set("span").alias("spans"))


def without(text: np.ndarray, spans: np.ndarray, window: int) -> tuple[bytes, int, int]:
    """(kept words joined by one space, words, words taken out); spans: first words and numbers of windows."""
    start, end = word_bounds(text)
    gone = np.zeros(len(start) + 1, dtype=np.int64)
    np.add.at(gone, spans[:, 0], 1)
    np.add.at(gone, np.minimum(spans[:, 0] + spans[:, 1] + window - 1, len(start)), -1)
    keep = np.cumsum(gone[:-1]) == 0
    s, e = start[keep], end[keep]
    inside = np.zeros(len(text) + 1, dtype=np.int8)
    inside[s] += 1
    inside[e] -= 1
    kept = np.cumsum(inside[:-1], dtype=np.int8) > 0
    out = text.copy()
    out[e[:-1]] = 0x20  # the white space after each kept word but the last
    kept[e[:-1]] = True
    return out[kept].tobytes(), len(start), len(start) - len(s)


def edited(rows: DataFrame, text_col: str, window: int) -> DataFrame:
    """rows with kept text, n_words and n_removed, from its column __spans."""

    def make():
        def edit(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
            out, words, gone = [], [], []
            own = spans.to_pylist()
            for i, text in enumerate(texts_of(texts)):
                x = (None, 0, 0) if text is None else without(text, np.array([(s["at"], s["n"]) for s in own[i] or []], dtype=np.int64).reshape(-1, 2), window)
                out.append(x[0]), words.append(x[1]), gone.append(x[2])
            return [pa.array(out, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()), pa.array(gone, pa.int64())]

        return edit

    return append_columns(rows, [text_col, "__spans"], [("__kept", "string"), ("n_words", "long"), ("n_removed", "long")], make)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col without the words of windows that a smaller id has, and n_words (before) and n_removed."""
    spark = docs.sparkSession
    importable(spark)
    known = docs.where(F.col(id_col).isNotNull())
    keys = stage(document_keys(known, text_col, window, gram), "substring-sets")
    n = int(keys.agg(F.sum("n")).first()[0] or 0)
    width = min(1 << max(12, (CELLS_PER_KEY * n - 1).bit_length()), 1 << (MAX_CELLS // ROWS).bit_length() - 1)
    slices = -(-ROWS * width // SLICE_CELLS)
    found = np.zeros((slices, SLICE_CELLS // 8), dtype=np.uint8)
    for row in stage(sketch(keys, width), "substring-sketch").toLocalIterator():  # MAX_CELLS bits at most
        found[row.slice] = np.frombuffer(row.bits, dtype=np.uint8)
    bits = spark.sparkContext.broadcast(found.tobytes())
    runs = stage(repeated_runs(known, id_col, text_col, width, bits, window, gram), "substring-places")
    spans = stage(repeated_spans(runs), "substring-spans").select(F.col("id").alias("__id"), F.col("t").alias("__t"), F.col("spans").alias("__spans"))
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    own = (F.col(f"`{id_col}`").cast("long") == F.col("__id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__t"))
    out = edited(docs.select(*[F.col(f"`{c}`") for c in kept]).join(spans, own, "left"), text_col, window)

    def column(c: str) -> Column:
        return F.col("__kept").alias(c) if c == text_col else F.col(f"`{c}`")

    return out.select(*[column(c) for c in kept], "n_words", "n_removed")
