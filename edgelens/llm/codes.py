"""Vector code compression by ball k-means (operator 12).

Vectors become integers and are cut into equal consecutive parts; each part position has a codebook, which starts as the
parts of the vectors with the smallest ids and is moved by rounds of exact k-means. Distances are squared and whole numbers,
so no bound is ever rounded. After the first round a part knows its entry, and the entries' balls save work: let d be
the part's distance to its entry. Another entry can be as near only if it stands within 2 d of that entry. So an
entry's neighbours are those within twice its ball's radius, the largest d of its parts; parts of the stable core, nearer
than half the way to the first neighbour, keep their entry without any comparison; the annular ring that a part lies in
tells how many of the neighbours, from the nearest on, it is compared with. Equal distances go to the lower index.
A ball is that of the parts in one block, which is never larger than the whole one.

A block (a row with up to an Arrow batch's vectors) is assigned and adds up its own parts in one pass; a round writes the
blocks with their codes anew, without a shuffle, and then reads only the sums. The codebooks (entries x
length numbers) are all that the driver holds and sends.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do those whose
scaled squared length reaches 2**58, whose length isn't a multiple of parts, or differs from that of the first one by id; rows with
null ids are coded, but as starting entries come last; repeated rows are coded alike; with fewer vectors than
entries there are as many entries as vectors; entries without parts stay; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edgelens.llm.common import integer_vectors
from edgelens.runtime import importable, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = float(1 << 58)
EXACT_FLOAT = 1 << 53


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every row of c, exactly."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * largest * largest * x.shape[1] < EXACT_FLOAT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(c)), dtype=np.int64)
    for i, row in enumerate(c):
        out[:, i] = ((x - row) ** 2).sum(1)
    return out


@dataclass
class Book:
    """One part position's entries, and for each the others by distance."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        apart = distances(self.entries, self.entries)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        self.compared = self.kept = 0  # pairs whose distance was taken, parts of stable cores

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part, with all entries compared."""
        d = distances(x, self.entries)
        code = d.argmin(1)
        return code, d[np.arange(len(x)), code]

    def again(self, x: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, from the entries of the round before."""
        code, best = old.copy(), ((x - self.entries[old]) ** 2).sum(1)
        order = np.argsort(old, kind="stable")
        used, start = np.unique(old[order], return_index=True)
        for e, mine in zip(used, np.split(order, start[1:])):
            radius = best[mine].max()
            neighbours = int(np.searchsorted(self.apart[e], 4 * radius, side="right"))
            rings = np.searchsorted(self.apart[e, :neighbours], 4 * best[mine], side="right")
            open_ = rings > 0
            self.kept += int((~open_).sum())
            mine, rings = mine[open_], rings[open_]
            if not len(mine):
                continue
            # outer rings first, so that parts of one reach are compared together
            for reach in np.unique(1 << np.ceil(np.log2(rings)).astype(np.int64)):
                inside = (rings <= reach) & (rings > reach // 2)
                part, others = mine[inside], self.near[e, : min(reach, neighbours)]
                d = distances(x[part], self.entries[others])
                self.compared += d.size
                least = d.min(1)
                index = np.where(d == least[:, None], others[None, :], len(self.entries)).min(1)
                better = (least < best[part]) | (least == best[part]) & (index < e)
                code[part[better]], best[part[better]] = index[better], least[better]
        return code, best


def blocks_of(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Blocks (v binary, codes binary, sums binary, kept columns as arrays) of the rows."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(1 + i)) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()), pa.array([None], pa.binary()), pa.array([None], pa.binary()), *lists], ["v", "codes", "sums", *keep])

    schema = "v binary, codes binary, sums binary" + "".join(f", `{c}` array<{kinds[c]}>" for c in keep)
    return rows.select("__v", *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def vectors_in(raw: bytes, parts: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64).reshape(-1, parts, width)


def assigned(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The blocks with every part's entry, and the sums and numbers of the parts of each entry."""
    parts, (entries, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        for b in batches:
            codes, sums = [], []
            for raw, old in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = vectors_in(raw, parts, width)
                before = None if old is None else np.frombuffer(old, dtype=np.uint8).reshape(-1, parts).astype(np.int64)
                code = np.stack([(k.first(x[:, p]) if before is None else k.again(x[:, p], before[:, p]))[0] for p, k in enumerate(own)], axis=1)
                total = np.zeros((parts, entries, width + 1), dtype=np.int64)
                for p in range(parts):
                    np.add.at(total[p, :, :width], code[:, p], x[:, p])
                    total[p, :, width] = np.bincount(code[:, p], minlength=entries)
                codes.append(code.astype(np.uint8).tobytes()), sums.append(total.tobytes())
            cols = list(b.columns)
            cols[1], cols[2] = pa.array(codes, pa.binary()), pa.array(sums, pa.binary())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return blocks.mapInArrow(run, blocks.schema)


def moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The entries in the middle of their parts, rounded down; those without parts stay."""
    parts, (entries, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                total += np.frombuffer(raw, dtype=np.int64).reshape(total.shape)
        p, e = np.nonzero(total[:, :, width])
        at = np.tile(np.arange(width + 1), len(p))
        p, e = np.repeat(p, width + 1), np.repeat(e, width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (p, e, at, total[p, e, at])], ["p", "e", "at", "x"])

    sums = blocks.select("sums").mapInArrow(run, "p long, e long, at long, x long").groupBy("p", "e", "at").agg(F.sum("x").alias("x"))
    total = np.zeros((parts, entries, width + 1), dtype=object)
    for r in sums.collect():  # a codebook's size
        total[r.p, r.e, r.at] = r.x
    out = []
    for p, book in enumerate(books):
        new = book.copy()
        for e in np.flatnonzero(total[p, :, width] != 0):
            new[e] = [s // total[p, e, width] for s in total[p, e, :width]]
        out.append(new)
    return out


def coded(blocks: DataFrame, books: list[np.ndarray], keep: list[str]) -> DataFrame:
    """A row for each vector: the kept columns, code array<int> and error."""
    parts, (_, width) = len(books), books[0].shape
    kinds = {f.name: f.dataType.elementType.simpleString() for f in blocks.schema if f.name in keep}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (raw, own) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                x, code = vectors_in(raw, parts, width), np.frombuffer(own, dtype=np.uint8).reshape(-1, parts)
                error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(1) for p in range(parts))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(code.astype(np.int32).ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(2 + j).slice(i, 1).flatten() for j in range(len(keep))], lists, pa.array(error)], [*keep, "code", "error"])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "code array<int>, error long"
    return blocks.select("v", "codes", *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def digest(books: list[np.ndarray]) -> str:
    """Hex digest of all entries' numbers by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, keep: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(keep..., code array<int>, error) of every vector, and the codebooks (at most 256 entries)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part")
    importable(vectors.sparkSession)
    keep = [c for c in dict.fromkeys(keep) if c.lower() not in ("code", "error")]
    rows = integer_vectors(vectors, vec_col, scale, LARGEST).where(F.size("__v") % parts == 0)
    order = [F.col(f"`{id_col}`").asc_nulls_last(), F.col("__v")]
    first = rows.select(F.col(f"`{id_col}`"), "__v").orderBy(*order).limit(1).collect()
    width = len(first[0]["__v"]) // parts if first else 1
    rows = rows.where(F.size("__v") == width * parts)
    start = np.array([r["__v"] for r in rows.select(F.col(f"`{id_col}`"), "__v").orderBy(*order).limit(entries).collect()], dtype=np.int64)
    books = [np.ascontiguousarray(p) for p in start.reshape(-1, parts, width).transpose(1, 0, 2)]
    blocks = blocks_of(rows, keep)
    for _ in range(rounds):
        blocks = stage(assigned(blocks, books), "code-blocks")
        books = moved(blocks, books)
    blocks = stage(assigned(blocks, books).withColumn("sums", F.lit(None).cast("binary")), "code-blocks")
    return coded(blocks, books, keep), books
