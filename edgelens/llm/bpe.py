"""BPE encoding and decoding as bounded-lookahead streaming transducers (operator 1).

Encoding never holds more of a word than a window. The merge list has a *sufficient lookahead* L:
a token of the window's own encoding that ends L or more symbols before the window's end is the
same whatever follows, so it can be emitted. Why: compare two texts with a common prefix while the
merges are applied in rank order. Up to a frontier both are split alike. Only a merge (u, v) whose u
ends at the frontier can move it, left by |u|; and the next merge that moves it must have a v that
begins with that u, and a higher rank. The heaviest such chain of merges bounds the movement.

A text passes as slices cut at blanks, where no word goes on: a task holds a bounded group of slices as words
and ids, whatever the texts' length, and each row's ids and decoded text grow as its slices pass.

Decoding maps ids to bytes and bytes to text with an incremental UTF-8 decoder, or, for a file that
names no decoder, to the tokens' own strings joined by single spaces.

Defined results: null text is the empty text; empty text has no tokens; texts of any length are
encoded whole; rows are independent, so ties, repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from edgelens.llm.common import append_columns

NONE = 1 << 30
SLICE_CHARS = 1 << 16
GROUP_CHARS = 2 << 20  # of the slices that a task holds as words and ids
WIDEST = 32


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    table = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str | None) -> int:
    """Symbols after a token that settle it, by the chain bound in the module's docstring."""
    heaviest: dict[str, int] = {}
    best = 0
    for u, v in merges:
        ended = bool(suffix) and v.endswith(suffix)
        v = v[: -len(suffix)] if ended else v
        # a prefix that reaches the end of a word-final v is another symbol sequence
        weight = len(u) + max((heaviest.get(v[:i], 0) for i in range(1, len(v) + (not ended))), default=0)
        heaviest[u] = max(heaviest.get(u, 0), weight)
        best = max(best, weight)
    return best


class Transducer:
    """Encodes one word from a stream of symbol ids; memory is one window, whatever the word's length."""

    def __init__(self, pairs: dict[int, int], merged: list[int], lookahead: int, lengths: list[int]):
        self.pairs, self.merged, self.lookahead, self.lengths = pairs, merged, lookahead, lengths
        self.window = 2 * (lookahead + max(lengths, default=1)) + 64
        self.buffer: list[int] = []

    def apply(self, ids: list[int]) -> list[int]:
        """All merges of ids, the lowest rank first and leftmost among equals; changes ids."""
        get, merged = self.pairs.get, self.merged
        ranks = [get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) != NONE:
            i = ranks.index(low)
            ids[i : i + 2] = [merged[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], NONE)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], NONE)
        return ids

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        """Take symbols; yield the tokens that became stable."""
        buffer, window, lengths = self.buffer, self.window, self.lengths
        for s in symbols:
            buffer.append(s)
            if len(buffer) < window:
                continue
            end, stable = 0, len(buffer) - self.lookahead
            for token in self.apply(buffer[:]):
                if end + lengths[token] > stable:
                    break
                end += lengths[token]
                yield token
            del buffer[:end]

    def finish(self) -> Iterator[int]:
        buffer, self.buffer = self.buffer, []
        yield from self.apply(buffer)


class Codec:
    """Encoder and decoder of one tokenizers-library JSON file with a BPE model over byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or None
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + self.suffix] for c in alphabet] if self.suffix else self.inner
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        size = max([*vocab.values(), *added.values()]) + 1
        self.surface = [""] * size
        for token, i in (vocab | added).items():
            self.surface[i] = token
        cut = len(self.suffix) if self.suffix else 0
        lengths = [len(t) - (cut if cut and t.endswith(self.suffix) else 0) for t in self.surface]
        pairs = {vocab[a] << 20 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        merged = [vocab[a + b] for a, b in merges]
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.transducer = Transducer(pairs, merged, self.lookahead, lengths)
        self.words = _splitter(spec)
        self.normal = _normaliser(spec)
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        back = {c: b for b, c in enumerate(alphabet)}
        self.raw = [
            t.encode() if t in added else bytes(back[c] for c in (t[:-cut] if cut and t.endswith(self.suffix) else t))
            for t in self.surface
        ]
        self.table = PairTable(pairs, merged)

    def word(self, word: str) -> bytes:
        """The ids of one pre-token as native 32-bit integers."""
        data = word.encode("utf-8", "surrogatepass")
        t, symbols = self.transducer, [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        out = array("i", t.feed(symbols))
        out.extend(t.finish())
        return out.tobytes()

    def split(self, chunk: str) -> list[str]:
        """The pre-tokens of normalised text without added tokens."""
        if chunk.isalpha():
            return [chunk]
        if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
            return [chunk[:-1], chunk[-1]]
        return [m.group() for m in self.words.finditer(chunk)]

    def encode(self, text: str) -> np.ndarray:
        """The ids of one whole text, as a stream: no more than a slice of it is held as words."""
        out: list[bytes] = []
        parts = self.special.split(text) if self.special and any(a in text for a in self.added) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(array("i", [self.added[part]]).tobytes())
                continue
            for piece in slices(part):
                out += [self.word(m.group()) for m in self.words.finditer(self.normal(piece))]
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of slices of texts: each different word of the group goes through the merges once."""
        alone = {i: self.encode(t) for i, t in enumerate(texts) if len(t) > GROUP_CHARS or any(a in t for a in self.added)}
        plain = pa.array(["" if i in alone else self.normal(t) for i, t in enumerate(texts)], type=pa.large_string())
        pieces = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        coded = pieces.values.dictionary_encode()
        word_of: dict[str, int] = {}
        chunk_words, chunk_offsets = array("i"), array("q", [0])
        for chunk in coded.dictionary.to_numpy(zero_copy_only=False).tolist():
            chunk_words.extend([word_of.setdefault(w, len(word_of)) for w in self.split(chunk)])
            chunk_offsets.append(len(chunk_words))
        offsets, ids = self.encode_words(list(word_of))
        bounds, ids = ragged_take(offsets, ids, np.frombuffer(chunk_words, dtype=np.int32))
        offsets, ids = ragged_take(bounds[np.frombuffer(chunk_offsets, dtype=np.int64)], ids, coded.indices.to_numpy())
        offsets = offsets[pieces.offsets.to_numpy()]
        if alone:
            each = [alone.get(i, ids[offsets[i] : offsets[i + 1]]) for i in range(len(texts))]
            offsets, ids = np.cumsum([0, *map(len, each)]), np.concatenate(each)
        return offsets, ids

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of pre-tokens. The end of a word settles its tokens as its lookahead would: words of
        up to WIDEST bytes end inside their window and run side by side, one merge of each a round; longer
        ones are fed to the transducer."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        counts, out = np.zeros(len(data), dtype=np.int64), []
        inner, last = np.array(self.inner, dtype=np.int32), np.array(self.last, dtype=np.int32)
        low = 0
        for high in (6, 10, 16, WIDEST):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(rows, max(1, len(rows) // 50_000)):
                if len(part):
                    n, raw = sizes[part], np.frombuffer(b"".join([data[i] for i in part]), dtype=np.uint8)
                    grid = np.full((len(part), high), -1, dtype=np.int32)
                    inside = np.arange(high) < n[:, None]
                    grid[inside] = inner[raw]
                    grid[np.arange(len(part)), n - 1] = last[raw[np.cumsum(n) - 1]]
                    counts[part], ids = self.table.merge(grid, n)
                    out.append((part, ids))
            low = high
        for i in np.flatnonzero(sizes > WIDEST):
            ids = np.frombuffer(self.word(words[i]), dtype=np.int32)
            counts[i] = len(ids)
            out.append(([i], ids))
        offsets = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(counts, out=offsets[1:])
        all_ids = np.empty(offsets[-1], dtype=np.int32)
        for part, ids in out:
            all_ids[spread(offsets[part], counts[part])] = ids
        return offsets, all_ids

    def decoder(self) -> Decoder:
        return Decoder(self)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def ragged_take(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows of (offsets, values), one after another."""
    counts = offsets[rows + 1] - offsets[rows]
    out = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out, values[spread(offsets[rows], counts)]


class PairTable:
    """The merges as an open-addressing table, looked up for many pairs at once."""

    BITS = 20

    def __init__(self, pairs: dict[int, int], merged: list[int]):
        keys = np.fromiter(pairs.keys(), dtype=np.int64, count=len(pairs))
        self.merged = np.array(merged, dtype=np.int32)
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.BITS, NONE, dtype=np.int32)
        self.probes = 1
        for slot, key, rank in zip(self.slots(keys).tolist(), keys.tolist(), pairs.values()):
            tried = 1
            while self.keys[slot] >= 0:
                slot, tried = (slot + 1) & ((1 << self.BITS) - 1), tried + 1
            self.keys[slot], self.ranks[slot] = key, rank
            self.probes = max(self.probes, tried)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs, NONE where there is no merge; -1 pads."""
        keys = a.astype(np.int64) << 20 | b
        keys = np.where((a < 0) | (b < 0), -2, keys)
        slots = self.slots(keys)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        for _ in range(self.probes):
            hit = self.keys[slots] == keys
            out[hit] = self.ranks[slots[hit]]
            slots = (slots + 1) & ((1 << self.BITS) - 1)
        return out

    def merge(self, grid: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of rows of symbols, padded with -1, after all merges."""
        n, width = grid.shape
        final, at = np.full((n, width), -1, dtype=np.int32), np.arange(n)
        ranks = np.full((n, width), NONE, dtype=np.int32)
        ranks[:, :-1] = self.rank(grid[:, :-1], grid[:, 1:])
        columns = np.arange(width)
        while len(at):
            where = ranks.argmin(axis=1)
            rows = np.arange(len(at))
            lowest = ranks[rows, where]
            done = lowest == NONE
            if done.any():
                final[at[done]] = grid[done]
                keep = ~done
                at, grid, ranks, where, lowest = at[keep], grid[keep], ranks[keep], where[keep], lowest[keep]
                rows = np.arange(len(at))
                if not len(at):
                    break
            source = np.minimum(columns + (columns > where[:, None]), width - 1)
            grid, ranks = np.take_along_axis(grid, source, 1), np.take_along_axis(ranks, source, 1)
            grid[:, -1], ranks[:, -1] = -1, NONE
            grid[rows, where] = self.merged[lowest]
            after = np.minimum(where + 1, width - 1)
            ranks[rows, where] = np.where(where + 1 < width, self.rank(grid[rows, where], grid[rows, after]), NONE)
            left = where > 0
            ranks[rows[left], where[left] - 1] = self.rank(grid[rows[left], where[left] - 1], grid[rows[left], where[left]])
        kept = final >= 0
        return kept.sum(axis=1), final[kept]


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """text in slices of about size characters, cut at spaces, where no word, composition or token spans."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class Decoder:
    """Turns a stream of ids into text. State: for byte-level files the bytes of an unfinished
    character (three at most); for files without a decoder whether a token came before."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace") if codec.byte_level else None
        self.any = False

    def feed(self, ids: Iterable[int]) -> str:
        if self.bytes:
            raw = self.codec.raw
            return self.bytes.decode(b"".join([raw[i] for i in ids]))
        surface = self.codec.surface
        text = " ".join([surface[i] for i in ids])
        lead, self.any = (" " if self.any and text else ""), self.any or bool(text)
        return lead + text

    def finish(self) -> str:
        return self.bytes.decode(b"", True) if self.bytes else ""


def _splitter(spec: dict) -> regex.Pattern:
    """The pattern whose matches are the pre-tokens."""
    steps = spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]]
    for s in steps:
        if s["type"] == "Split":
            if not (s["invert"] and s["behavior"] == "Removed"):
                raise ValueError("only a splitter that keeps its matches alone is supported")
            # \s of the library's pattern engine is the White_Space property
            return regex.compile(s["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
    raise ValueError("the file has no word splitter that drops white space")


def _normaliser(spec: dict):
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]

    def run(text: str) -> str:
        if not text.isascii():
            if "NFC" in kinds and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Lowercase" in kinds:
                text = text.replace("Σ", "σ")  # no final-sigma rule: case is by character
        return text.lower() if "Lowercase" in kinds else text

    return run


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec, with its bounded word caches, per worker and file."""
    return Codec(path)


def slice_groups(texts: pa.Array, chars: int = GROUP_CHARS) -> Iterator[list[tuple[int, str]]]:
    """(row, slice) of the texts of a batch, null as empty, in lists of about so many characters."""
    group, size = [], 0
    for row, t in enumerate(texts):
        for piece in slices(t.as_py() or ""):
            group.append((row, piece))
            size += len(piece)
            if size >= chars:
                yield group
                group, size = [], 0
    if group:
        yield group


def encode_decode(
    df: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str | None = "decoded"
) -> DataFrame:
    """df with the ids of each whole text (array<int>) and, unless decoded_col is None, the text
    decoded from those ids. Null text gives an empty array and an empty text."""

    def maker():
        c = codec(path)

        def run(texts: pa.Array):
            flat, counts, decoded = [np.zeros(0, dtype=np.int32)], np.zeros(len(texts), dtype=np.int64), []
            row, d, parts = 0, c.decoder(), []
            for group in slice_groups(texts):
                offsets, ids = c.encode_many([piece for _, piece in group])
                flat.append(ids)
                np.add.at(counts, [r for r, _ in group], np.diff(offsets))
                for (r, _), a, b in zip(group, offsets.tolist(), offsets[1:].tolist()) if decoded_col else ():
                    if r != row:
                        decoded.append("".join(parts) + d.finish())
                        row, d, parts = r, c.decoder(), []
                    parts.append(d.feed(ids[a:b].tolist()))
            if decoded_col and len(texts):
                decoded.append("".join(parts) + d.finish())
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), type=pa.int32()), pa.array(np.concatenate(flat)))
            return [ids, pa.array(decoded, type=pa.string())] if decoded_col else [ids]

        return run

    fields = [(ids_col, "array<int>")] + ([(decoded_col, "string")] if decoded_col else [])
    return append_columns(df, [text_col], fields, maker)
