"""Managed values in texts: a dictionary of any size matched in Arrow batches, and what of a URL or text is masked for it.

The dictionary goes to the tasks once, as one broadcast of its values, of at most MAX_BYTES; a worker builds its automaton when it
first needs it, and plans do not grow with the values. Texts are matched as bytes, folded in ASCII, as they are and after up
to DECODE_ROUNDS rounds of decoding. A decoded byte remembers the source bytes that it came from, so a match is always
a range of the source, whatever was decoded to find it.

Redaction maps ranges to the tokens that they cover: the segments of a path, the parameters of a query. A range inside one
token masks it. A range across tokens of which none is masked for itself masks the whole path, or the whole query, or where it
crosses the question mark the last segment and the first parameter, or everything if it reaches further.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.functions import columns as C
from edgelens.operators.addresses import plain_address
from edgelens.runtime import importable

MARKS, URL_MARKS = ["[masked]", "[*]", ""], ["[masked]", "[*]", "-", ""]
DECODE_ROUNDS = 3
LONG_VALUE = 8
#: Bytes of all values in a broadcast.
MAX_BYTES = 64 << 20
SCAN_BYTES = 6 * 1024  # past a kept prefix: the longest managed value, each byte escaped

_URL = re.compile(rb"%[uU]([0-9a-fA-F]{4})|%([0-9a-fA-F]{2})|\+")
_ENTITY = re.compile(rb"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)")
_ADDRESS = re.compile(rb"[0-9a-fA-F:.]+")
_DIGITS = re.compile(rb"[0-9.]+")
_ESCAPES = re.compile(rb"[%+&\x00]")


def _url_byte(m: re.Match) -> bytes:
    if m[0] == b"+":
        return b" "
    n = int(m[1] or m[2], 16)
    return bytes([n % 256 + (0x20 if n >> 8 == 0xFF and 0 < n % 256 < 0x5F else 0)])


_HEX = {b"%02x" % n: bytes([n]) for n in range(256)}
_HEX |= {f(k[:1]) + g(k[1:]): v for k, v in list(_HEX.items()) for f in (bytes.upper, bytes.lower) for g in (bytes.upper, bytes.lower)}


def _unquoted(raw: bytes) -> bytes:
    """What _URL makes of the bytes."""
    if b"%u" in raw or b"%U" in raw:
        return _URL.sub(_url_byte, raw)
    first, *rest = raw.replace(b"+", b" ").split(b"%")
    return first + b"".join([_HEX[p[:2]] + p[2:] if p[:2] in _HEX else b"%" + p for p in rest]) if rest else first


def _entity(m: re.Match) -> bytes:
    return html.unescape(m[0].decode()).encode("utf-8", "surrogatepass")


def _drop(m: re.Match) -> bytes:
    return b""


#: What a round does, one after the other: %XX, %uXXXX (its low byte, full-width letters as plain ones) and +; HTML entities; NUL.
STEPS = ((_URL, _url_byte), (_ENTITY, _entity), (re.compile(rb"\x00"), _drop))


@dataclass
class Traced:
    """Bytes, and for each of them where its source starts and ends."""

    raw: bytes
    start: list[int]
    end: list[int]

    @classmethod
    def of(cls, raw: bytes) -> Traced:
        return cls(raw, list(range(len(raw))), list(range(1, len(raw) + 1)))

    def replaced(self, pattern: re.Pattern, by) -> Traced:
        raw, start, end, at = bytearray(), [], [], 0
        for m in pattern.finditer(self.raw):
            a, z = m.span()
            new = by(m)
            raw += self.raw[at:a] + new
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[z - 1]] * len(new)
            at = z
        return Traced(bytes(raw + self.raw[at:]), start + self.start[at:], end + self.end[at:])


def rounds(raw: bytes) -> Iterator[Traced]:
    """The bytes as they are, and after each round of decoding that changes something."""
    t = Traced.of(raw)
    yield t
    for _ in range(DECODE_ROUNDS):
        if not _ESCAPES.search(t.raw):
            return
        new = t
        for pattern, by in STEPS:
            new = new.replaced(pattern, by)
        if new.raw == t.raw:
            return
        t = new
        yield t


def decodings(raw: bytes) -> Iterator[bytes]:
    """The bytes of rounds(), without their source: most texts hold nothing, and need no trace."""
    yield raw
    for _ in range(DECODE_ROUNDS):
        if not _ESCAPES.search(raw):
            return
        new = _unquoted(raw)
        new = _ENTITY.sub(_entity, new) if b"&" in new else new
        new = new.replace(b"\x00", b"")
        if new == raw:
            return
        raw = new
        yield raw


def decoded(text: str) -> list[str]:
    """A text as it is and after each round."""
    return [raw.decode("utf-8", "surrogateescape") for raw in decodings(text.encode("utf-8", "surrogateescape"))]


def folded(raw: bytes) -> str:
    """ASCII letters small; a character for each byte."""
    return raw.lower().decode("latin-1")


class Matcher:
    """The dictionary: values that count anywhere in a text, and short ones and addresses that count as whole tokens."""

    def __init__(self, values: list[str]) -> None:
        self.long, self.short, self.ips = ahocorasick.Automaton(), ahocorasick.Automaton(), set()
        own: dict[str, list[str]] = {}
        for v in sorted(set(values)):
            word = v.strip().encode()
            if not word:
                continue
            self.ips |= {ip for ip in map(plain_address, v.split(",")) if ip}
            for form in {folded(word), folded(word.replace(b"+", b" "))}:
                own.setdefault(form, []).append(v)
        for form, held in own.items():  # several values may have one form
            (self.long if len(form) >= LONG_VALUE else self.short).add_word(form, (len(form), held))
        for a in (self.long, self.short):
            if len(a):
                a.make_automaton()

    def among(self, texts: list[bytes], tokens: bool = False) -> set[int]:
        """Which of the texts may have spans() as they are: all that have, and of those with short values or addresses also some
        where these are no tokens. One search through all of them."""
        if tokens and self.ips:
            return set(range(len(texts)))
        whole = folded(b"\0".join(texts))
        ends, out = [], set()
        for which in (self.long, self.short) if tokens else (self.long,):
            for last, (n, _) in which.iter(whole) if len(which) else ():
                ends = ends or list(accumulate(len(t) + 1 for t in texts))
                i = bisect_right(ends, last)
                if last < ends[i] - 1 and last + 1 - n >= ends[i] - 1 - len(texts[i]):  # not across texts
                    out.add(i)
        return out

    def holding(self, texts: list[bytes], tokens: list[bool] | None = None) -> set[int]:
        """among() of the texts and what decoding makes of them; tokens: for each, whether short values and addresses count."""
        forms, own = [], []
        for i, t in enumerate(texts):
            new = list(decodings(t))
            forms += new
            own += [i] * len(new)
        out = {own[j] for j in self.among(forms)}
        some = [j for j, i in enumerate(own) if tokens[i]] if tokens else []
        return out | {own[some[j]] for j in self.among([forms[j] for j in some], True)}

    def spans(self, raw: bytes, tokens: bool) -> Iterator[tuple[int, int, str]]:
        """(start, end, value) of what these bytes hold as they are; tokens: also short values and addresses."""
        text = folded(raw)
        for which in (self.long, self.short) if tokens else (self.long,):
            for last, (n, held) in which.iter(text) if len(which) else ():
                a, z = last + 1 - n, last + 1
                if which is self.short and not self.whole(text, a, z):
                    continue
                for value in held:
                    yield a, z, value
        if tokens and self.ips:
            for pattern in (_ADDRESS, _DIGITS):
                for m in pattern.finditer(raw):
                    ip = plain_address(m[0].decode()) if b"." in m[0] or b":" in m[0] else None
                    if ip in self.ips:
                        yield m.start(), m.end(), ip

    def found(self, raw: bytes, tokens: bool) -> Iterator[tuple[int, int, str]]:
        """spans() of the source: of what it holds as it is and after each round. It is traced only where a decoded text holds
        something."""
        traced = None
        for i, plain in enumerate(decodings(raw)):
            for a, z, value in self.spans(plain, tokens):
                if not i:
                    yield a, z, value
                    continue
                traced = traced or list(rounds(raw))
                yield traced[i].start[a], traced[i].end[z - 1], value

    def values(self, raw: bytes) -> Iterator[str]:
        """The values of LONG_VALUE bytes or more that the source holds, as often as it does."""
        return (value for plain in decodings(raw) for _, _, value in self.spans(plain, False))

    @staticmethod
    def whole(text: str, a: int, z: int) -> bool:
        """Whether no letter or digit continues a letter or digit at either end."""
        word = lambda i: text[i].isascii() and text[i].isalnum()
        return not (a > 0 and word(a - 1) and word(a)) and not (z < len(text) and word(z) and word(z - 1))


def matcher(values: Broadcast) -> Matcher:
    """The worker's own; a broadcast's object lives as long as the worker knows the broadcast, and keeps it."""
    if not hasattr(values, "matcher"):
        values.matcher = Matcher(values.value)
    return values.matcher


def dictionary(managed: DataFrame) -> Broadcast:
    """The values of managed (name, value) for the tasks; their bytes are checked first."""
    own = managed.where("trim(value) <> ''").select("value").distinct()
    if (own.agg(F.sum(F.octet_length("value"))).first()[0] or 0) > MAX_BYTES:
        raise ValueError(f"more than {MAX_BYTES} bytes of managed values")
    importable(managed.sparkSession)
    return managed.sparkSession.sparkContext.broadcast(sorted(r.value for r in own.collect()))


def match_values(rows: DataFrame, managed: DataFrame, text: str, out: str = "managed") -> DataFrame:
    """rows with out, array<string>: the managed values of LONG_VALUE bytes or more that text holds, as it is or decoded, in
    order; of null text, none."""
    values = dictionary(managed)

    @F.pandas_udf("array<string>")
    def find(t: pd.Series) -> pd.Series:
        m = matcher(values)
        return t.map(lambda x: sorted(set(m.values((x or "").encode()))))

    return rows.withColumn(out, find(F.col(text)))


def choose_marker(values: list[str], marks: list[str] = MARKS) -> str:
    """The first marker that no managed value occurs in."""
    return next((m for m in marks if not any(v and v in m for v in values)), "")


def tokens_of(raw: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, in the query) of a target's segments and parameters, empty ones too."""
    path_end = raw.find(b"?") if b"?" in raw else len(raw)
    out, at = [], 0
    for i, part in enumerate((raw[:path_end].split(b"/"), raw[path_end + 1 :].split(b"&"))):
        if i and path_end == len(raw):
            break
        at = path_end + 1 if i else 0
        for p in part:
            out.append((at, at + len(p), bool(i)))
            at += len(p) + 1
    return out


def masked_target(target: str, m: Matcher, carried: bool, mark: str, limit: int | None = None) -> str:
    """A request target without managed values. Of a request that carries one, short values and addresses count as tokens,
    and a query goes whole. With limit only so many bytes and SCAN_BYTES more are looked at, and a token that reaches beyond,
    begins within limit and holds an escape is masked."""
    raw = target.encode()
    seen = raw if limit is None else raw[: limit + SCAN_BYTES].decode(errors="ignore").encode()
    tokens = tokens_of(seen)
    has_query = any(q for _, _, q in tokens)
    hit, across = set(), []
    for a, z, _ in m.found(seen, carried):
        over = [i for i, (s, e, _) in enumerate(tokens) if s < z and a < e or s == e and a < s < z]
        hit |= set(over[:1]) if len(over) == 1 else set()
        across += [over] if len(over) > 1 else []
    last = len(tokens) - 1
    if len(seen) < len(raw) and tokens[last][0] < (limit or 0) and re.search(rb"[%&]", seen[tokens[last][0] :]):
        hit.add(last)
    last_segment = max(i for i, (_, _, q) in enumerate(tokens) if not q)
    whole_path = whole_query = False
    for over in sorted({tuple(o) for o in across}):
        if hit & set(over):
            continue
        if not tokens[over[-1]][2]:
            whole_path = True
        elif tokens[over[0]][2]:
            whole_query = True
        elif over == (last_segment, last_segment + 1):
            hit |= set(over)
        else:
            whole_path = whole_query = True
    text = [mark if i in hit else seen[s:e].decode(errors="replace") for i, (s, e, _) in enumerate(tokens)]
    path = "/" + mark if whole_path else "/".join(text[: last_segment + 1])
    if not has_query:
        return path
    query = "&".join(text[last_segment + 1 :])
    return f"{path}?{mark if query and (carried or whole_query) else query}"


def masked_targets(targets: list[str], m: Matcher, carried: list[bool], mark: str, limit: int | None = None) -> list[str]:
    """masked_target() of each; those that hold nothing are searched together."""
    raw = [t.encode() for t in targets]
    short = [i for i, r in enumerate(raw) if limit is None or len(r) <= limit + SCAN_BYTES]
    held = m.holding([raw[i] for i in short], [carried[i] for i in short])
    free = {i for j, i in enumerate(short) if j not in held}
    out = []
    for i, target in enumerate(targets):
        if i in free:
            path, _, query = target.partition("?")
            out.append(f"{path}?{mark}" if query and carried[i] else target)
        else:
            out.append(masked_target(target, m, carried[i], mark, limit))
    return out


def redact(
    rows: DataFrame, managed: DataFrame, uri: str | None = "uri", texts: tuple[str, ...] = ("msg", "match_data"), carried: str = "carried", known: str | None = None, limit: int | None = None,
) -> DataFrame:
    """rows with managed values masked in a target and in texts. carried: whether the request carried a value; null where that
    is unknown, which masks all of both. known (optional): false where the version of that proof is unknown, which masks texts
    and treats targets as carrying. What is empty stays empty. With limit, targets are cut to so many bytes."""
    values = dictionary(managed)
    folds = [v.lower() for v in values.value]
    mark, url_mark = choose_marker(folds), choose_marker(folds, URL_MARKS)

    @F.pandas_udf("string")
    def url(u: pd.Series, all_: pd.Series) -> pd.Series:
        return pd.Series(masked_targets([a or "" for a in u], matcher(values), [bool(b) for b in all_], url_mark, limit), dtype=object)

    @F.pandas_udf("boolean")
    def holds(t: pd.Series) -> pd.Series:
        held = matcher(values).holding([(x or "").encode() for x in t])
        return pd.Series([i in held for i in range(len(t))], dtype=bool)

    state = F.col(carried)
    all_ = state if known is None else state | ~F.coalesce(known, F.lit(False))
    new = {}
    if uri:
        empty = F.coalesce(F.col(uri), F.lit("")) == ""
        target = F.when(empty, F.col(uri)).when(state.isNull(), "/" + URL_MARKS[0]).otherwise(url(F.col(uri), F.coalesce(all_, F.lit(True))))
        new[uri] = C.byte_cap(target, limit) if limit else target
    for c in texts:
        empty = F.coalesce(F.col(c), F.lit("")) == ""
        new[c] = F.when(empty, F.col(c)).when(state.isNull(), MARKS[0]).when(all_ | holds(F.col(c)), mark).otherwise(F.col(c))
    return rows.withColumns(new)
