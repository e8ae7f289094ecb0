"""SentencePiece encoding and decoding as weighted finite-state transduction.

Three transducers are compiled from a model file: the normaliser (a space becomes U+2581,
one is put in front), the pieces (a trie whose arcs weigh minus the piece's score) and
byte fallback (any other character becomes its UTF-8 byte pieces).  Each input is composed
with them and the shortest path over (min, +) gives the pieces.

In a byte-pair model the weights alone do not say which merges win, so states also carry
the last piece: an arc may follow only if merging the two pieces' text gives the two back.
A sequence of pieces is what the merges give exactly if that holds for each neighbouring
pair, so one path per prefix is left.  In a unigram model all arcs are free.

When no piece holds U+2581 behind another character, paths never cross the start of a run
of them; such stretches are solved once and remembered, a bounded number at a time; a worker
keeps what it remembers for its next task.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
REMEMBERED = 400_000
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)
_NOTHING: dict = {}
_STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else 4 if kind == 5 else 8
        yield tag >> 3, raw[at : at + n]
        at += n


@dataclass(frozen=True)
class Model:
    """Plain values, so that it can be broadcast."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    prefix: bool
    squeeze: bool

    def plain(self) -> tuple:
        return self.pieces, self.scores, self.kinds, self.bpe, self.prefix, self.squeeze


def read_model(path: str) -> Model:
    """Read a model file on the driver; normalisers with a character map are refused."""
    pieces, scores, kinds = [], [], []
    kind_of_model, prefix, squeeze = UNIGRAM, True, True
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in _fields(raw):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, _NORMAL))
        elif number == 2:
            kind_of_model = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            if own.get(2):
                raise ValueError("a normaliser with a character map is not supported")
            prefix, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
    if kind_of_model not in (UNIGRAM, BPE):
        raise ValueError("only unigram and byte-pair models are supported")
    return Model(pieces, scores, kinds, kind_of_model == BPE, prefix, squeeze)


class Transducer(dict):
    """Piece numbers of a stretch of normalised text, remembered by the stretch."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], bpe: bool, prefix: bool, squeeze: bool):
        super().__init__()
        self.bpe, self.prefix, self.squeeze = bpe, prefix, squeeze
        self.number = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k in (_NORMAL, _USER)}
        self.score = {p: scores[i] for p, i in self.number.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == _BYTE}
        self.unknown = next((i for i, k in enumerate(kinds) if k == _UNKNOWN), 0)
        self.penalty = 10.0 - min(self.score.values(), default=0.0)
        self.stretches = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.number)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.trie: dict = {}
        for p in self.number:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = (p, -self.score[p])
        # Neighbouring characters within some piece; between others no path can pass.
        self.inside = {p[i : i + 2] for p in self.number for i in range(len(p) - 1)}
        self.older: dict[str, bytes] = {}

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """What merging gives: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, last: str, piece: str) -> bool:
        if len(self.pairs) >= 2 * REMEMBERED:
            self.pairs.clear()
        free = self.pairs[last, piece] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return free

    def path(self, text: str) -> list[str]:
        """The pieces of the shortest path; characters without a piece stand for themselves."""
        last = self._only_paths(text) if self.bpe else self._shortest_paths(text)
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _only_paths(self, text: str) -> list[str]:
        """The last piece of the shortest path to the places of a byte-pair model's text.  One path is left
        to each, so none needs weighing: the arc that leads farthest is tried first, until the end is reached."""
        n, pairs, trie = len(text), self.pairs, self.trie
        last, arcs, at, before = [""] * (n + 1), [], 0, ""
        while at < n:
            first = text[at]
            arcs.append((before, first, at + 1))
            node = trie.get(first, _NOTHING)
            for end in range(at + 1, n):
                node = node.get(text[end])
                if node is None:
                    break
                if "" in node:
                    arcs.append((before, node[""][0], end + 1))
            while True:
                last_piece, piece, at = arcs.pop()
                if not last[at]:
                    free = pairs.get((last_piece, piece))
                    if self._may_follow(last_piece, piece) if free is None else free:
                        break
            last[at] = before = piece
        return last

    def _shortest_paths(self, text: str) -> list[str]:
        """The last piece of the shortest path to every place."""
        n, trie = len(text), self.trie
        cost, last = [0.0] + [float("inf")] * n, [""] * (n + 1)
        for start in range(n):
            paid, node, end = cost[start], trie, start
            while end < n:
                node = node.get(text[end])
                end += 1
                if node is None:
                    if end > start + 1:
                        break
                    node = _NOTHING
                    piece, weight = text[start], self.penalty
                elif "" in node:
                    piece, weight = node[""]
                elif end == start + 1:
                    piece, weight = text[start], self.penalty
                else:
                    continue
                if paid + weight < cost[end]:
                    cost[end], last[end] = paid + weight, piece
        return last

    def numbers(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.number.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        out = self.older.get(stretch)
        if out is None:
            inside = self.inside
            cuts = [i for i in range(1, len(stretch)) if stretch[i - 1 : i + 1] not in inside]
            if cuts:  # its parts may be known
                out = b"".join([self[stretch[a:b]] for a, b in zip([0, *cuts], [*cuts, len(stretch)], strict=True)])
            else:
                out = array("i", self.numbers(self.path(stretch))).tobytes()
        self[stretch] = out
        return out

    def coded(self, text: str | None) -> bytes:
        """The piece numbers of a text as 32-bit integers."""
        text = self.normalised(text or "")
        if not self.stretches:
            return array("i", self.numbers(self.path(text))).tobytes()
        return b"".join(map(self.__getitem__, _STRETCH.findall(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.coded(text), np.int32).tolist()


class Surface:
    """Text of piece numbers."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], bpe: bool, prefix: bool, squeeze: bool):
        own = [bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else " ⁇ ".encode() if k == _UNKNOWN else p.replace(SPACE, " ").encode()
               for p, k in zip(pieces, kinds, strict=True)]
        self.length = np.array([len(x) for x in own], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(own), np.uint8)
        self.strip = prefix or squeeze

    def texts(self, lists: pa.ListArray) -> pa.Array:
        """One text a row, null for null; bytes that are no UTF-8 are replaced."""
        numbers = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        length = self.length[numbers]
        after = np.r_[0, np.cumsum(length)]
        at = np.arange(after[-1]) + np.repeat(self.start[numbers] - after[:-1], length)
        data = self.data[at]
        bounds = after[np.r_[0, np.cumsum(sizes)]]
        if self.strip:
            led = bounds[:-1][bounds[:-1] < bounds[1:]]
            led = led[data[led] == 32]
            keep = np.ones(len(data), bool)
            keep[led] = False
            data = data[keep]
            bounds = bounds - np.searchsorted(led, bounds)
        raw = data.tobytes()
        null = np.asarray(lists.is_null())
        return pa.array([None if no else raw[a:b].decode(errors="replace") for a, b, no in zip(bounds[:-1].tolist(), bounds[1:].tolist(), null, strict=True)], pa.string())


def encode(docs: DataFrame, model: Model, *, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """docs with an array<int> column of piece numbers.

    A null text has null tokens, an empty one none.  A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.plain(), {}))  # the vocabulary
    source = docs.drop(tokens)

    def rows(batches):
        # Kept with the broadcast value, so that a worker's next task finds it.
        plain, kept = shared.value
        if "machine" not in kept:
            kept["machine"] = Transducer(*plain)
        machine = kept["machine"]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                own = texts.slice(at, 500)
                lists = [machine.coded(t) for t in own.to_pylist()]
                sizes = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in lists], out=sizes[1:])
                flat = np.frombuffer(b"".join(lists), np.int32)
                column = pa.ListArray.from_arrays(pa.array(sizes, mask=np.r_[np.asarray(own.is_null()), False]), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, tokens])

    return source.mapInArrow(rows, T.StructType([*source.schema.fields, T.StructField(tokens, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, model: Model, *, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """encoded with the text of its tokens; null tokens have a null text.  A column of that
    name is replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.plain())
    source = encoded.drop(text)

    def rows(batches):
        surface = Surface(*shared.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(tokens))
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, surface.texts(lists.slice(at, 500))], names=[*part.schema.names, text])

    return source.mapInArrow(rows, T.StructType([*source.schema.fields, T.StructField(text, T.StringType())]))
