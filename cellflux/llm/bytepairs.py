"""Byte-level BPE by longest matches and backtracking over compatible neighbours (operator 12)."""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.llm.common import released, worker_cache

_KNOWN_PIECES = 300_000  # pieces and pairs that a worker remembers; only speed depends on it
_KNOWN_PAIRS = 400_000
_ROWS = 500  # texts in one answer
_PIECES = 1 << 16  # pieces of a long text held at a time
_TOKENS = 1 << 18


class MergeTable:
    """The tokens of a rank file, and what their merges say about neighbours.

    A token longer than a byte is made by one last merge of two shorter ones (`halves`). Two tokens can
    stand side by side in an encoding if no merge joins them while they are made: the merges are
    undone from the latest to the earliest, and at each step the pair that touches must not be a token of a
    rank that would have come first. Every pair asked for is remembered. An encoding is the one sequence of
    tokens in which all neighbours can stand side by side, so that it can be found from the left: the longest
    token first, a shorter one where it does not fit, and a step back where none does. No place
    is left by a step back twice, so that the work grows with the length of the piece.
    """

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte has to be a token")
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._beside: dict[int, bool] = {}
        self._shorter: dict[int, int | None] = {}
        self._longest = ahocorasick.Automaton()
        # One character per byte, since the automaton reads characters.
        for token, rank in self.ranks.items():
            self._longest.add_word(token.decode("latin-1"), rank)
        self._longest.make_automaton()
        self._width = max(map(len, self.ranks))

    def _age(self, token: int) -> int:
        return token if len(self.tokens[token]) > 1 else -1

    def halves(self, token: int) -> tuple[int, int] | None:
        """What the last merge of a token joins; None if merges never make it."""
        if token not in self._halves:
            whole, found = self.tokens[token], None
            for cut in range(1, len(whole)):
                left, right = self.ranks.get(whole[:cut]), self.ranks.get(whole[cut:])
                if left is None or right is None or self._age(left) >= token or self._age(right) >= token:
                    continue
                if self.made(left) and self.made(right) and self._apart(left, right, token):
                    found = (left, right)
                    break
            self._halves[token] = found
        return self._halves[token]

    def made(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def _apart(self, left: int, right: int, below: int) -> bool:
        """Whether no merge of a rank under `below` takes the end of `left` and the start of `right`."""
        while True:
            joined = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joined is not None and joined < below:
                return False
            left_age, right_age = self._age(left), self._age(right)
            if left_age < 0 and right_age < 0:
                return True
            # Of merges of one rank the leftmost comes first, so that the right one is undone first.
            if left_age > right_age:
                below, left = left_age, self.halves(left)[1]
            else:
                below, right = right_age + 1, self.halves(right)[0]

    def beside(self, left: int, right: int) -> bool:
        """Whether an encoding can hold these two tokens in this order."""
        key = left * len(self.tokens) + right
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) >= _KNOWN_PAIRS:
                self._beside.clear()
            known = self._beside[key] = self._apart(left, right, sys.maxsize)
        return known

    def shorter(self, token: int) -> int | None:
        """The longest token that this one starts with."""
        if token not in self._shorter:
            whole = self.tokens[token]
            starts = (self.ranks.get(whole[:cut]) for cut in range(len(whole) - 1, 0, -1))
            self._shorter[token] = next((t for t in starts if t is not None), None)
        return self._shorter[token]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of text. A piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, ids, at, closed = piece.decode("latin-1"), [], 0, set()
        token = None
        while at < len(text):
            if token is None:
                token = next(self._longest.iter_long(text[at : at + self._width]))[1]
            end = at + len(self.tokens[token])
            if end not in closed and self.made(token) and (not ids or self.beside(ids[-1], token)):
                ids.append(token)
                at, token = end, None
                continue
            token = self.shorter(token)
            while token is None:  # nothing fits here, whatever led here
                closed.add(at)
                last = ids.pop()
                at -= len(self.tokens[last])
                token = self.shorter(last)
        return ids


class _Known(dict):
    """Encoded pieces as little-endian 32-bit ids."""

    def __init__(self, table: MergeTable):
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _KNOWN_PIECES:
            for old in list(islice(self, _KNOWN_PIECES // 2)):
                del self[old]
        ids = packed_ids(self.table.encode(piece.encode()))
        if len(ids) <= 256:
            self[piece] = ids
        return ids


def packed_ids(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpacked_ids(raw: bytes) -> array:
    out = array("I")
    out.frombytes(raw)
    if sys.byteorder == "big":
        out.byteswap()
    return out


class Splitter:
    """Cuts a text by a pattern as the tiktoken library does.

    That library knows the letters and numbers of another edition of Unicode than the `regex` module. It is
    asked which characters it takes for either; a text with a character on which the two differ is cut by a
    pattern that lists the ranges.
    """

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {bytes([b]): b for b in range(256)}
        differing: set[str] = set()
        listed = pattern
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
            theirs = set(bytes(asked.encode_ordinary(everything)).decode())
            differing |= theirs ^ set(regex.findall(name, everything))
            listed = listed.replace(name, f"[{_ranges(theirs)}]")
        # A class within a class is the same characters without its own brackets.
        listed = re.sub(r"\[\^((?:\[[^\[\]]*\])+)\]", lambda m: "[^" + re.sub(r"[\[\]]", "", m[1]) + "]", listed)
        self.plain = regex.compile(pattern)
        self.listed = regex.compile(listed)
        self.differing = regex.compile(f"[{_ranges(differing)}]") if differing else None

    def pieces(self, text: str) -> Iterator[list[str]]:
        pattern = self.plain
        if self.differing and not text.isascii() and self.differing.search(text):
            pattern = self.listed
        if len(text) < _PIECES:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, _PIECES)):
            yield part


def _ranges(characters: set[str]) -> str:
    """The characters as ranges of a pattern's class."""
    points, out = sorted(map(ord, characters)), []
    for point in points:
        if out and out[-1][1] == point - 1:
            out[-1][1] = point
        else:
            out.append([point, point])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


def _encoder(path: str, pattern: str) -> tuple[Splitter, _Known]:
    kept = worker_cache("byte-pairs")
    if (path, pattern) not in kept:
        kept[path, pattern] = (Splitter(pattern), _Known(MergeTable(path)))
    return kept[path, pattern]


def _decoder(path: str) -> list[bytes]:
    kept = worker_cache("byte-pairs")
    if path not in kept:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
        for token, rank in pairs:
            tokens[int(rank)] = base64.b64decode(token)
        kept[path] = tokens
    return kept[path]


def _mapped(rows: DataFrame, column: str, kind: str, result: str, work) -> DataFrame:
    """`rows` with the binary column `result`, by a function from a list of values to a list of bytes."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                values = part.column(names.index(column)).cast(kind).to_pylist()
                out = pa.array(work(values), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*names, result])

    given = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(lambda batches: released(run(batches)), f"{given}, {result} binary")


def encoded(docs: DataFrame, ranks: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, and ids: the BPE ids of every whole text, as little-endian unsigned 32-bit integers in a binary.

    `ranks` is a file of base64 tokens and ranks, readable on every executor; `pattern` cuts a text into the
    pieces that are merged by themselves. A missing or empty text has no ids (an empty binary). Rows keep
    their number and ids whatever they repeat; all other columns of `docs` are left out, so that no name
    clashes. A row depends on its text alone: there is no shuffle, and a lost task is redone from its input.
    """

    def work(texts: list[str | None]) -> list[bytes]:
        splitter, known = _encoder(ranks, pattern)
        return [b"".join([b"".join(map(known.__getitem__, p)) for p in splitter.pieces(t or "")]) for t in texts]

    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return _mapped(rows, "text", "string", "ids", work).select(*keep, "ids")


def decoded(rows: DataFrame, ranks: str) -> DataFrame:
    """`rows` of `encoded` (doc_id, ids) with `bytes`: the bytes that the ids stand for.

    No ids are no bytes; missing ids count as none. An id that the file lacks fails the job.
    """

    def work(all_ids: list[bytes | None]) -> list[bytes]:
        tokens, out = _decoder(ranks), []
        for raw in all_ids:
            ids = unpacked_ids(raw or b"")
            parts = (map(tokens.__getitem__, ids[i : i + _TOKENS]) for i in range(0, len(ids), _TOKENS))
            out.append(b"".join([b"".join(p) for p in parts]))
        return out

    return _mapped(rows.select("doc_id", "ids"), "ids", "binary", "bytes", work)
