"""Alignment of two tokenizers' tokens by merge-path pieces (operator 13)."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflux.llm.common import materialise, released, worker_cache

PIECE = 1 << 15  # token ends of both sides in one piece of the merge
BLOCK = 1 << 22  # bytes of text whose id pairs are counted together
_TEXT = 1 << 17  # characters that a tokenizer gets at a time
_KNOWN_WORDS = 200_000  # words that a worker remembers; only speed depends on it
_PAIRS = 1 << 21  # linked pairs held at a time while they are counted
_WIDE = 64  # pairs from which on the tokens of a group are added up by id first

# How a byte-level vocabulary writes bytes that are no visible character.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SPACE = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary."""
    hidden = [b for b in range(256) if b not in set(_VISIBLE)]
    return {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Side:
    """One tokenizer: the bytes of each id, and ids written in three ways for the groups' text."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class ByteLevelSide(_Side):
    """A byte-level vocabulary of the tokenizers library; a text is encoded with a space before it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        size = 1 + max([*vocabulary.values(), *self.tokenizer.get_vocab().values()])
        letters, tokens = _byte_level(), [b""] * size
        for token, number in vocabulary.items():
            if all(c in letters for c in token):
                tokens[number] = bytes(letters[c] for c in token)
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [f.ids for f in found]


class PieceSide(_Side):
    """A sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            byte = _BYTE_PIECE.fullmatch(piece) if self.model.is_byte(number) else None
            tokens.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode())
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


# Neither tokenizer has a token that reaches over a blank between these, and both put a blank before the next word.
_CUT = re.compile(f" (?=[^\\s{_SPACE}])(?<=[^ {_SPACE}] )")


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Where the merge of two ascending sequences is cut: rows (taken of a, taken of b).

    A binary search along each diagonal of the merge grid finds the point through which the merge passes, for
    every `piece`-th step, all searches at once. An end of `a` comes before an equal one of `b`. Each piece between two
    points has the same number of steps, however unlike the sequences are.
    """
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        other = steps - 1 - middle
        # a[middle] is among the first `step` ends if it is not greater than b[other].
        taken = np.zeros(len(steps), bool)
        taken[open_] = a[middle[open_]] <= b[other[open_]]
        low = np.where(open_ & taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return np.column_stack([low, steps - low])


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int, int]:
    """One piece by itself: group of each of its tokens, counted from 0, number of groups it closes, first and last end.

    Tokens overlap until both sides end at the same byte, which closes their group.
    """
    at_a = np.arange(len(a)) + np.searchsorted(b, a, "left")
    at_b = np.arange(len(b)) + np.searchsorted(a, b, "right")
    ends = np.empty(len(a) + len(b), np.int64)
    ends[at_a], ends[at_b] = a, b
    closes = np.r_[False, ends[1:] == ends[:-1]]
    group = np.cumsum(closes) - closes
    return group[at_a], group[at_b], int(closes.sum()), int(ends[0]), int(ends[-1])


def groups(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of a and of b, by their ascending ends in bytes; both end at the same byte.

    The pieces are merged independently. Stitching goes on counting from the groups of the pieces before; where a
    piece's first end is the last one of the piece before (a's end there, b's here), that end closes a group too.
    """
    cuts = diagonals(a, b, piece)
    group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    closed, last = 0, None
    for (a0, b0), (a1, b1) in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a0 == a1 and b0 == b1:
            continue
        own_a, own_b, closes, first, stop = _merged(a[a0:a1], b[b0:b1])
        stitched = int(first == last)
        group_a[a0:a1] = own_a + closed + stitched
        group_b[b0:b1] = own_b + closed + stitched
        if stitched:
            group_b[b0] = closed
        closed += closes + stitched
        last = stop
    return group_a, group_b


def _added_up(group: np.ndarray, ids: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens as (group, id, times): one row per token, in wide groups one per id."""
    held = wide[group]
    if not held.any():
        return group, ids, np.ones(len(ids), np.int64)
    key, times = np.unique(group[held].astype(np.int64) << 32 | ids[held], return_counts=True)
    group = np.concatenate([group[~held], key >> 32])
    ids = np.concatenate([ids[~held], key & 0xFFFFFFFF])
    times = np.concatenate([np.ones(int((~held).sum()), np.int64), times])
    order = np.argsort(group, kind="stable")
    return group[order], ids[order], times[order]


def _linked(doc, a_group, a_ids, b_group, b_ids) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, id pair, times) of the links, each pair of a document once; documents in order.

    `doc` is the document of each group. Pairs are made for a bounded number of tokens at a time; what the
    parts of a document say is added up.
    """
    n = len(doc)
    sizes = np.bincount(a_group, minlength=n) * np.bincount(b_group, minlength=n)
    wide = sizes > _WIDE
    a_group, a_ids, a_times = _added_up(a_group, a_ids, wide)
    b_group, b_ids, b_times = _added_up(b_group, b_ids, wide)
    b_count = np.bincount(b_group, minlength=n)
    b_first = np.cumsum(b_count) - b_count
    partners = b_count[a_group]
    through = np.cumsum(partners)
    begin, rest = 0, None
    while begin < len(a_ids):
        base = through[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(through, base + _PAIRS, "right")))
        some = slice(begin, stop)
        count = partners[some]
        left = np.repeat(np.arange(begin, stop), count)
        right = b_first[a_group[left]] + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        pair = a_ids[left].astype(np.int64) << 32 | b_ids[right]
        rows = (doc[a_group[left]], pair, a_times[left] * b_times[right])
        if rest is not None:
            rows = tuple(np.concatenate(x) for x in zip(rest, rows, strict=True))
        rows = _summed(*rows)
        # The last document may go on in the next part.
        whole = len(rows[0]) if stop == len(a_ids) else int(np.searchsorted(rows[0], rows[0][-1]))
        yield tuple(x[:whole] for x in rows)
        rest, begin = tuple(x[whole:] for x in rows), stop


def _summed(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    first = np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])][: len(doc)]
    at = np.flatnonzero(first)
    return doc[at], pair[at], np.add.reduceat(times, at) if len(at) else times


# A word that can stand between blanks as in `_CUT`.
_PLAIN = re.compile(rf"^[^\s{_SPACE}](?:.*[^ {_SPACE}])?$", re.DOTALL)


def _portions(words: list[str]) -> Iterator[list[str]]:
    held, begin = 0, 0
    for i, word in enumerate(words):
        held += len(word) + 1
        if held > _TEXT or i == len(words) - 1:
            yield words[begin : i + 1]
            held, begin = 0, i + 1


def _cut(side: _Side, text: str, whole: bytes, ends: np.ndarray) -> list[bytes] | None:
    """Ids of each word of a text, by the bytes at which words end; None if not all come back whole."""
    ids = side.encode([text])[0]
    if side.bytes_of(ids) != whole:
        return None
    raw = np.array(ids, np.int32)
    token_ends = np.cumsum(side.lengths[raw])
    stops = np.searchsorted(token_ends, ends)
    if (token_ends[stops] != ends).any():
        return None
    packed, at = raw.tobytes(), [0, *((stops + 1) * 4).tolist()]
    return [packed[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


class Aligner:
    """Groups and links of a block of texts.

    A text is cut at single blanks, over which neither tokenizer's tokens reach, so that no group does either. Each
    distinct word of a block is encoded and aligned once; texts are put together from their words.
    """

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevelSide(first), PieceSide(second)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        # Each id as text, followed by what comes after it: another of its side, the other side, another group.
        self.texts = [f"{i}{after}" for after in ",|;" for i in range(len(self.a.tokens))]
        self.texts += [f"{i}{after}" for after in ",;" for i in range(len(self.b.tokens))]

    def _learn(self, words: list[str]) -> None:
        """Encode words not met before. One that does not come back whole has no ids."""
        plain = [w for w in words if _PLAIN.search(w)]
        plain_words = set(plain)
        for some in _portions(plain):
            # Many words at a time as one text, which is cut at the bytes where words end.
            sizes = np.array([len(w.encode()) + 1 for w in some], np.int64)
            whole = b"".join([b" " + w.encode() for w in some])
            cut = [_cut(side, " ".join(some), whole, np.cumsum(sizes)) for side in (self.a, self.b)]
            if None in cut:
                plain_words.difference_update(some)
            else:
                self.known.update(zip(some, zip(*cut, strict=True), strict=True))
        for some in _portions([w for w in words if w not in plain_words]):
            for w, a, b in zip(some, self.a.encode(some), self.b.encode(some), strict=True):
                whole = b" " + w.encode()
                if self.a.bytes_of(a) != whole or self.b.bytes_of(b) != whole:
                    a = b = []
                self.known[w] = (array("i", a).tobytes(), array("i", b).tobytes())

    def _encoded(self, words: list[str]) -> tuple[list[bytes], list[bytes]]:
        if len(self.known) > _KNOWN_WORDS:
            for old in list(islice(self.known, _KNOWN_WORDS // 2)):
                del self.known[old]
        self._learn([w for w in words if w not in self.known])
        both = [self.known[w] for w in words]
        return [a for a, _ in both], [b for _, b in both]

    def _texts(self, a_group, a_ids, b_group, b_ids, word) -> list[str]:
        """The groups of each word written out; `word` is that of each group."""
        n = len(word)
        if not n:
            return []
        a_last = np.r_[a_group[1:] != a_group[:-1], True]
        b_last = np.r_[b_group[1:] != b_group[:-1], True]
        a_count, b_count = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
        a_through, b_through = np.cumsum(a_count), np.cumsum(b_count)
        size = len(self.a.tokens)
        out = np.empty(len(a_ids) + len(b_ids), np.int64)
        out[np.arange(len(a_ids)) + (b_through - b_count)[a_group]] = a_ids + size * a_last
        out[np.arange(len(b_ids)) + a_through[b_group]] = 3 * size + b_ids + len(self.b.tokens) * b_last
        ends = (a_through + b_through)[np.flatnonzero(np.r_[word[1:] != word[:-1], True])]
        signs = list(map(self.texts.__getitem__, out.tolist()))
        return ["".join(signs[i:j])[:-1] for i, j in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]

    def align(self, texts: list[str | None]) -> tuple[dict, dict]:
        """Per text its counts, groups and linked pairs (places in the pairs of the block, and times); the pairs."""
        index: dict[str, int] = {}
        parts = [[index.setdefault(w, len(index)) for w in _CUT.split(t)] if t else [] for t in texts]
        raw_a, raw_b = self._encoded(list(index))
        n_a = np.array([len(x) // 4 for x in raw_a], np.int64)
        n_b = np.array([len(x) // 4 for x in raw_b], np.int64)
        # A text with a word that does not come back has no tokens.
        lost = set(np.flatnonzero(n_a == 0).tolist())
        if lost:
            parts = [[] if not lost.isdisjoint(p) else p for p in parts]
        sizes = np.array([len(p) for p in parts], np.int64)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        words = np.fromiter((w for p in parts for w in p), np.int64, int(sizes.sum()))

        def total(of_word: np.ndarray) -> np.ndarray:
            out = np.zeros(len(texts), np.int64)
            np.add.at(out, text_of, of_word[words])
            return out

        a_ids, b_ids = np.frombuffer(b"".join(raw_a), np.int32), np.frombuffer(b"".join(raw_b), np.int32)
        a_group, b_group = groups(np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids]))
        # Words end where both sides end, so that no group reaches over two of them.
        groups_of = np.zeros(len(index), np.int64)
        some = n_a > 0
        if len(a_ids):
            groups_of[some] = np.diff(np.r_[-1, a_group[np.cumsum(n_a[some]) - 1]])
        word_of = np.repeat(np.arange(len(index)), groups_of)
        written = dict(zip(np.flatnonzero(some).tolist(), self._texts(a_group, a_ids, b_group, b_ids, word_of), strict=True))
        links = list(_linked(word_of, a_group, a_ids, b_group, b_ids)) or [(np.zeros(0, np.int64),) * 3]
        of_word, pairs, times = (np.concatenate(x) for x in zip(*links, strict=True))
        links_of = np.zeros(len(index), np.int64)
        np.add.at(links_of, of_word, times)
        known, which = np.unique(pairs, return_inverse=True)

        text, pair, times = _of_texts(text_of, words, of_word, which, times, len(known))
        held = np.bincount(pair, minlength=len(known))
        # The pairs of most texts come first, so that places are small numbers; those of no text stay out.
        order = np.argsort(-held, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        order = order[: int((held > 0).sum())]
        rows = {
            "n_a": total(n_a),
            "n_b": total(n_b),
            "n_groups": total(groups_of),
            "n_links": total(links_of),
            "groups": [";".join(map(written.__getitem__, p)) for p in parts],
            "sizes": np.bincount(text, minlength=len(texts)),
            "pair": rank[pair],
            "times": times,
        }
        known, held = known[order], held[order]
        return rows, {"a": known >> 32, "b": known & 0xFFFFFFFF, "docs": held}


def _of_texts(text_of, words, of_word, pair, times, pairs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times) of the texts' words, each pair of a text once, some texts at a time."""
    count = np.bincount(of_word, minlength=int(words.max(initial=-1)) + 1)
    first = np.cumsum(count) - count
    through = np.cumsum(count[words])
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
    begin = 0
    while begin < len(words):
        base = through[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(through, base + _PAIRS, "right")))
        stop = int(np.searchsorted(text_of, text_of[stop - 1], "right"))  # whole texts
        own = count[words[begin:stop]]
        at = np.repeat(first[words[begin:stop]] - np.cumsum(own) + own, own) + np.arange(own.sum())
        key = np.repeat(text_of[begin:stop], own) * max(pairs, 1) + pair[at]
        order = np.argsort(key, kind="stable")
        key, some = key[order], times[at][order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        out.append((key[starts] // max(pairs, 1), key[starts] % max(pairs, 1), np.add.reduceat(some, starts)))
        begin = stop
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _aligner(first: str, second: str) -> Aligner:
    kept = worker_cache("alignment")
    if (first, second) not in kept:
        kept[first, second] = Aligner(first, second)
    return kept[first, second]


_DOC = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pair array<int>, times array<int>"
_BLOCK = "block string, pairs struct<a:array<int>, b:array<int>, docs:array<int>>"


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32), pa.int32())


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(_ints(np.r_[0, np.cumsum(sizes)]), _ints(values))


def _blocks(first: str, second: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of documents and, per block of them, one row with its pairs."""

    def emit(ids: list[pa.Array], texts: list[str | None], name: str) -> Iterator[pa.RecordBatch]:
        rows, pairs = _aligner(first, second).align(texts)
        n = len(texts)
        whole = pa.concat_arrays(ids)
        counts = [pa.array(rows[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        lists = [_lists(rows["pair"], rows["sizes"]), _lists(rows["times"], rows["sizes"])]
        fields = [pa.field(c, pa.list_(pa.int32())) for c in pairs]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times", "block", "pairs"]
        out = [whole, *counts, pa.array(rows["groups"], pa.string()), *lists]
        out += [pa.array([name] * n, pa.string()), pa.nulls(n, pa.struct(fields))]
        made = pa.RecordBatch.from_arrays(out, names=names)
        for at in range(0, n, 500):
            yield made.slice(at, 500)
        if len(pairs["a"]):
            size = np.array([len(pairs["a"])])
            struct = pa.StructArray.from_arrays([_lists(x, size) for x in pairs.values()], fields=fields)
            none = [pa.nulls(1, column.type) for column in out[:8]]
            yield pa.RecordBatch.from_arrays([*none, pa.array([name]), struct], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        texts: list[str | None] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids.append(part.column(0))
                some = part.column(1).to_pylist()
                texts += some
                held += sum(len(t) for t in some if t)
                if held >= BLOCK:
                    yield from emit(ids, texts, f"{task}-{number}")
                    ids, texts, held, number = [], [], 0, number + 1
        if texts:
            yield from emit(ids, texts, f"{task}-{number}")

    return run


def aligned(
    docs: DataFrame,
    first: str,
    second: str,
    kept: Callable[[Column], Column] = lambda groups: groups,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of each text's tokens by a byte-level tokenizer (A) and a sentencepiece model (B).

    The first result has a row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, which
    holds what `kept` makes of the text `a1,a2|b1;a3|b2,b3` (ids in order; groups cut where tokens of both sides
    end). The second has a row per linked id pair: a, b, documents (that hold it linked), best (no other b of this
    a is held by more). `first` and `second` are files that every executor can read.

    Texts that are missing or empty, or whose tokens do not join to the text with a space before it, have no tokens:
    zeros and an empty `groups`. Repeated rows are documents of their own; doc_id may be missing or repeat. Other columns
    of `docs` are left out, so that none clashes.

    Documents are taken in blocks of some megabytes. A block's token ends are merged in equal pieces (see
    `groups`), so that a very long text is many pieces and small texts share one. A block counts each pair once per
    document before anything is shuffled; a pair comes from a block as one row, whatever number of links it has there, and the
    counts come back to a block as one row per pair. A very frequent pair thus has at most a row per block, which adaptive
    execution splits where they are many. The list of best counts has a row per id of A, which bounds its broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = _blocks(first, second)
    both = rows.mapInArrow(lambda batches: released(run(batches)), f"doc_id bigint, {_DOC}, {_BLOCK}")
    both = both.withColumn("groups", kept(F.col("groups")))
    both = materialise(both, "alignment-blocks", 1000)

    # A block goes by two names, so that the two readings of the table can meet.
    parts = both.filter("pairs IS NOT NULL").select(
        F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("pairs.a", "pairs.b", "pairs.docs"))
    )
    parts = parts.select("of_block", F.col("pos").alias("place"), "col.a", "col.b", "col.docs")
    counts = materialise(parts.groupBy("a", "b").agg(F.sum("docs").alias("documents")), "alignment-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    best = (F.col("documents") == F.col("most")).alias("best")
    pairs = counts.join(F.broadcast(most), "a").select("a", "b", "documents", best)
    told = parts.join(pairs, ["a", "b"]).select("of_block", "place", "documents", "best")

    counted, result = ["doc_id", "n_a", "n_b", "n_groups", "n_links"], ["n_best", "count_sum", "groups"]
    members = both.filter("pairs IS NULL").select(*counted, "groups", "pair", "times", "block")
    none = members.filter("n_a = 0").withColumns({c: F.lit(0).cast("long") for c in result[:2]})
    kinds = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in [*counted, "groups"])
    linked = members.filter("n_a > 0").groupBy("block").cogroup(told.groupBy("of_block"))
    linked = linked.applyInArrow(_told, f"{kinds}, n_best bigint, count_sum bigint")
    return linked.select(*counted, *result).unionByName(none.select(*counted, *result)), pairs


def _told(members: pa.Table, counts: pa.Table) -> pa.Table:
    """The counts of a block's pairs, added up over the links of each of its documents."""
    place = counts.column("place").to_numpy()
    documents, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    documents[place] = counts.column("documents").to_numpy()
    best[place] = counts.column("best").to_numpy(zero_copy_only=False)
    pair = members.column("pair").combine_chunks()
    times = members.column("times").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = pair.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(pair).to_numpy(zero_copy_only=False))
    out = members.drop_columns(["pair", "times", "block"])
    for name, values in (("n_best", best), ("count_sum", documents)):
        through = np.r_[0, np.cumsum(values[at] * times)]
        out = out.append_column(name, pa.array(np.diff(np.r_[0, through[ends]]), pa.int64()))
    return out
