"""Document likelihood from a lattice of subwords (operator 2).

A word may be read as any sequence of pieces of an existing vocabulary; its probability is the sum over
all of them, by a forward recursion in logarithms. The pieces' weights start from the vocabulary's own scores and are
fitted to the corpus by expectation maximisation. A word that the corpus has is one more arc, over the
whole word, weighted by its relative frequency in the corpus and in a class of documents; how much these arcs
count against the pieces is fitted too, with each word left out of its own counts. Classes are the languages of the
training documents. A text's own language is not used: its probability is the sum over all classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.llm.common import id_fold, materialise, released
from cellflux.llm.words import PART, hashed
from cellflux.session import scoped_conf

ROUNDS = 3
CLASSES = 8  # most frequent languages that are a class each; the others are one more
HELD_OUT = 1  # of five folds
BLOCK_BYTES = 8 << 20  # text in one block of documents
WORDS_AT_ONCE = 60_000  # that a Python worker gets; words of one length are read together
_LONGEST = 16  # characters of a piece; longer ones, of which the given vocabulary has none, are left out
_PRIOR = 0.1  # added to the expected count of each piece
_SPACE = "▁"


# --- the lattice --------------------------------------------------------------


class Lattice:
    """The pieces of a vocabulary as a trie, for many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        nodes, edges = [-1], {}
        for number, piece in enumerate(pieces):
            node = 0
            for char in piece:
                node = edges.setdefault((node, ord(char)), len(nodes))
                if node == len(nodes):
                    nodes.append(-1)
            nodes[node] = number
        self.node_piece = np.array(nodes)
        keys = np.array([(a << 21) | c for a, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array(list(edges.values()))[order]
        self.bytes = len(pieces)  # 256 more weights follow, for the bytes of characters in no piece

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = (node << 21) | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)

    def arcs(self, chars: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of all pieces in words of one length, by start."""
        count, width = chars.shape
        out = []
        for start in range(width):
            rows, node = np.arange(count), np.zeros(count, np.int64)
            for end in range(start + 1, min(width, start + _LONGEST) + 1):
                node = self._step(node, chars[rows, end - 1])
                rows, node = rows[node >= 0], node[node >= 0]
                if not len(rows):
                    break
                piece = self.node_piece[node]
                is_piece = piece >= 0
                if end == start + 1:
                    single = np.full(count, -1)
                    single[rows] = piece
                    out.append((start, end, np.arange(count), single))
                elif is_piece.any():
                    out.append((start, end, rows[is_piece], piece[is_piece]))
            if not out or out[-1][0] != start:
                out.append((start, start + 1, np.arange(count), np.full(count, -1)))
        return out

    def weights_of(self, chars: np.ndarray, arc, weights: np.ndarray) -> np.ndarray:
        """Log weights of an arc; a character in no piece is read byte by byte."""
        start, end, rows, piece = arc
        out = weights[piece]
        for i in np.flatnonzero(piece < 0).tolist():
            out[i] = sum(weights[self.bytes + b] for b in chr(chars[rows[i], start]).encode("utf-8", "replace"))
        return out

    def forward(self, chars: np.ndarray, arcs, weights: np.ndarray) -> np.ndarray:
        """Log probability of each prefix of each word."""
        out = np.full((len(chars), chars.shape[1] + 1), -np.inf)
        out[:, 0] = 0.0
        for arc in arcs:
            start, end, rows, _ = arc
            out[rows, end] = np.logaddexp(out[rows, end], out[rows, start] + self.weights_of(chars, arc, weights))
        return out

    def expected(self, chars: np.ndarray, arcs, weights: np.ndarray, times: np.ndarray, total: np.ndarray) -> None:
        """Add to `total` how often each piece is used, in `times` readings of each word."""
        ahead = self.forward(chars, arcs, weights)
        width = chars.shape[1]
        after = np.full(ahead.shape, -np.inf)
        after[:, width] = 0.0
        for arc in reversed(arcs):
            start, end, rows, piece = arc
            own = self.weights_of(chars, arc, weights)
            share = np.exp(ahead[rows, start] + own + after[rows, end] - ahead[rows, width]) * times[rows]
            known = piece >= 0
            total += np.bincount(piece[known], share[known], len(total))
            for i in np.flatnonzero(~known).tolist():
                for b in chr(chars[rows[i], start]).encode("utf-8", "replace"):
                    total[self.bytes + b] += share[i]
            after[rows, start] = np.logaddexp(after[rows, start], own + after[rows, end])


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their places, and their characters behind a space sign."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for places in np.split(order, cuts):
        for at in range(0, len(places), 20_000):
            some = places[at : at + 20_000]
            text = "".join(_SPACE + words[i] for i in some.tolist())
            chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            yield some, chars.reshape(len(some), -1)


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces of a vocabulary that lower-cased words can use, and log weights from its scores.

    Its scores are ranks, so that the weights start as those of Zipf's law.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        special = model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        inside = piece[1:] if piece.startswith(_SPACE) else piece
        lower = not any("A" <= c <= "Z" for c in piece)
        if not special and lower and _SPACE not in inside and len(piece) <= _LONGEST and " " not in piece:
            pieces.append(piece)
            ranks.append(max(0.0, -model.get_score(i)))
    weight = np.r_[1.0 / (1.0 + np.array(ranks)), np.full(256, 1.0 / (2.0 + max(ranks, default=0.0)))]
    return pieces, np.log(weight / weight.sum())


# --- blocks of documents, and their words ----------------------------------------


def _hashed(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word, some of the text at a time, cut between words."""
    found, at = [], 0
    while at < len(buffer):
        stop = buffer.find(b" ", at + PART) if len(buffer) - at > PART else -1
        part = buffer[at : stop if stop >= 0 else len(buffer)]
        value, starts, stops = hashed(part)
        found.append((value, starts + at, stops + at))
        at += len(part) + (stop >= 0)
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(empty, *found, strict=True))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpacked(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw, max_output_size=2**31), kind)


# A word's place in the texts is one number: task, block of the task, place in the block.
_BLOCK_BITS, _PLACE_BITS = 15, 26
_BLOCKS = "block bigint, words binary, train binary, ids binary, held binary, which binary, lengths binary"


def _blocks(block_bytes: int, classes: int):
    """Per block of documents one row: its distinct words with their training counts, and its texts as places among them."""
    names = [c.split()[0] for c in _BLOCKS.split(", ")]

    def row_of(block: int, part: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, _, t, _ in part]
        buffer = b" ".join(texts).lower()
        value, starts, stops = _hashed(buffer)
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.r_[0, np.searchsorted(starts, ends)]
        lengths = np.diff(cuts)
        distinct, first, which = np.unique(value, return_index=True, return_inverse=True)
        train = np.repeat(np.array([not held for _, held, _, _ in part], bool), lengths)
        kind = np.repeat(np.array([k for *_, k in part], np.int64), lengths)
        cells = which[train] * classes + kind[train]
        counts = np.bincount(cells, minlength=len(distinct) * classes).reshape(-1, classes)
        words = [buffer[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        ids = np.array([d if d is not None else -(2**63) for d, *_ in part], np.int64)
        held = np.array([h for _, h, _, _ in part], bool)
        row = [zstandard.compress(b"\n".join(words), 1), _packed(counts), _packed(ids), _packed(held)]
        row += [_packed(which.astype(np.uint32)), _packed(lengths)]
        columns = [pa.array([block], pa.int64()), *[pa.array([x], pa.binary()) for x in row]]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << _BLOCK_BITS
        part: list[tuple] = []
        held_bytes = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            own = [batch.column(c).to_pylist() for c in ("doc_id", "held_out", "kind")]
            for row in zip(own[0], own[1], texts, own[2], strict=True):
                if part and held_bytes + len(row[2]) > block_bytes:
                    yield row_of(block, part)
                    part, held_bytes, block = [], 0, block + 1
                part.append(row)
                held_bytes += len(row[2]) + 1
        if part:
            yield row_of(block, part)

    return run


def _opened(raw: bytes) -> list[bytes]:
    text = zstandard.decompress(raw, max_output_size=2**31)
    return text.split(b"\n") if text else []


def _count_names(classes: int) -> list[str]:
    return [f"c{k}" for k in range(classes)]


def _entries(classes: int | None):
    """The words of the blocks as rows: word and counts; without `classes` word and where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = _opened(batch.column("words")[i].as_py())
                if classes:
                    counts = _unpacked(batch.column("train")[i].as_py(), np.int64).reshape(-1, classes)
                    # Words of held-out texts only have no part in any count.
                    columns = [pa.array(np.ascontiguousarray(counts[:, k])) for k in range(classes)]
                    names = _count_names(classes)
                else:
                    first = batch.column("block")[i].as_py() << _PLACE_BITS
                    columns, names = [pa.array(np.arange(first, first + len(words), dtype=np.int64))], ["at"]
                word = pa.array(words, pa.binary()).cast(pa.string())
                out = pa.RecordBatch.from_arrays([word, *columns], names=["word", *names])
                for at in range(0, len(words), 20_000):
                    yield out.slice(at, 20_000)

    return lambda batches: released(run(batches))


def _shares(counts: np.ndarray, tokens: np.ndarray, less: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Relative frequencies of words in each class and in all, with `less` taken from every count.

    `tokens` are words without ends, so that the shares of all words add up to 1.
    """
    own = np.maximum(counts - less, 0) / np.maximum(tokens - less, 1)
    whole = np.maximum(counts.sum(axis=1) - less, 0) / max(1, tokens.sum() - less)
    return own, whole[:, None]


def _word_batches(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    for batch in batches:
        counts = [batch.column(c).to_numpy(zero_copy_only=False) for c in _count_names(classes)]
        yield batch, batch.column("word").to_pylist(), np.stack(counts, axis=1)


def _expectation(lattice, weights, mix: tuple[float, ...], tokens: np.ndarray):
    """Expected uses of each piece, and at -3, -2 and -1 how many tokens each kind of arc accounts for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, logs = lattice.value, weights.value
        total, by_kind = np.zeros(len(logs)), np.zeros(3)
        for _, words, counts in _word_batches(batches, len(tokens)):
            for places, chars in by_length(words):
                arcs = trie.arcs(chars)
                pieces = np.exp(trie.forward(chars, arcs, logs)[:, -1])[:, None]
                c = counts[places]
                own, whole = _shares(c, tokens, 1)
                parts = [mix[0] * own, mix[1] * whole, mix[2] * pieces]
                scale = c / np.maximum(parts[0] + parts[1] + parts[2], 1e-300)
                by_kind += [float((p * scale).sum()) for p in parts]
                trie.expected(chars, arcs, logs, (parts[2] * scale).sum(axis=1), total)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[used, -3, -2, -1]), pa.array(np.r_[total[used], by_kind])], names=["piece", "uses"]
        )

    return lambda batches: released(run(batches))


def word_logs(
    by_pieces: np.ndarray, count: np.ndarray, whole: np.ndarray, mix: tuple[float, ...], tokens: int, end: float
) -> np.ndarray:
    """Natural log probability of each word, before which no end came, in one class.

    What is not an end is a word: by its share of the class's words (`count` of `tokens`), by that of all words (`whole`), or
    by the pieces. Each of the three adds up to 1 over all words (the pieces', since a word goes on until the next
    piece begins with a space), or to less, so that words and end together do.
    """
    with np.errstate(divide="ignore"):
        by_words = np.log(mix[0] * (count / max(tokens, 1)) + mix[1] * whole)
        return np.logaddexp(by_words, by_pieces + math.log(mix[2])) + np.log1p(-end)


# A word's answer: its log probability by pieces, then its counts in the classes where it has any.
_COUNT = np.dtype([("kind", "u1"), ("low", "<u4"), ("high", "<u2")])
_HEAD = 4


def _packed_answers(score: np.ndarray, counts: np.ndarray) -> pa.Array:
    rows, kinds = np.nonzero(counts)
    held = np.empty(len(rows), _COUNT)
    held["kind"], held["low"], held["high"] = kinds, counts[rows, kinds] & 0xFFFFFFFF, counts[rows, kinds] >> 32
    number = np.bincount(rows, minlength=len(score))
    offsets = np.r_[0, np.cumsum(_HEAD + number * _COUNT.itemsize)]
    out = np.zeros(int(offsets[-1]), np.uint8)
    out[offsets[:-1, None] + np.arange(_HEAD)] = score.astype("<f4").view(np.uint8).reshape(-1, _HEAD)
    rank = np.arange(len(rows)) - (np.cumsum(number) - number)[rows]
    at = offsets[rows] + _HEAD + rank * _COUNT.itemsize
    out[at[:, None] + np.arange(_COUNT.itemsize)] = held.view(np.uint8).reshape(-1, _COUNT.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(score), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])


def _unpacked_answers(packed: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores; row, class and count of all counts that are not 0."""
    raw = np.frombuffer(b"".join(packed.to_pylist()), np.uint8)
    sizes = pc.binary_length(packed).to_numpy().astype(np.int64)
    offsets = np.cumsum(sizes) - sizes
    head = offsets[:, None] + np.arange(_HEAD)
    score = np.ascontiguousarray(raw[head]).view("<f4").ravel().astype(np.float64)
    rest = np.ones(len(raw), bool)
    rest[head] = False
    held = raw[rest].view(_COUNT)
    row = np.repeat(np.arange(len(sizes)), (sizes - _HEAD) // _COUNT.itemsize)
    return score, row, held["kind"], held["low"].astype(np.int64) | held["high"].astype(np.int64) << 32


def _scored_words(lattice, weights, classes: int):
    """Words with their log probability by pieces and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, logs = lattice.value, weights.value
        for batch, words, counts in _word_batches(batches, classes):
            score = np.empty(len(words))
            for places, chars in by_length(words):
                score[places] = trie.forward(chars, trie.arcs(chars), logs)[:, -1]
            columns = [batch.column("word"), _packed_answers(score, counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "answer"])

    return lambda batches: released(run(batches))


_SCORES = "doc_id bigint, held_out boolean, n_words bigint, n_known bigint, count_logs double, score double"


def _document_scores(mix: tuple[float, ...], tokens: np.ndarray, priors: np.ndarray, ends: np.ndarray):
    """Per document of a block its tokens and sums."""
    classes = len(priors)
    with np.errstate(divide="ignore"):
        end_logs = np.log(priors) + np.log(ends)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        names = [field.split()[0] for field in _SCORES.split(", ")]
        place = answers.column("at").to_numpy() & ((1 << _PLACE_BITS) - 1)
        pieces, number = np.zeros(len(place)), np.zeros(len(place), np.int64)
        score, row, kind, count = _unpacked_answers(answers.column("answer"))
        pieces[place] = score
        at = place[row]
        np.add.at(number, at, count)
        whole = number / max(1, int(tokens.sum()))

        def logs(k: int) -> np.ndarray:
            own = np.zeros(len(place), np.int64)
            own[at[kind == k]] = count[kind == k]
            return word_logs(pieces, own, whole, mix, int(tokens[k]), ends[k])

        out = []
        for part in blocks.select(["ids", "held", "which", "lengths"]).to_pylist():
            which, lengths = _unpacked(part["which"], np.uint32), _unpacked(part["lengths"], np.int64)
            text = np.repeat(np.arange(len(lengths)), lengths)

            def sums(values, text=text, which=which, lengths=lengths):
                return np.bincount(text, weights=values[which], minlength=len(lengths)).astype(float)

            # One class at a time, since a block may have very many words.
            by_class = np.stack([sums(logs(k)) + end_logs[k] for k in range(classes)])
            best = by_class.max(axis=0)
            score = (best + np.log(np.exp(by_class - best).sum(axis=0))) / math.log(10)
            raw = _unpacked(part["ids"], np.int64)
            known = sums((number > 0).astype(np.float64)).round().astype(np.int64)
            columns = [pa.array(raw, mask=raw == -(2**63)), _unpacked(part["held"], bool), lengths, known]
            columns += [sums(np.log10(number + 0.5)), score]
            out.append(pa.table(dict(zip(names, [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], strict=True))))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.concat_tables(out) if out else pa.schema(zip(names, kinds, strict=True)).empty_table()

    return run


def likelihoods(
    documents: DataFrame, pieces: list[str], start: np.ndarray, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Scores of all texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `documents`: doc_id, text, lang; other columns are ignored. A missing text is an empty one, whose only token is its
    end; a missing language is a class like any. Words are learned from documents outside the held-out fold, all of them; without such documents the
    whole-word arcs have no weight and the pieces keep the vocabulary's. Rows with equal doc_id are scored each.

    Documents travel as blocks of some megabytes in which a word stands once, so that the most frequent word of the
    corpus is one row per block, added up in each task before it is shuffled. A word's probabilities go back to the blocks
    that hold it as one row each, in single precision; adaptive execution splits those of a very frequent word.
    What the driver gets is a number per piece.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (id_fold("doc_id") == HELD_OUT).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
    )
    per_class = rows.groupBy("lang").agg(F.count_if(~F.col("held_out")).alias("train"))
    per_class = materialise(per_class, "lm-classes")
    all_ends = per_class.agg(F.coalesce(F.sum("train"), F.lit(0))).first()[0]
    named = per_class.filter("train > 0").orderBy(F.desc("train"), "lang").limit(CLASSES).collect()
    classes = len(named) + 1
    ends = np.array([r.train for r in named] + [all_ends - sum(r.train for r in named)], np.int64)
    kind = F.lit(classes - 1)
    for i, r in enumerate(named):
        kind = F.when(F.col("lang") == r.lang, i).otherwise(kind)
    rows = rows.withColumn("kind", kind).drop("lang")

    made = rows.mapInArrow(lambda batches: released(_blocks(block_bytes, classes)(batches)), _BLOCKS)
    blocks = materialise(made, "lm-blocks")
    names = _count_names(classes)
    counted = blocks.select("words", "train").mapInArrow(
        _entries(classes), "word string, " + ", ".join(f"{c} bigint" for c in names)
    )
    words = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    words = materialise(words, "lm-words")
    seen = sum((F.col(c) for c in names[1:]), F.col(names[0])) > 0
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count_if(seen).alias("kinds")).first()
    tokens = np.array([sums[c] for c in names], np.int64)  # words, without the ends
    train_tokens, kinds = int(tokens.sum()) + all_ends, sums["kinds"] + (all_ends > 0)

    lattice = spark.sparkContext.broadcast(Lattice(pieces))
    logs = np.asarray(start, np.float64)
    learned = int(tokens.sum()) > 0
    many = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(WORDS_AT_ONCE)}
    mix = (0.5, 0.2, 0.3) if learned else (0.0, 0.0, 1.0)
    for _ in range(rounds if learned else 0):
        sent = spark.sparkContext.broadcast(logs)
        found = words.filter(seen).mapInArrow(_expectation(lattice, sent, mix, tokens), "piece bigint, uses double")
        with scoped_conf(spark, many):
            uses = {r.piece: r.uses for r in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()}
        by_kind = np.maximum([uses.pop(k, 0.0) for k in (-3, -2, -1)], 1e-6)
        mix = tuple((by_kind / by_kind.sum()).tolist())
        total = np.full(len(logs), _PRIOR)
        total[list(uses)] += list(uses.values())
        logs = np.log(total / total.sum())
    sent = spark.sparkContext.broadcast(logs)
    # Without training documents every class is alike, and an end as likely as not.
    priors = ends / all_ends if all_ends else np.full(classes, 1 / classes)
    at_end = ends / np.maximum(tokens + ends, 1) if all_ends else np.full(classes, 0.5)
    with scoped_conf(spark, many):
        found = words.mapInArrow(_scored_words(lattice, sent, classes), "word string, answer binary")
        answers = materialise(found, "lm-scores")
    held = blocks.select("block", "words").mapInArrow(_entries(None), "word string, at bigint")
    told = held.join(answers, "word").select(F.shiftright("at", _PLACE_BITS).alias("of_block"), "at", "answer")
    texts = blocks.select("block", "ids", "held", "which", "lengths")
    scored = (
        texts.groupBy("block")
        .cogroup(told.groupBy("of_block"))
        .applyInArrow(_document_scores(mix, tokens, priors, at_end), _SCORES)
    )
    below = math.log10(train_tokens + 0.5 * (kinds + 1))
    return scored.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + F.lit(1 if all_ends else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("count_logs") + F.lit(math.log10(all_ends + 0.5)) - (F.col("n_words") + 1) * F.lit(below)).alias("base_score"),
        "score",
    )
