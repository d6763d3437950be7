"""Mixture-controlled packing into fixed sequences (operator 4)."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellflux.llm.common import materialise, released, worker_cache
from cellflux.llm.words import NOT_BLANK, PART, hashed

SEQUENCE = 2048
END = 1  # the id after each document
WINDOW_SEQUENCES = 32  # sequences in which the sources meet their shares
ROWS_PER_BUCKET = 2_000
MAX_BUCKETS = 10_000
_KNOWN_WORDS = 250_000
_SEPARATOR = "<|endoftext|>"
_GROUP = PART  # bytes of text whose words are looked up together
_WHOLE = 1 << 23  # bytes; a longer text is not worth a table of its words


def _byte_kinds() -> np.ndarray:
    """Blanks 0, letters and bytes beyond ASCII 1, digits 2, marks and control bytes 3."""
    kinds = np.full(256, 3, np.uint8)
    kinds[NOT_BLANK == 0] = 0
    for first, last in (("A", "Z"), ("a", "z")):
        kinds[ord(first) : ord(last) + 1] = 1
    kinds[128:] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    return kinds


_KINDS = _byte_kinds()


def _is_plain(text: bytes) -> bool:
    """ASCII without apostrophes, and small or capital Latin-1 letters: the two-byte points of 0xC3."""
    if b"'" in text or b"|>" in text:
        return False
    if text.isascii():
        return True
    points = np.frombuffer(text, np.uint8)
    lead = np.flatnonzero(points >= 0xC0)
    after = points[lead + 1]
    return bool((points[lead] == 0xC3).all() and not np.isin(after, (0x97, 0xB7)).any())


class _Known:
    """Ids of words by the words' hashes: sorted hashes, and where the ids of each begin in one array.

    Beyond `_KNOWN_WORDS` the half goes that was met longest ago, so that usual words are not learned again.
    """

    def __init__(self, kind: np.dtype):
        self.hashes, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, kind)
        self.turn = 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is known."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        self.turn += 1
        self.used[at[known]] = self.turn
        return at, known

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if len(self.hashes) and len(self.hashes) + len(hashes) > _KNOWN_WORDS:
            self._forget()
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.hashes = merged[order]
        self.used = np.concatenate([self.used, np.full(len(hashes), self.turn)])[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.ids = np.concatenate([self.ids, ids])

    def _forget(self) -> None:
        """Words of the current turn stay in any case."""
        keep = self.used > min(np.partition(self.used, len(self.used) // 2)[len(self.used) // 2], self.turn - 1)
        self.hashes, self.used, sizes = self.hashes[keep], self.used[keep], self.sizes[keep]
        self.ids = self.ids[_spans(self.begins[keep], sizes)]
        self.begins, self.sizes = np.cumsum(sizes) - sizes, sizes


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    through = np.cumsum(sizes)
    return np.repeat(begins - through + sizes, sizes) + np.arange(through[-1] if len(sizes) else 0)


class WordEncoder:
    """Ids of a text, word by word, with the ids of words seen before kept.

    The tokenizer lower-cases, cuts at blanks, and then between letters, digits and marks, so that in a
    plain text each run of one kind has its ids whatever stands around it. (Apostrophes join in some runs, and other
    scripts have letters and marks that bytes do not tell apart.) Any other text is cut at
    blanks only. Words not met before go to the tokenizer, many at a time: letters are told apart by
    the word-end tokens, other words by a special token put between.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype(np.uint16 if max(vocabulary.values()) < 2**16 else np.uint32)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.separator = vocabulary[_SEPARATOR]
        self.known = {True: _Known(self.kind), False: _Known(self.kind)}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learned(self, words: list[bytes], text: str, is_end, keep: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and numbers of ids of words that go to the tokenizer in one text; `keep`: the ending id stays."""
        all_ids, all_sizes = [], []
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = self._ids(text.join(w.decode() for w in some))
            last = is_end(ids)
            stops = np.flatnonzero(last)
            if keep:
                sizes = np.diff(np.r_[-1, stops])
                ended = len(ids) == (stops[-1] + 1 if len(stops) else 0)
            else:
                sizes = np.diff(np.r_[-1, stops, len(ids)]) - 1
                ids, ended = ids[~last], True
            if len(sizes) != len(some) or not ended:
                raise ValueError("the tokenizer's word ends do not follow its words")
            all_ids.append(ids)
            all_sizes.append(sizes)
        return all_ids, all_sizes

    def _learn(self, words: list[bytes], hashes: np.ndarray, *, plain: bool) -> None:
        first = np.array([w[0] for w in words], np.uint8)
        letters = (_KINDS[first] == 1) if plain else np.zeros(len(words), bool)
        order = np.r_[np.flatnonzero(letters), np.flatnonzero(~letters)]
        of_letters = [words[i] for i in order[: letters.sum()].tolist()]
        others = [words[i] for i in order[letters.sum() :].tolist()]
        ids, sizes = self._learned(of_letters, " ", lambda ids: self.ends[ids], 1)
        more_ids, more_sizes = self._learned(others, f" {_SEPARATOR} ", lambda ids: ids == self.separator, 0)
        self.known[plain].add(
            hashes[order], np.concatenate(ids + more_ids), np.concatenate(sizes + more_sizes).astype(np.int64)
        )

    def _encode_group(self, texts: list[bytes], *, plain: bool) -> list[bytes]:
        """Ids of the distinct words of all texts, dealt out to where the words stand."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        buffer = b" ".join(texts).lower()
        value, starts, stops = hashed(buffer, _KINDS if plain else NOT_BLANK)
        distinct, first, which = np.unique(value, return_index=True, return_inverse=True)
        known = self.known[plain]
        at, found = known.find(distinct)
        if not found.all():
            new = ~found
            spans = zip(starts[first[new]].tolist(), stops[first[new]].tolist(), strict=True)
            self._learn([buffer[a:b] for a, b in spans], distinct[new], plain=plain)
            at, _ = known.find(distinct)
        at = at[which]
        lengths = known.sizes[at]
        flat = known.ids[_spans(known.begins[at], lengths)]
        cuts = np.r_[0, np.cumsum(lengths)][np.searchsorted(starts, ends[:-1])]
        return [part.tobytes() for part in np.split(flat, cuts)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text (UTF-8) as little-endian integers of `kind`.

        A text that may name a special token, which the tokenizer finds before all else, goes to it whole, as
        does one too long to be worth a table of its words.
        """
        out: list[bytes] = [b""] * len(texts)
        groups: dict[bool, list[int]] = {True: [], False: []}
        for i, text in enumerate(texts):
            if b"|>" in text or len(text) > _WHOLE:
                out[i] = self._ids(text.decode()).tobytes()
            else:
                groups[_is_plain(text)].append(i)
        for plain, members in groups.items():
            at = 0
            while at < len(members):
                held, stop = 0, at
                while stop < len(members) and (stop == at or held + len(texts[members[stop]]) <= _GROUP):
                    held += len(texts[members[stop]])
                    stop += 1
                part = members[at:stop]
                ids = self._encode_group([texts[i] for i in part], plain=plain)
                for i, own in zip(part, ids, strict=True):
                    out[i] = own
                at = stop
        return out


def _tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = worker_cache("encoder")
        encoder = encoders.get(path) or encoders.setdefault(path, WordEncoder(path))
        end = np.array([END], encoder.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                ids = [x + end for x in encoder.encode(texts)]
                size = len(end)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_row"),
                        part.column("doc_id"),
                        part.column("source"),
                        pa.array([len(x) // size for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([size] * len(ids), pa.int32()),
                    ],
                    names=["_row", "doc_id", "source", "tokens", "ids", "id_bytes"],
                )

    return run


def tokenised(documents: DataFrame, tokenizer: str) -> DataFrame:
    """A row key, doc_id, source, number of ids (with the end) and the ids, written as a table."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "_row bigint, doc_id bigint, source string, tokens bigint, ids binary, id_bytes int"
    run = _tokens(tokenizer)
    ids = rows.mapInArrow(lambda batches: released(run(batches)), schema)
    return materialise(ids, "pack-ids", 1000)


def _running(rows: DataFrame, group: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Tokens before each row in the order of (bucket, order), per group.

    Each bucket is summed and run through by itself; only a sum per bucket meets the sums
    of the others of its group, and their number is bounded by `MAX_BUCKETS`.
    """
    sums = rows.groupBy(*group, bucket).agg(F.sum("tokens").alias("_sum"))
    before = F.sum("_sum").over(
        Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sums.select(
        *[F.col(c).alias(f"_b_{c}") for c in [*group, bucket]],
        F.coalesce(before, F.lit(0)).alias("_base"),
    )
    own = F.sum("tokens").over(
        Window.partitionBy(*group, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = None
    for c in [*group, bucket]:
        one = F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        same = one if same is None else same & one
    run = rows.withColumn("_own", own).join(bases, same)
    return run.withColumn(name, F.col("_base") + F.col("_own") - F.col("tokens")).drop(
        "_own", "_base", *[f"_b_{c}" for c in [*group, bucket]]
    )


def layout(
    lengths: DataFrame,
    targets: DataFrame | None = None,
    window_tokens: int = SEQUENCE * WINDOW_SEQUENCES,
) -> DataFrame:
    """The window and place of each document: `lengths` (_row, source, tokens) with `window`, `place`.

    Deficit round-robin, worked out for all windows at once. In each window a source is owed its
    share of the window's tokens. It sends whole documents while it is owed any; what the last
    one takes too much is a deficit that it carries into the next windows. So a document
    goes to the window in which the tokens its source has sent before it are first owed:
    `floor(sent before / (share * window))`, a rule that needs a running sum per source but no
    walk from window to window or partition to partition. Sources send in turn within a window.

    `targets` (source, share): without them, a source's share is that of its tokens, and all sources last to
    the end. With them, sources that run dry leave the rest to the others; sources without a positive share
    come after all others. Missing sources are a source. `place` is the number of tokens before
    the document in the whole stream.
    """
    lengths = lengths.select("_row", "source", "tokens")
    totals = lengths.groupBy("source").agg(
        F.sum("tokens").alias("_source_tokens"), F.count(F.lit(1)).alias("_documents")
    )
    totals = materialise(totals, "pack-sources")
    whole = totals.agg(F.sum("_source_tokens"), F.sum("_documents")).first()
    if not whole[0]:
        return lengths.withColumns({"window": F.lit(0).cast("long"), "place": F.lit(0).cast("long")})
    all_tokens, documents = whole
    if targets is None:
        shares = totals.withColumn("_share", F.col("_source_tokens") / F.lit(float(all_tokens)))
    else:
        wanted = targets.select(F.col("source").alias("_s"), F.col("share").cast("double").alias("_share"))
        shares = totals.join(wanted, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    shares = shares.select(F.col("source").alias("_s"), "_source_tokens", "_share")

    buckets = min(MAX_BUCKETS, math.ceil(documents / ROWS_PER_BUCKET))
    dealt = lengths.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    sent = _running(dealt, ["source"], "_bucket", ["_row"], "_sent").drop("_bucket")
    sent = sent.join(shares, F.col("source").eqNullSafe(F.col("_s")))
    positive = F.col("_share") > 0
    owed = F.floor(F.col("_sent") / (F.col("_share") * F.lit(float(window_tokens))))
    last = shares.agg(F.max(F.when(positive, F.col("_source_tokens") / F.col("_share")))).first()[0]
    after = F.lit(math.ceil((last or 0.0) / window_tokens)) + F.floor(F.col("_sent") / window_tokens)
    placed = sent.withColumn("window", F.when(positive, owed).otherwise(after).cast("long"))
    placed = materialise(placed.select("_row", "source", "tokens", "window", "_sent"), "pack-windows")

    windows = math.ceil(all_tokens / window_tokens)
    per_block = max(1, math.ceil(windows / max(1, min(MAX_BUCKETS, buckets))))
    blocks = placed.withColumn("_block", F.floor(F.col("window") / per_block))
    return _running(blocks, [], "_block", ["window", "source", "_sent", "_row"], "place").select(
        "_row", "source", "tokens", "window", "place"
    )


def _cut(sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "place", "id_bytes", "ids"))
            for doc, place, size, raw in zip(*columns, strict=True):
                ids = np.frombuffer(raw, np.dtype(f"<u{size}")).astype("<u4")
                start = 0
                while start < len(ids):
                    offset = (place + start) % sequence
                    stop = min(len(ids), start + sequence - offset)
                    rows.append(
                        (
                            doc,
                            start,
                            stop - start,
                            zlib.crc32(ids[start:stop].tobytes()),
                            len(ids),
                            (place + start) // sequence,
                            offset,
                        )
                    )
                    start = stop
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                if rows
                else [pa.array([], pa.int64())] * len(names),
                names=names,
            )

    return run


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def placed_ids(
    documents: DataFrame,
    tokenizer: str,
    targets: DataFrame | None = None,
    window_tokens: int = SEQUENCE * WINDOW_SEQUENCES,
) -> DataFrame:
    """Each document's ids with its window and its place in the stream."""
    ids = tokenised(documents, tokenizer)
    places = layout(ids, targets, window_tokens).select("_row", "window", "place")
    return ids.join(places, "_row")


def packed(
    documents: DataFrame,
    tokenizer: str,
    targets: DataFrame | None = None,
    sequence: int = SEQUENCE,
    window_tokens: int = SEQUENCE * WINDOW_SEQUENCES,
) -> DataFrame:
    """Pieces of all documents in sequences without a gap; only the last sequence is short.

    `documents`: doc_id, source, text; further columns are ignored. The stream of `layout` is cut every
    `sequence` tokens, so a document of any length is cut only there, and padding is needed
    in one sequence of the whole table. A missing or empty text is its end id alone; rows with equal
    doc_id are packed each; an empty table gives no pieces.
    """
    cut = _cut(sequence)
    return placed_ids(documents, tokenizer, targets, window_tokens).mapInArrow(lambda batches: released(cut(batches)), PIECES)
