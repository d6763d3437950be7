"""Byte-level encoding against the tiktoken library, alignment against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellflux.llm import alignment, bytepairs
from cellflux.llm.alignment import Aligner, aligned, diagonals, groups
from cellflux.llm.bytepairs import MergeTable, Splitter, decoded, encoded, unpacked_ids
from cellflux.llm.queries import op9_bpe_rollup, op12_byte_bpe, op13_alignment

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "e", "n", "the", "ing", " ", "  ", "\n", "é", "字", "🙂", "ر", "क", "़", "0", "12", "'s", "'ll"]
ALPHABET += ["...", "՘", "\U00012550", "\x85", "\x1c", "-", "ни", "​", "<|endoftext|>"]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    table, splitter = MergeTable(RANKS), Splitter(public_tokenizers.PATTERN)
    return lambda text: [i for part in splitter.pieces(text) for piece in part for i in table.encode(piece.encode())]


def _random_texts(count: int) -> list[str]:
    rnd = random.Random(3)
    mixed = ["".join(rnd.choices(ALPHABET, k=rnd.randint(1, 40))) for _ in range(count)]
    points = [*range(0x300), *range(0x300, 0xD7FF, 97), *range(0xE000, 0x40000, 211)]
    return mixed + ["".join(chr(rnd.choice(points)) for _ in range(rnd.randint(1, 50))) for _ in range(count)]


def test_encoding_is_that_of_tiktoken(encoder, tiktoken_encoding):
    for text in _random_texts(1500):
        assert encoder(text) == tiktoken_encoding.encode_ordinary(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_by_tiktoken(encoder, tiktoken_encoding, text):
    assert encoder(text) == tiktoken_encoding.encode_ordinary(text)


def test_long_pieces_take_linear_work(encoder, tiktoken_encoding):
    rnd = random.Random(4)
    for text in ("a" * 100_000, " " * 50_000 + "x", "".join(rnd.choices("abcdefghij", k=100_000)), "=-" * 30_000):
        assert encoder(text) == tiktoken_encoding.encode_ordinary(text)


def test_a_small_table_by_plain_merging(tmp_path):
    """Every string of three letters against merging pair by pair, with a table whose merges overlap."""
    extra = [b"aa", b"ab", b"ba", b"aab", b"abab", b"baa", b"aaaa", b"bc", b"abc", b"cab"]
    made = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(extra)}
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(token) + b" %d\n" % rank for token, rank in made.items()))
    table = MergeTable(str(path))

    def merged(piece: bytes) -> list[int]:
        if piece in made:
            return [made[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(made[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in made]
            if not pairs:
                return [made[p] for p in parts]
            _, at = min(pairs)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    for length in range(1, 9):
        for number in range(3**length):
            piece = bytes(b"abc"[number // 3**i % 3] for i in range(length))
            assert table.encode(piece) == merged(piece), piece


def test_forgetting_pieces_and_pairs_changes_nothing(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bytepairs, "_KNOWN_PIECES", 4)
    monkeypatch.setattr(bytepairs, "_KNOWN_PAIRS", 2)
    monkeypatch.setattr(bytepairs, "_PIECES", 8)
    known, splitter = bytepairs._Known(MergeTable(RANKS)), Splitter(public_tokenizers.PATTERN)
    for text in _random_texts(100):
        ids = b"".join(known[p] for part in splitter.pieces(text) for p in part)
        assert list(unpacked_ids(ids)) == tiktoken_encoding.encode_ordinary(text)


def test_texts_come_back_whole(spark, odd_documents):
    ids = encoded(odd_documents, RANKS, public_tokenizers.PATTERN)
    rows = decoded(ids, RANKS).collect()
    given = Counter((r.doc_id, (r.text or "").encode()) for r in odd_documents.collect())
    assert Counter((r.doc_id, bytes(r.bytes)) for r in rows) == given


def test_digests_of_documents(spark, sf_dir, documents, tiktoken_encoding):
    rows = {r.doc_id: r for r in op12_byte_bpe(spark, sf_dir).collect()}
    for doc in documents.collect():
        ids = tiktoken_encoding.encode_ordinary(doc.text or "")
        row = rows.pop(doc.doc_id)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()
    assert not rows


def test_rollup_of_a_real_tokenizer(spark, sf_dir, documents, tiktoken_encoding):
    want: dict[tuple, list[int]] = {}
    for r in documents.collect():
        size = len(tiktoken_encoding.encode_ordinary(r.text or ""))
        if size:
            total = want.setdefault((r.source, r.lang, "byte_bpe_multi_50k"), [0, 0])
            total[0] += 1
            total[1] += size
    got = {(r.source, r.lang, r.tokenizer): [r.docs, r.tokens] for r in op9_bpe_rollup(spark, sf_dir).collect()}
    assert got == want


def test_no_documents(spark, no_documents):
    ids = encoded(no_documents, RANKS, public_tokenizers.PATTERN)
    assert decoded(ids, RANKS).count() == 0
    documents, pairs = aligned(no_documents, FIRST, SECOND)
    assert documents.count() == 0 and pairs.count() == 0


# ---- alignment ----


def _ends(draw_from: list[int], last: int) -> np.ndarray:
    return np.unique(np.array([*draw_from, last], np.int64))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40)), st.lists(st.integers(1, 40)), st.integers(1, 9))
def test_pieces_of_any_size_give_the_same_groups(left, right, piece):
    a, b = _ends(left, 41), _ends(right, 41)
    common = np.intersect1d(a, b)
    group_a, group_b = groups(a, b, piece)
    assert group_a.tolist() == np.searchsorted(common, a).tolist()
    assert group_b.tolist() == np.searchsorted(common, b).tolist()


def test_pieces_have_equal_work():
    a, b = np.arange(1, 10_001), np.array([5000, 10_000])
    cuts = diagonals(a, b, 1000)
    steps = np.diff(cuts.sum(axis=1))
    assert (steps[:-1] == 1000).all() and steps.sum() == len(a) + len(b)
    assert (np.diff(cuts, axis=0) >= 0).all()


def _brute(texts: list[str | None]) -> list[tuple]:
    """n_a, n_b, groups, links of each text, by walking along the bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    sides = Aligner(FIRST, SECOND)
    out = []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a, bytes_b = [sides.a.tokens[i] for i in a], [sides.b.tokens[i] for i in b]
        whole = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a = b = bytes_a = bytes_b = []
        stops = set(np.cumsum([len(t) for t in bytes_a]).tolist()) & set(np.cumsum([len(t) for t in bytes_b]).tolist())
        made, links, i, j, at_a, at_b = [], Counter(), 0, 0, 0, 0
        for stop in sorted(stops):
            group_a, group_b = [], []
            while at_a < stop:
                at_a, i = at_a + len(bytes_a[i]), i + 1
                group_a.append(a[i - 1])
            while at_b < stop:
                at_b, j = at_b + len(bytes_b[j]), j + 1
                group_b.append(b[j - 1])
            made.append(",".join(map(str, group_a)) + "|" + ",".join(map(str, group_b)))
            links.update((x, y) for x in group_a for y in group_b)
        out.append((len(a), len(b), ";".join(made), links))
    return out


def _expected(ids: list, texts: list[str | None]) -> Counter:
    found = _brute(texts)
    held = Counter(pair for *_, links in found for pair in links)
    most: dict[int, int] = {}
    for (a, _), count in held.items():
        most[a] = max(most.get(a, 0), count)
    rows = Counter()
    for doc_id, (n_a, n_b, text, links) in zip(ids, found, strict=True):
        best = sum(n for (a, b), n in links.items() if held[a, b] == most[a])
        total = sum(n * held[pair] for pair, n in links.items())
        parts = text.count(";") + 1 if text else 0
        rows[(doc_id, n_a, n_b, parts, sum(links.values()), best, total, text)] += 1
    return rows


def _rows(result) -> Counter:
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return Counter(tuple(r) for r in result.select(columns).collect())


def test_alignment_of_documents(spark, sf_dir, documents):
    given = documents.collect()
    result = op13_alignment(spark, sf_dir).withColumnRenamed("groups_sha256", "groups")
    expected = Counter()
    for row, count in _expected([r.doc_id for r in given], [r.text for r in given]).items():
        digest = hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else ""
        expected[(*row[:-1], digest)] += count
    assert _rows(result) == expected


def test_alignment_of_odd_documents(spark, odd_documents):
    extra = ["🙂🙂🙂", "é ½ ｆｕｌｌ", " " * 500 + "x", "▁a", "<s> <0x41>", "\x00\x01", "same same", "same same"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    docs = odd_documents.unionByName(more, allowMissingColumns=True)
    given = docs.collect()
    result, pairs = aligned(docs, FIRST, SECOND)
    assert _rows(result) == _expected([r.doc_id for r in given], [r.text for r in given])
    assert pairs.filter("best").select("a").distinct().count() == pairs.select("a").distinct().count()


def test_blocks_parts_and_wide_groups_change_nothing(monkeypatch):
    rnd = random.Random(5)
    texts = _random_texts(60) + ["".join(rnd.choices("ab 字🙂", k=300)), "word " * 400, "x" * 3000]
    whole = _brute(texts)
    for name, value in (("PIECE", 7), ("_TEXT", 50), ("_PAIRS", 3), ("_WIDE", 1), ("_KNOWN_WORDS", 2)):
        monkeypatch.setattr(alignment, name, value)
        aligner = Aligner(FIRST, SECOND)
        aligner.align(texts[:20])
        rows, pairs = aligner.align(texts)
        ends = np.cumsum(rows["sizes"])
        for i, (n_a, n_b, text, links) in enumerate(whole):
            some = slice(ends[i] - rows["sizes"][i], ends[i])
            own = {
                (int(pairs["a"][p]), int(pairs["b"][p])): int(t)
                for p, t in zip(rows["pair"][some], rows["times"][some], strict=True)
            }
            assert (rows["n_a"][i], rows["n_b"][i], rows["groups"][i], own) == (n_a, n_b, text, dict(links)), texts[i]


def test_words_are_encoded_as_in_their_text():
    """Blanks of all kinds around words of all kinds."""
    signs = ["a", "the", "1", ".", "'s", "é", "字", "🙂", "▁", "\n", "\t", "\u3000", "\xa0", "\x1c", " ", " ", " ", "  "]
    rnd = random.Random(6)
    texts = ["".join(rnd.choices(signs, k=rnd.randint(1, 25))) for _ in range(3000)]
    rows, _ = Aligner(FIRST, SECOND).align(texts)
    for i, (n_a, n_b, text, _) in enumerate(_brute(texts)):
        assert (rows["n_a"][i], rows["n_b"][i], rows["groups"][i]) == (n_a, n_b, text), texts[i]


def test_many_blocks(spark, documents, monkeypatch):
    """Counts are those of all documents, however these fall into blocks and tasks."""
    docs = documents.limit(60).repartition(5)
    given = docs.select("doc_id", F.col("text")).collect()
    monkeypatch.setattr(alignment, "BLOCK", 2000)
    result, _ = aligned(docs, FIRST, SECOND)
    assert _rows(result) == _expected([r.doc_id for r in given], [r.text for r in given])
