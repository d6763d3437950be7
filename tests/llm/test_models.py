"""Pages, likelihood, packing, Jaccard groups, graphs and toxicity against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from cellflux.llm import common, graphs, jaccard, lattice, mixing, packing, pages, toxicity
from cellflux.llm.components import connected
from cellflux.llm.queries import QUERIES
from cellflux.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(SMALL))


# --- op 1 -----------------------------------------------------------------------

PAGE = (
    "<html><head><title>T</title><style>p{{}}</style></head><body><div class='top-menu'><a>Home</a></div>{0}"
    "<form>Mail <input></form><div id=comments><p>first!</p></div><footer>(c)</footer><script>x('</p>')</script></body>"
)


def test_markup_decides_where_it_speaks():
    page = PAGE.format("<main><header><h1>A &amp; B</h1></header><p>one\n  two<p class=share>tweet</p>&lt;three&gt;<br>four</main>stray")
    assert pages.main_texts([page, None, ""]) == ["A & B\none two\n<three>\nfour", "", ""]


def test_repeated_runs_go_where_markup_is_silent():
    line = "this site is made by a small team of people who like words"
    bodies = [f"<div>{line}</div><div>own text number {i} " + " ".join(f"u{i}x{k}" for k in range(20)) + "</div>" for i in range(4)]
    texts = pages.main_texts(bodies)
    assert all(line not in t and f"own text number {i}" in t for i, t in enumerate(texts))
    assert pages.main_texts(bodies[:1])[0].startswith(line)  # alone, nothing repeats
    assert pages.main_texts([bodies[0]] * 3) == pages.main_texts(bodies[:1]) * 3  # copies do not


def test_articles_keep_passages_that_others_share():
    passage = " ".join(f"shared{k}" for k in range(60))
    bodies = [f"<article><p>{passage}</p><p>own {i}</p></article>" for i in range(3)]
    assert pages.main_texts(bodies) == [f"{passage}\nown {i}" for i in range(3)]


CASES = [
    ("<body><nav>m</nav><div class='content no-sidebar'><article><p>hello world</p></article></div></body>", "hello world"),
    ("<div class=has-sidebar><article>hello</article></div>", "hello"),
    ("<body><form><nav>x</nav><article>hello</article></form></body>", "hello"),
    ("<body><form><div><p>all of the page stands in a form</p></div></form></body>", "all of the page stands in a form"),
    ("<section id=privacy><article>hello</article></section>", "hello"),
    ("<section class=privacy><p>what we do with your data, at length</p></section><p>end</p>", "what we do with your data, at length\nend"),
    ("<article><h2 class=section-header>Head</h2><div class=entry-header><h1>Title</h1></div>text</article>", "Head\nTitle\ntext"),
    ("<article>one<svg/> two <svg class='a'><path d='x'/></svg>three</article>", "one two three"),
    ("<article>own text<article class=comment>a reader says</article><div id=comments>more</div></article>", "own text"),
    ("<article class='post comments-open'>text</article>", "text"),
    ("<div class=nav>m</div><div ROLE='main'>text</div><div>stray</div>", "text"),
    ("<article>if <math><mi>x</mi></math> is</article>", "if x is"),
    ("<article>story of the day</article><aside><article>teaser</article></aside>", "story of the day"),
    ("<footer><article>the only article</article></footer>", "the only article"),
    ("<header><h1>Site</h1></header><article><header><h1>T</h1></header>x</article><footer>f</footer>", "T\nx"),
    ("<article>a<div class='ad-slot'>buy this now</div><p style='display: none'>no</p>b c d e</article>", "a\nb c d e"),
    ("<nav>only</nav><footer>chrome</footer>", ""),
    ("a &lt;b&gt;&nbsp;&amp;amp; <!-- <article>no</article> --><br>c\t\n d", "a <b> &amp;\nc d"),
    ("<article>unclosed <b>text <p>one<p>two", "unclosed text\none\ntwo"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_single_pages(page, text):
    assert pages.main_texts([page]) == [text]


def _host(number: int) -> list[str]:
    """Pages of one host whose text is known: a sign-up line on two thirds, a passage on a few, some pages without marks."""
    line = "please sign up for our weekly letter and never miss a story"
    passage = " ".join(f"shared{k}" for k in range(60))
    out = []
    for i in range(number):
        own = [f"page {i} " + " ".join(f"w{i}x{k}x{j}" for k in range(12)) for j in range(3)]
        body = f"<p>{own[0]}</p>" + (f"<p>{line}</p>" if i % 3 else "") + f"<p>{own[1]}</p>"
        body += (f"<p>{passage}</p>" if i % 20 == 1 else "") + f"<p>{own[2]}</p>"
        site = "<p>all of this site is written by the same three people since long ago</p>"
        out.append(f"<div>{site}{body}</div>" if i % 5 == 2 else f"<div>{site}</div><article>{body}</article>")
    return out


def _known_text(page: str) -> str:
    parts = re.findall("<p>(.*?)</p>", page)
    return "\n".join(p for p in parts if not p.startswith(("please sign", "all of this site")))


def test_pages_with_known_text():
    host = _host(90)
    assert pages.main_texts(host) == [_known_text(p) for p in host]


def test_repetition_decides(monkeypatch):
    host = _host(90)
    monkeypatch.setattr(pages, "run_counts", lambda tokens, *rest: np.zeros(len(tokens), np.int64))
    without = pages.main_texts(host)
    assert sum(a != _known_text(p) for a, p in zip(without, host, strict=True)) == sum(i % 3 > 0 or i % 5 == 2 for i in range(90))


def test_the_size_of_shards_changes_nothing(spark):
    host = [(i, f"http://one.example/{i}", p) for i, p in enumerate(_host(90))]
    host += [(1000 + i, "HTTP://One.example/copy", host[4][2]) for i in range(40)]  # copies: many shards' worth
    host += [(None, "http://one.example/x", host[0][2]), (None, None, host[1][2]), (5000, "http://two.example", host[0][2])]
    df = spark.createDataFrame(host, "page_id long, url string, html string").repartition(3)
    for size in (7, 512):
        rows = pages.extracted(df, size).collect()
        got = Counter((r.page_id, r.url, r.text) for r in rows)
        small = {None: "", "http://two.example": ""}
        want = Counter()
        for page_id, url, page in host:
            # A page that is alone on its host repeats nothing.
            text = _known_text(page) if url not in small else pages.main_texts([page])[0]
            want[page_id, url, text] += 1
        assert got == want, size


def test_lists_of_runs_in_several_parts(spark, monkeypatch):
    monkeypatch.setattr(pages, "_RUNS_AT_ONCE", 1)
    monkeypatch.setattr(pages, "BROADCAST_ROWS", 0)
    rows = [(i, f"http://h{h}.example/{i}", p) for h in range(3) for i, p in enumerate(_host(30))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.url, r.text) for r in pages.extracted(df, 7).collect())
    want = Counter((url, text) for h in range(3) for (_, url, _), text in zip(rows[h * 30 :], pages.main_texts(_host(30)), strict=False))
    assert got == want


def test_suffix_runs_against_brute_force():
    draw = np.random.default_rng(1)
    streams = [draw.integers(0, 3, draw.integers(0, 60)) for _ in range(12)]
    streams.append(streams[3].copy())
    for run in (1, 3, 8):
        got = pages.repeated(streams, run)
        where = defaultdict(set)
        for i, s in enumerate(streams):
            for k in range(len(s) - run + 1):
                where[s[k : k + run].tobytes()].add(s.tobytes())
        for s, (cover, again) in zip(streams, got, strict=True):
            want = np.zeros(len(s), int)
            for k in range(len(s) - run + 1):
                want[k : k + run] = np.maximum(want[k : k + run], len(where[s[k : k + run].tobytes()]))
            assert cover.tolist() == want.tolist() and again.tolist() == (want > 1).tolist()


def test_pages_of_every_host(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = table.limit(1).select(F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    both = table.unionByName(odd).withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    rows = pages.extracted(both, 7).collect()  # several shards
    assert len(rows) == table.count() + 1
    html = {r.page_id: r.html for r in table.collect()}
    for r in rows:
        assert r.n_chars == len(r.text)
        article = re.search("(?s)<article>(.*)</article>", html.get(r.page_id, "") or "")
        assert (article is None) == (r.text == "")
    assert pages.extracted(both.limit(0)).count() == 0


# --- op 2 -----------------------------------------------------------------------


def test_lattice_sums_over_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    trie = lattice.Lattice(pieces)
    logs = np.log(np.linspace(1, 2, len(pieces) + 256) / 500)

    def total(text):
        if not text:
            return 1.0
        out = sum(math.exp(logs[i]) * total(text[len(p) :]) for i, p in enumerate(pieces) if text.startswith(p))
        if text[0] not in pieces:
            own = sum(logs[len(pieces) + b] for b in text[0].encode())
            out += math.exp(own) * total(text[1:])
        return out

    words = ["abab", "é", "aéb", "bbbb", "a"]
    uses = np.zeros(len(logs))
    for places, chars in lattice.by_length(words):
        arcs = trie.arcs(chars)
        for place, value in zip(places, trie.forward(chars, arcs, logs)[:, -1], strict=True):
            assert value == pytest.approx(math.log(total("▁" + words[place])))
        trie.expected(chars, arcs, logs, np.ones(len(places)), uses)
    covered = sum(n * len(p.encode()) for n, p in zip(uses, pieces, strict=False)) + uses[len(pieces) :].sum()
    assert covered == pytest.approx(sum(len(("▁" + w).encode()) for w in words))


def test_likelihood_contract(spark, documents, odd_documents, no_documents):
    import public_tokenizers

    vocabulary = lattice.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    table = documents.unionByName(odd_documents.select(documents.columns).filter("doc_id <> 9 OR doc_id IS NULL").withColumn("doc_id", F.col("doc_id") + 10_000))
    texts = {r.doc_id: words_of(r.text) + [None] for r in table.collect()}
    count = Counter(w for i, t in texts.items() if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1 for w in t)
    n, v = sum(count.values()), len(count)
    rows = lattice.likelihoods(table, *vocabulary, rounds=2, block_bytes=50_000).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), n)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert -1e9 < r.score < 0
    again = lattice.likelihoods(table, *vocabulary, rounds=2, block_bytes=5_000_000).collect()
    assert {r.doc_id: pytest.approx(r.score, rel=1e-6) for r in again} == {r.doc_id: r.score for r in rows}
    assert lattice.likelihoods(no_documents, *vocabulary).count() == 0


def _fitted(spark, rows, monkeypatch, **settings):
    """The scores, and what the model consists of."""
    import public_tokenizers

    known = {}
    words, documents = lattice._scored_words, lattice._document_scores

    def spy_words(trie, weights, classes):
        known.update(trie=trie.value, logs=weights.value)
        return words(trie, weights, classes)

    def spy_documents(mix, tokens, priors, ends):
        known.update(mix=mix, tokens=tokens, ends=ends)
        return documents(mix, tokens, priors, ends)

    monkeypatch.setattr(lattice, "_scored_words", spy_words)
    monkeypatch.setattr(lattice, "_document_scores", spy_documents)
    vocabulary = lattice.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return lattice.likelihoods(df, *vocabulary, **settings).collect(), known


def test_scores_against_brute_force(spark, monkeypatch):
    """The whole mixture: classes, their words, all words, and every segmentation of each word."""
    draw = np.random.default_rng(5)
    stock = ["the", "that", "one", "of", "sum", "é", "ab", "abab", "zzz", "x1"]
    langs = ["en", "fr", None, "de"]
    rows = [(i, " ".join(draw.choice(stock, draw.integers(0, 9)).tolist()), langs[i % 4]) for i in range(60)]
    rows += [(100, "unseen words here", "xx"), (101, None, "en"), (102, "", "fr")]
    got, model = _fitted(spark, rows, monkeypatch, rounds=2)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows}
    train = [(t or "", "" if k is None else k) for i, t, k in rows if not held[i]]
    kinds = sorted(Counter(k for _, k in train).items(), key=lambda x: (-x[1], x[0]))[: lattice.CLASSES]
    classes = [k for k, _ in kinds]
    by_class = [Counter(w for t, k in train if k == c for w in t.split()) for c in classes]
    whole = sum(by_class, Counter())
    numbers = {p: math.exp(x) for p, x in zip(model["trie"].pieces, model["logs"], strict=False)}

    def pieces(word):
        if not word:
            return 1.0
        out = sum(numbers[word[:n]] * pieces(word[n:]) for n in range(1, len(word) + 1) if word[:n] in numbers)
        if word[0] not in numbers:
            own = sum(model["logs"][len(model["trie"].pieces) + b] for b in word[0].encode())
            out += math.exp(own) * pieces(word[1:])
        return out

    for r in got:
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        total = 0.0
        for k, c in enumerate(classes):
            ends = sum(kind == c for _, kind in train)
            size = sum(by_class[k].values())
            end = ends / (size + ends)
            chance = ends / len(train) * end
            for w in text.split():
                share = model["mix"][0] * by_class[k][w] / max(size, 1) + model["mix"][1] * whole[w] / sum(whole.values())
                chance *= (1 - end) * (share + model["mix"][2] * pieces("▁" + w))
            total += chance
        assert r.score == pytest.approx(math.log10(total), abs=1e-4), text


def test_probabilities_of_all_texts_sum_to_one(spark, monkeypatch):
    """By closed sums over all lengths, nothing cut: words by pieces, then texts by words."""
    rows = [(i, t, "en" if i % 3 else "de") for i, t in enumerate(["a b", "ab", "", "b b b a", "ba a"] * 12)]
    _, model = _fitted(spark, rows, monkeypatch, rounds=3)
    weights = np.exp(model["logs"])
    first = np.array([p.startswith("▁") for p in model["trie"].pieces] + [False] * 256)
    # A word is a first piece and any number of others: a geometric series, which is 1 where weights add up to 1.
    words_by_pieces = weights[first].sum() / (1 - weights[~first].sum())
    assert words_by_pieces == pytest.approx(1, abs=1e-9)
    seen = sorted({w for _, t, _ in rows for w in t.split()})
    train = [(t, k) for i, t, k in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    langs = [k for k, _ in Counter(k for _, k in train).most_common()]
    counts = np.array([[sum(t.split().count(w) for t, k in train if k == c) for c in langs] + [0] for w in seen])
    assert (counts.sum(axis=0) == model["tokens"]).all()
    own, whole = lattice._shares(counts, model["tokens"])
    for k, end in enumerate(model["ends"][:-1]):
        words = (1 - end) * (model["mix"][0] * own[:, k].sum() + model["mix"][1] * whole.sum() + model["mix"][2] * words_by_pieces)
        # Texts of any number of words, then the end.
        assert end / (1 - words) == pytest.approx(1, abs=1e-9)


def test_likelihood_of_texts_without_words(spark, monkeypatch):
    got, _ = _fitted(spark, [(i, t, "en") for i, t in enumerate([None, "", " \n"] * 4)], monkeypatch, block_bytes=1)
    assert len(got) == 12 and all(r.n_tokens == 1 and r.score == pytest.approx(0, abs=1e-9) for r in got)


def test_likelihood_without_training_rows(spark, monkeypatch):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    got, model = _fitted(spark, [(i, "some words", "en") for i in held], monkeypatch)
    assert model["mix"] == (0.0, 0.0, 1.0) and all(-60 < r.score < 0 for r in got) and len(got) == len(held)


# --- op 4 -----------------------------------------------------------------------


def reference_ids(tokenizer, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    return [[*model.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    import random

    draw = random.Random(3)
    signs = list("abcXYZ   \n\t.,;!?'\"|<>-_@#012éÉßñ×ªº“” ​ \x1c\x85İıΣς中あ한😀é") + ["<|endoftext|>", "'s", "'ll"]
    texts = ["".join(draw.choice(signs[: draw.choice((14, 32, len(signs)))]) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    encoder = packing.WordEncoder(tokenizer)
    got = [np.frombuffer(x, encoder.kind).tolist() + [1] for x in encoder.encode([t.encode() for t in texts])]
    assert got == reference_ids(tokenizer, texts)


@pytest.mark.parametrize("given", ["documents", "odd_documents"])
def test_packing_is_a_round_trip(request, given, tokenizer):
    df = request.getfixturevalue(given)
    rows = packing.packed(df, tokenizer).collect()
    known = df.select("doc_id", "text").collect()
    want = Counter(
        (r.doc_id, tuple(ids)) for r, ids in zip(known, reference_ids(tokenizer, [r.text for r in known]), strict=True)
    )
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    fill = []
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and 0 < p.length <= packing.SEQUENCE
            at += p.length
        fill.append(at)
    assert sum(f < packing.SEQUENCE for f in fill) <= 1
    left = Counter({(doc, len(ids)): 0 for doc, ids in want})
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for (doc, ids), copies in want.items():
        raw = np.array(ids, "<u4")
        mine = [p for p in by_doc[doc] if zlib.crc32(raw[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids)]
        assert sorted(sum(([k] * p.length for p in mine for k in [0]), [])) == [0] * len(ids) * copies
        covered = Counter(i for p in mine for i in range(p.start, p.start + p.length))
        assert set(covered.values()) == {copies} and len(covered) == len(ids)
    assert left is not None


def test_windows_hold_the_target_shares(spark):
    rows = [(i, "abc"[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2], 20 + i * 7 % 60) for i in range(6000)]
    lengths = spark.createDataFrame(rows, "_row long, source string, tokens long")
    window = 5000
    out = packing.layout(lengths, window_tokens=window).collect()
    total = sum(r.tokens for r in out)
    share = {s: sum(r.tokens for r in out if r.source == s) / total for s in "abc"}
    sent = defaultdict(Counter)
    for r in out:
        sent[r.window][r.source] += r.tokens
    debt = Counter()
    for w in sorted(sent)[:-1]:  # a deficit is never more than a document
        for s in "abc":
            debt[s] += sent[w][s] - share[s] * window
            assert abs(debt[s]) <= 80
    places = sorted((r.place, r.tokens) for r in out)
    assert [p for p, _ in places] == [0, *np.cumsum([t for _, t in places])[:-1].tolist()]


def test_targets_order_the_sources(spark):
    rows = [(i, ("a", "b", None)[i % 3], 10) for i in range(900)]
    lengths = spark.createDataFrame(rows, "_row long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.75), ("b", 0.25)], "source string, share double")
    out = packing.layout(lengths, targets, 400).collect()
    early = Counter(r.source for r in out if r.window < 10)
    assert early == {"a": 300, "b": 100}
    assert min(r.window for r in out if r.source is None) > max(r.window for r in out if r.source)
    assert packing.layout(lengths.limit(0)).count() == 0


def test_packing_nothing(no_documents, tokenizer):
    assert packing.packed(no_documents, tokenizer).count() == 0


# --- op 5 -----------------------------------------------------------------------


def brute_groups(rows):
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        sets.setdefault(doc, []).append(frozenset(grams))
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}, {i: [len(s) for s in own] for i, own in sets.items()}


def assert_groups(df):
    rows = df.select("doc_id", "text").filter("doc_id IS NOT NULL").collect()
    component, sizes = brute_groups([(r.doc_id, r.text) for r in rows])
    got = jaccard.near_groups(df).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.component_id == component[r.doc_id] and r.n_shingles in sizes[r.doc_id]
    return component


def test_groups_of_tables(documents, odd_documents, no_documents):
    assert_groups(documents)
    component = assert_groups(odd_documents)
    assert component[6] == 5 and component[7] == 4 and component[9] == -5
    assert jaccard.near_groups(no_documents).count() == 0


@pytest.mark.parametrize("frequent", [3, 10**9])
def test_groups_of_large_families(spark, monkeypatch, frequent):
    """Chains and families of copies edited more and more, with frequent and with rare shingles."""
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", frequent)
    draw = np.random.default_rng(11)
    base = [f"b{i}" for i in range(120)]
    rows, text = [], list(base)
    for i in range(150):
        if i % 3 == 0:
            text = list(base)
        text = list(text)
        for _ in range(int(draw.integers(0, 4))):
            text[int(draw.integers(len(text)))] = f"n{i}x{int(draw.integers(50))}"
        rows.append((i * 7 % 150, " ".join(text[int(draw.integers(0, 3)) :])))
    assert len(set(assert_groups(spark.createDataFrame(rows, "doc_id long, text string")).values())) > 1


@pytest.mark.parametrize("long", [300, 13])
def test_groups_of_documents_that_are_near_and_not_linked(spark, monkeypatch, long):
    """A family of which each pair shares about 70 %, some of them linked, in lists of all kinds."""
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 4)
    monkeypatch.setattr(jaccard, "LONG", long)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SMALL", 3)
    draw = np.random.default_rng(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(120):
        text = list(base)
        for at in draw.choice(100, int(draw.choice([1, 2, 3])), replace=False).tolist():
            text[at] = f"own{i}x{at}"
        rows.append((1000 + i, " ".join(text)))
    component = assert_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len(set(component.values())) > 1


@pytest.mark.parametrize("ids", [1_000_000, 40])
def test_groups_of_components_that_are_compared_in_blocks(spark, monkeypatch, ids):
    """A large component among separate documents near it and each other, and small families, in blocks and in turns."""
    for name, value in {"FREQUENT_LEAST": 4, "BLOCK": 16, "SMALL": 0, "EACH": 0, "BROADCAST_IDS": ids}.items():
        monkeypatch.setattr(jaccard, name, value)
    draw = np.random.default_rng(5)
    rows = []
    for family, (docs, least) in enumerate([(90, 0), (12, 0), (12, 0), (5, 1), (2, 0), (2, 2)]):
        base = [f"f{family}b{i}" for i in range(100)]
        for i in range(docs):
            text = list(base)
            for at in draw.choice(100, int(draw.integers(least, 4)), replace=False).tolist():
                text[at] = f"own{family}x{i}x{at}"
            rows.append((len(rows) * 7 % 123, " ".join(text)))
    component = assert_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len(set(component.values())) > 6


def test_pairs_are_dealt_into_few_groups(spark):
    """A component of 300 documents near 200 others, and 150 that are all near each other, are not one group a pair; none is lost."""
    nodes = {0: list(range(300))} | {i: [i] for i in range(300, 650)}
    pairs = [(0, i) for i in range(300, 500)] + [(i, j) for i in range(500, 650) for j in range(i + 1, 650)] + [(310, 640)]
    members = spark.createDataFrame([(k, doc, 60) for k, own in nodes.items() for doc in own], "node long, doc_id long, n long")
    heads = spark.createDataFrame([(k, 0 if k < 500 else 500) for k in nodes], "node long, head long")
    placed, single = jaccard._dealt(spark.createDataFrame(pairs, "a long, b long"), heads, members, 30, 2)
    rows = placed.collect()
    assert len(rows) < 4000  # 60 200 and 22 350 documents, group by group
    groups = {}
    for r in rows:
        groups.setdefault((r.x, r.y), []).append(r)
    got = {tuple(r) for r in single.collect()}
    for (x, y), own in groups.items():
        for r in own:
            got |= {(r.doc_id, s.doc_id) for s in own if r.doc_id < s.doc_id and {r.block, s.block} == {x, y}}
    assert got >= {(a, b) for i, j in pairs for a in nodes[i] for b in nodes[j]}


def test_near_copies_under_many_keys_are_not_written_pair_by_pair():
    """Twelve near copies have nearly all of their keys in common."""
    n = 500
    keys = np.repeat(np.arange(100), 12)
    columns = [keys, np.zeros(1200), np.tile(np.arange(12), 100), np.full(1200, n), keys, n - keys]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    table = pa.Table.from_arrays(
        [pa.array(c, pa.int64()).cast(k) for c, k in zip([np.asarray(c, np.int64) for c in columns], kinds, strict=True)],
        names=["key", "salt", "doc_id", "n", "before", "rest"],
    )
    met = pa.Table.from_batches(jaccard._meetings(80)(iter(table.to_batches(max_chunksize=50))))
    assert met.num_rows == 100  # not 66 pairs for each key
    assert set(map(tuple, met["docs"].to_pylist())) == {tuple(range(12))}


def test_links_within_against_brute_force():
    draw = np.random.default_rng(4)
    for dense in (0, 2, 64):
        jaccard._DENSE, before = dense, jaccard._DENSE
        sets = [np.sort(draw.choice(30, int(draw.integers(22, 31)), replace=False)).astype(np.uint64) for _ in range(70)]
        sets += [np.zeros(0, np.uint64), np.array([99], np.uint64), np.array([99], np.uint64), sets[0][:1]]
        got = {tuple(p) for p in jaccard.links_within(sets, 80).tolist()}
        want = {(i, j) for i in range(74) for j in range(i + 1, 74) if jaccard.similar(sets[i], sets[j], 80)}
        jaccard._DENSE = before
        assert got == want and want


def test_a_list_of_very_many_separate_documents(spark):
    """Twenty thousand documents near each other and none linked, all in the same lists, are compared in bounded groups."""
    import time

    draw = np.random.default_rng(9)
    base = np.array([f"b{i}" for i in range(60)])
    rows = []
    for i in range(20_000):
        text = base.copy()
        for at in draw.choice(60, 4, replace=False).tolist():
            text[at] = f"own{i}x{at}"
        rows.append((i, " ".join(text.tolist())))
    lists = spark.createDataFrame([(key, i, i) for key in (1, 2, 3) for i in range(20_000)], "key long, doc_id long, component long")
    pools = jaccard._of_long_lists(lists).withColumns({"n": F.lit(56), "side": F.lit(0)})
    assert pools.count() == 20_000  # one pool, not three
    began = time.monotonic()
    got = jaccard._compared(spark.createDataFrame(rows, "doc_id long, text string"), pools, 5, 80).collect()
    assert time.monotonic() - began < 240
    for r in got[:50]:
        pair = [jaccard.shingle_sets(word_hashes([rows[i][1].encode()]))[0] for i in (r.a, r.b)]
        assert jaccard.similar(*pair, 80)


def test_compared_blocks_are_written_before_the_next_python_step(spark):
    """A task that joins two steps in Python holds two workers, which stay with the executor."""
    rows = [(i, f"a b c d e f g h i j k l m n o p q r s t u v w x y z {i}") for i in range(6)]
    pools = spark.createDataFrame([("p", 0, i, i, 23) for i in range(6)], "pool string, side int, doc_id long, component long, n long")
    got = jaccard._compared(spark.createDataFrame(rows, "doc_id long, text string"), pools, 5, 80)
    assert "InArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.component for r in connected(got).collect()} == {0}


def test_counting_shingles_copies_little():
    """What a task has counted is not copied several times over when more texts come."""
    import tracemalloc

    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 50_000, 4000)) for _ in range(500)]
    for i in (0, 1, 2, 3, 150, 450):
        texts[i] = f"a b c d e {texts[i]}"
    texts[7] = texts[300]  # a copy counts once
    batches = pa.Table.from_pydict({"doc_id": pa.array(range(500), pa.int64()), "text": texts}).to_batches(100)
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        last = list(jaccard._facts(5)(iter(batches)))[-1]
        peak = (tracemalloc.get_traced_memory()[1] - before) / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 120, peak  # MB, for up to two million shingles of 8 bytes and as many counts; 150 with copies
    assert last.column("n").to_pylist() == [6]  # the only shingle of four texts or more


def test_python_workers_give_back_what_they_do_not_use(monkeypatch):
    """Words of another operator go when shingles are worked on, and Arrow's own pool is emptied."""
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(len(common._WORKER))

    monkeypatch.setattr(common, "_WORKER", {})
    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    common.worker_cache("toxicity:1")["word"] = 1.0
    assert not calls
    assert list(jaccard._trimmed(iter)([1, 2])) == [1, 2]
    assert calls == [0, 1]  # when the words went, and after the batches
    assert "toxicity:1" not in common._WORKER


class _Sent:
    """A broadcast value without a session."""

    def __init__(self, value):
        self.value = value


def test_dealt_out_lists_lose_no_link():
    """Pairs of near copies, of shingles counted far more often than the lists of their keys are long."""
    percent, texts = jaccard.PERCENT, {}
    for family in range(30):
        own = [f"p{family}x{k}" for k in range(44)]
        texts[2 * family] = " ".join(own)
        texts[2 * family + 1] = " ".join([*own[:-1], "other"])
    sets = dict(zip(texts, jaccard.shingle_sets(word_hashes([t.encode() for t in texts.values()])), strict=True))
    heavy = np.unique(np.concatenate(list(sets.values())))
    rank = np.full(len(heavy), 400 * jaccard.LIST)  # as if counted in many long documents
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(texts.values())], names=["doc_id", "text"])
    rows = pa.Table.from_batches(jaccard._postings(_Sent(heavy), _Sent(rank), jaccard.WORDS, percent)(iter([batch])))
    assert pc.min(rows["salt"]).as_py() > 0
    rows = rows.sort_by([("key", "ascending"), ("salt", "ascending")])
    met = pa.Table.from_batches(jaccard._meetings(percent)(iter(rows.to_batches(max_chunksize=37))))
    pairs = {(a, b) for a, b in zip(met["a"].to_pylist(), met["b"].to_pylist(), strict=True) if b is not None}
    lists = met.filter(pc.is_valid(met["key"])).select(["key", "a", "n", "before", "rest"]).sort_by("key")
    apart = pa.Table.from_batches(jaccard._component_pairs(percent)(iter(lists.to_batches())))
    # Each document is a component of its own, as if no pair had been verified yet.
    pairs |= set(zip(apart["ca"].to_pylist(), apart["cb"].to_pylist(), strict=True))
    ids = sorted(sets)
    links = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if jaccard.similar(sets[a], sets[b], percent)}
    assert links and links <= pairs


def test_words_are_hashed_as_if_one_by_one():
    texts = ["", " ", "A b\nc", "Ünï x" * 3, "long " * 9, "ẞß"]
    together = word_hashes([t.encode() for t in texts])
    hash_of = {}
    for text, value in zip(texts, together, strict=True):
        assert len(value) == len(words_of(text))
        for w, h in zip(words_of(text), value.tolist(), strict=True):
            assert hash_of.setdefault(w, h) == h == word_hashes([w.encode()])[0][0]
    assert len(set(hash_of.values())) == len(hash_of)


def test_long_paths_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 999), (5000, 5000)], "a long, b long")
    got = {r.node: r.component for r in connected(links.repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(301)}, 999: 999, 1000: 999}


# --- op 6 -----------------------------------------------------------------------


def brute_nearest(rows, k):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            near = sorted((math.dist(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out[q] = [i for _, i in near]
    return out


@pytest.mark.parametrize("block", [2048, 1])
def test_nearest_recall_and_scores(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(graphs, "QUERIES", block)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()]
    got = defaultdict(list)
    for r in graphs.nearest(table, F.pmod("vec_id", F.lit(100)) == 0, shard=150).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want, vectors = brute_nearest(rows, 10), dict(rows)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [n for n, _, _ in found] == list(range(1, 11))
        assert all(s == pytest.approx(math.dist(vectors[q], vectors[i]), abs=1e-12) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(want[q]))
    assert hits >= 0.95 * 10 * len(want)


def test_equal_and_unusable_vectors(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(0, 400)] + [(1000, [1.0, 2.5]), (1100, [1.0, 2.5, 3.0]), (1200, None), (1300, [0.0, 0.0])]
    rows += [(1400, [float("nan"), 1.0]), (1500, [None, 1.0]), (1600, [float("inf"), 1.0]), (None, same), (1700, []), (100, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("digest", F.lit(1))
    got = defaultdict(list)
    for r in graphs.nearest(df, F.pmod("vec_id", F.lit(100)) == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[0] == list(range(1, 11)) and got[300] == got[1000] == list(range(10)) and got[100] == list(range(10))
    assert got.keys() == {0, 100, 200, 300, 1000}
    assert graphs.nearest(df.limit(0), F.lit(True)).count() == 0


# --- op 10 ----------------------------------------------------------------------

INSULTS = ["blorfank", "drizzlenut", "mugwort"]


def toxic_corpus(n=240):
    draw = np.random.default_rng(3)
    common = [f"{a}{b}" for a in ("ten", "pal", "ori", "sum", "vek") for b in ("da", "lo", "mi", "ru", "so")]
    rows = []
    for i in range(n):
        words = draw.choice(common, 40).tolist()
        if i % 4 == 0:
            words[int(draw.integers(40))] = INSULTS[i // 4 % 3] + draw.choice(["", "s", "ly"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_gapped_and_stretched_insults():
    rows = toxic_corpus()
    machine = toxicity.fit([t for _, t, _ in rows], [y for *_, y in rows])

    def score(word):
        text = f"tenda pallo {word} orimi sumru"
        facts = toxicity._facts(machine.unit_scores(sorted(toxicity.units(text))).tolist())
        return float(machine.probability(np.array([facts]))[0])

    for word in ["Blorfank", "blorf-ank", "b.l.o.r.f.a.n.k", "blorrfank", "b l o r f a n k", "mug*wort!"]:
        assert score(word) > 0.5, word
    for word in ["tenso", "vekda", "palru", "sumlo."]:
        assert score(word) < 0.5, word


def test_masked_insults_count_wherever_they_stand():
    rows = toxic_corpus()
    machine = toxicity.fit([t for _, t, _ in rows], [y for *_, y in rows])
    masked, ahead = ".".join("blorfank"), "tendapaloorimisumruvekdatenlopalmiorisoo"
    assert len(ahead) == 40
    plain, far, clean = machine.unit_scores([ahead + "blorfank", ahead + masked, ahead + ".".join("sumrupal")])
    assert far >= plain - 1e-9 and far > clean


def test_kernel_table_equals_the_kernel():
    """The folded table gives the same decision as kernels to landmarks do."""
    words, marks = ["abcab", "xaybzc", "aaaa", "b"], ["abcab", "zzabc"]
    places, matrix = toxicity._landmark_rows(marks)
    alpha = np.array([0.5, -2.0], np.float32)
    table = np.zeros(toxicity._SYMBOLS**3, np.float32)
    table[places >= 0] = (matrix @ alpha)[places[places >= 0]]
    machine = toxicity.Machine(table, 0.25, (1.0, 0.0, 0.0, 0.0))

    def feature(word):
        word = "\0" + word
        out = Counter()
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity._SPAN)):
                    out[word[i] + word[j] + word[k]] += toxicity._DECAY ** (k - i - 2)
        return out

    def kernel(a, b):
        x, y = feature(a), feature(b)
        norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        return sum(v * y[u] for u, v in x.items()) / norm if norm else 0.0

    got = machine.unit_scores(words)
    for word, value in zip(words, got, strict=True):
        want = sum(a * kernel(word, m) for a, m in zip(alpha.tolist(), marks, strict=True)) + 0.25
        assert value == pytest.approx(want if feature(word) else toxicity._FLOOR, abs=1e-5)


def test_toxicity_of_tables(spark, odd_documents, no_documents):
    rows = spark.createDataFrame(toxic_corpus(), "doc_id long, text string, toxic int")
    labels = rows.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    machine = toxicity.fitted(rows, labels)
    scored = toxicity.scored(rows, machine).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r._toxicity >= 0.5) == bool(r.toxic) for r in held) >= 0.95 * len(held)
    odd = toxicity.scored(odd_documents, machine)
    assert odd.columns == [c for c in odd_documents.columns if c != "_toxicity"] + ["_toxicity"]
    assert all(0 <= r._toxicity < 0.5 for r in odd.collect() if r.doc_id != 8)
    assert toxicity.scored(no_documents, toxicity.fitted(no_documents, labels)).count() == 0


# --- the pipeline ---------------------------------------------------------------


def test_stages_take_effect(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = dict(pipeline.STAGES)
    clean = pipeline.materialise(kept["toxicity"](spark, docs, sf_dir), "t")
    score = {r.doc_id: r._toxicity for r in toxicity.scored(docs, machine).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, s in score.items() if s < 0.5}
    alone = pipeline.materialise(kept["near_copies"](spark, clean, sf_dir), "t")
    component, _ = brute_groups([(r.doc_id, r.text) for r in clean.collect()])
    assert sorted(r.doc_id for r in alone.collect()) == sorted(set(component.values()))
    mixed = pipeline.materialise(kept["mixture"](spark, alone, sf_dir), "t")
    assert clean.columns == alone.columns == mixed.columns == docs.columns
    assert mixed.subtract(alone).isEmpty() and mixed.count() == mixed.select("doc_id").distinct().count()
    tokens = [d.agg(F.sum(mixing.word_count("text"))).first()[0] for d in (alone, mixed)]
    assert pipeline.KEPT_TOKENS - 0.05 < tokens[1] / tokens[0] < 1
    pieces = kept["packing"](spark, mixed, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in mixed.collect()}


def test_stages_on_odd_rows(spark, odd_documents, sf_dir):
    import corpus_pipeline as pipeline

    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars")
    alone = dict(pipeline.STAGES)["near_copies"](spark, docs, sf_dir).collect()
    assert sorted((r.doc_id for r in alone if r.doc_id is not None)) == [-5, 1, 2, 3, 4, 5, 8]
    assert sum(r.doc_id is None for r in alone) == 1


def test_whole_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pipeline.run(spark, sf_dir).collect()
    by_stage = docs
    for name, stage in pipeline.STAGES:
        by_stage = pipeline.materialise(stage(spark, by_stage, sf_dir), f"test-{name}")
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, pieces)) == sorted(map(key, by_stage.collect()))
    in_order = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    ends: dict[int, int] = {}
    for r in in_order:
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(end == 2048 for s, end in ends.items() if s != max(ends))


@pytest.fixture
def clashing_documents(spark, odd_documents):
    """Columns that bear the names which stages give to their own."""
    names = ["topic_", "_topic", "_tokens", "_taken", "row", "taken", "weight", "_toxicity", "_toxicity_", "_near_row"]
    names += ["_group", "place", "_weight", "_source", "_salt", "group", "expected", "topic"]
    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumns({c: F.lit(f"own {c}") for c in names})


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "mixture", "packing"])
def test_every_stage_on_odd_clashing_and_empty_tables(spark, clashing_documents, sf_dir, name):
    import corpus_pipeline as pipeline

    stage = dict(pipeline.STAGES)[name]
    got = stage(spark, clashing_documents, sf_dir)
    rows = got.collect()
    if name == "packing":
        tokens = {r.doc_id: r.doc_tokens for r in rows}
        assert tokens[1] == tokens[2] == tokens[3] == 1 and tokens[4] > 1  # the end alone, where there is no word
    else:
        assert got.columns == clashing_documents.columns
        assert rows and all(getattr(r, c) == f"own {c}" for r in rows for c in clashing_documents.columns[5:])
    assert stage(spark, clashing_documents.limit(0), sf_dir).count() == 0


def test_texts_not_ids_make_near_copies(spark, sf_dir):
    import corpus_pipeline as pipeline

    rows = [
        (1, "one text of its own", "en"),
        (1, "and quite another text under this id", "en"),
        (2, "One text of  its own", "en"),
        (3, "and quite another text under this id", "de"),
        (None, "a text that has no id", "en"),
        (None, "a text that has no id", "de"),
        (None, "one text of its own", "en"),
        (4, "", "en"),
        (4, None, "en"),
        (5, "", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    alone = dict(pipeline.STAGES)["near_copies"](spark, docs, sf_dir)
    assert alone.columns == docs.columns
    got = [(r.doc_id, (r.text or "")[:7]) for r in alone.collect()]
    assert sorted(got, key=str) == [(1, "and qui"), (1, "one tex"), (4, ""), (5, ""), (None, "a text ")]


def test_every_operator_is_a_query():
    assert list(dict.fromkeys(name.split("_")[0] for name in QUERIES)) == [f"op{n}" for n in range(1, 14)]
