"""SimHash fingerprints and the search within a Hamming radius (operator 3)."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflux.llm.common import WORD, ascii_lower, materialise

BITS = 128
ROWS_PER_RANGE = 2_500
MAX_RANGES = 10_000
NEAR_BITS = 3  # radius of the search over all fingerprints
BROADCAST_PRINTS = 500_000
SALTS = 16
_LANE = 32  # two votes share a long; each side counts up to 2^31 terms


def _votes(hashes: list[Column]) -> list[Column]:
    """Per pair of bits, the number of terms that set each of them, two counts to a long."""
    sums = []
    for word in hashes:
        for bit in range(_LANE):
            low = F.shiftrightunsigned(word, bit).bitwiseAND(F.lit(1).cast("long"))
            high = F.shiftrightunsigned(word, bit + _LANE).bitwiseAND(F.lit(1).cast("long"))
            sums.append(F.sum(low + F.shiftleft(high, _LANE)))
    return sums


def fingerprints(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """One fingerprint per row key: `BITS` bits as lower-case hex, `fingerprint`.

    Terms are pairs of neighbouring words, each weighted by how often it occurs. Every term votes on every bit
    with the bits of its hash, for or against; a bit is set if more than half the votes are
    for it. A text without words has all bits clear. The votes of a row are added up in its own
    task, so that what is dealt out is a row of counts, not terms.
    """
    split = rows.select(*key, F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})")).alias("_words"))
    after = F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(1)))
    pairs = F.when(
        F.size("_words") > 0, F.arrays_zip(F.col("_words").alias("a"), after.alias("b"))
    )
    opened = split.select(*key, F.posexplode_outer(pairs).alias("_place", "_pair"), F.size("_words").alias("_n"))
    # The last word opens no pair, unless it is the only one.
    opened = opened.filter((F.col("_n") <= 1) | (F.col("_place") < F.col("_n") - 1))
    hashes = [
        F.when(F.col("_pair").isNotNull(), F.xxhash64(F.lit(n), F.col("_pair.a"), F.coalesce("_pair.b", F.lit(""))))
        for n in range(BITS // 64)
    ]
    hashed = opened.select(*key, *[h.alias(f"_h{n}") for n, h in enumerate(hashes)])
    counts = [c.alias(f"_v{n}") for n, c in enumerate(_votes([F.col(f"_h{n}") for n in range(BITS // 64)]))]
    voted = hashed.groupBy(*key).agg(F.count("_h0").alias("_terms"), *counts)
    parts = []
    for word in range(BITS // 64):
        bits = F.lit(0).cast("long")
        for bit in range(_LANE):
            both = F.col(f"_v{word * _LANE + bit}")
            low = both.bitwiseAND(F.lit(2**_LANE - 1))
            high = F.shiftrightunsigned(both, _LANE)
            for count, place in ((low, bit), (high, bit + _LANE)):
                one = F.when(count * 2 > F.col("_terms"), F.shiftleft(F.lit(1).cast("long"), place))
                bits = bits.bitwiseOR(F.coalesce(one, F.lit(0).cast("long")))
        parts.append(F.lpad(F.lower(F.hex(bits)), 16, "0"))
    return voted.select(*key, F.concat(*parts).alias("fingerprint"))


def _words_of(fingerprint: Column) -> list[Column]:
    """The fingerprint's 64-bit words; each is read in two halves, since `conv` is unsigned."""
    out = []
    for word in range(BITS // 64):
        halves = [
            F.conv(F.substring(fingerprint, 16 * word + 8 * half + 1, 8), 16, 10).cast("long")
            for half in (0, 1)
        ]
        out.append(F.shiftleft(halves[0], 32).bitwiseOR(halves[1]))
    return out


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    differ = [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(_words_of(a), _words_of(b), strict=True)]
    total = differ[0]
    for one in differ[1:]:
        total = total + one
    return total


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return F.lit(1.0) - hamming(a, b) / F.lit(float(BITS))


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """All pairs of different fingerprints at most `radius` bits apart: query, found, distance.

    Both tables hold a column `fingerprint`; each fingerprint is taken once, so copies of a text cost
    nothing and are found through their common fingerprint. The bits are cut into `blocks` blocks. Two
    fingerprints within the radius agree in at least `blocks - radius` of them, so a table is made for
    every choice of that many blocks, permuted to the front as its key, and each pair that meets in a
    table is verified. With two blocks more than the radius, as here, a key has `2/(radius+2)` of the
    bits. Missing fingerprints match nothing.
    """
    blocks = blocks or radius + 2
    digits = BITS // 4
    if not 0 <= radius < blocks <= digits:
        raise ValueError("radius must be below the number of blocks, and that at most one per hex digit")
    edges = [digits * i // blocks for i in range(blocks + 1)]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        once = df.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct()
        keys = [
            F.concat(
                F.lit(f"{n}:"),
                *[F.substring(F.col(name), edges[b] + 1, edges[b + 1] - edges[b]) for b in chosen],
            )
            for n, chosen in enumerate(combinations(range(blocks), blocks - radius))
        ]
        return once.select(name, F.explode(F.array(*keys)).alias("_key"))

    met = keyed(queries, "query").join(keyed(prints, "found"), "_key")
    distance = hamming(F.col("query"), F.col("found"))
    near = met.filter(F.col("query") != F.col("found")).withColumn("distance", distance.cast("int"))
    return near.filter(F.col("distance") <= radius).select("query", "found", "distance").distinct()


def near_counts(prints: DataFrame, radius: int) -> DataFrame:
    """`near`: for each row of `prints` (a column `fingerprint` among others), how many other fingerprints are in the radius.

    Fingerprints are searched once each, whatever number of rows has them; the few that have a neighbour are broadcast if
    they are few, and joined over salts otherwise, since one fingerprint may be that of very many rows.
    """
    once = materialise(prints.select("fingerprint").distinct(), "distinct-prints")
    pairs = near_fingerprints(once, once, radius)
    counts = pairs.groupBy(F.col("query").alias("_print")).agg(F.count(F.lit(1)).alias("near"))
    counts = materialise(counts, "near-counts")
    same = F.col("fingerprint") == F.col("_print")
    if counts.count() <= BROADCAST_PRINTS:
        joined = prints.join(F.broadcast(counts), same, "left")
    else:
        salted = counts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = prints.withColumn("_deal", F.floor(F.rand(0) * SALTS).cast("int"))
        joined = dealt.join(salted, same & (F.col("_deal") == F.col("_salt")), "left").drop("_deal", "_salt")
    return joined.withColumn("near", F.coalesce("near", F.lit(0)).cast("long")).drop("_print")


class _Ranges:
    """Ranges of rows in the order of (doc_id, hash of the text), of about equal size.

    `quantiles` are those of the ids. An id that is several of them has as many ranges of its own, by hash; a range
    of ids is cut into `parts` by their size. Missing ids come first, in `nameless` ranges by hash.
    """

    def __init__(self, quantiles: list[int], low: int, high: int, nameless: int, parts: int):
        times: dict[int, int] = {}
        for q in quantiles:
            times[q] = times.get(q, 0) + 1
        hot = {q: n for q, n in times.items() if n > 1}
        starts = sorted({low, *times, *(q + 1 for q in hot if q < high)})
        ends = [*starts[1:], high + 1]
        self.nameless = max(1, nameless)
        self.starts, self.widths = starts, [b - a for a, b in zip(starts, ends, strict=True)]
        self.parts = [hot[a] if a in hot else min(parts, w) for a, w in zip(starts, self.widths, strict=True)]
        self.first = [self.nameless + sum(self.parts[:i]) for i in range(len(starts))]

    def column(self) -> Column:
        """The range of a row with `doc_id` and `_hash`, found among the starts in two steps."""
        step = max(1, math.isqrt(len(self.starts)))
        wide = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
        coarse, fine = wide(self.starts[::step]), wide(self.starts)
        top = F.size(F.filter(coarse, lambda b: b <= F.col("doc_id"))) - 1
        near = F.slice(fine, top * step + 1, step)
        at = top * step + F.size(F.filter(near, lambda b: b <= F.col("doc_id"))) - 1
        start, width = F.get(fine, at), F.get(wide(self.widths), at).cast("double")
        parts, first = F.get(wide(self.parts), at), F.get(wide(self.first), at)
        share = F.col("_hash").cast("double") / 2.0**64 + 0.5
        within = F.when(width == 1, share).otherwise((F.col("doc_id") - start) / width)
        part = F.least(F.floor(within * parts), parts - 1)
        nameless = F.least(F.floor(share * self.nameless), F.lit(self.nameless - 1))
        return F.when(F.col("doc_id").isNull(), nameless).otherwise(first + part).cast("int")


def with_next(documents: DataFrame) -> DataFrame:
    """Each document (`_range`, `_at`, doc_id, text) with the text of the next one, `next_text`.

    Documents are in the order of doc_id, missing ids first, equal ids by a hash of the text and then by the text; after
    the last comes the first. Rows are dealt to ranges of about equal size, whose bounds Spark's quantile sketch
    gives; the driver holds no more than `MAX_RANGES` of them, each of which is cut into parts where
    there are more rows. Very many rows of one id, or without id, have ranges of their own (equal texts under one id stay
    together). The first document of each range is added to the range before as a guest, so that a window within
    the range sees each row's next. Guests come last (`_guest`), and have no next text.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("named"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).first()
    wanted = max(1, math.ceil(facts.named / ROWS_PER_RANGE))
    ranges = min(MAX_RANGES, wanted)
    quantiles: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        quantiles = rows.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or []
    low, high = (facts.low, facts.high) if facts.named else (0, 0)
    nameless = math.ceil((facts.rows - facts.named) / ROWS_PER_RANGE)
    dealt = _Ranges(quantiles, low, high, nameless, math.ceil(wanted / ranges))
    ranged = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_range", dealt.column())

    # The first row of each range; missing ids are first of all.
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "_hash")
    low = ranged.groupBy("_range").agg(F.min(place).alias("_low"))
    ring = Window.partitionBy().orderBy("_range")
    before = F.coalesce(
        F.lag("_range").over(ring),
        F.max("_range").over(Window.partitionBy()),
    )
    low = low.select(F.col("_range").alias("_own"), "_low", before.alias("_before"))
    at_front = (F.col("_range") == F.col("_own")) & place.eqNullSafe(F.col("_low"))
    firsts = ranged.join(F.broadcast(low), at_front)
    firsts = firsts.groupBy(F.col("_before").alias("_range"), "_own").agg(
        F.first("doc_id").alias("doc_id"), F.min("text").alias("text"), F.first("_hash").alias("_hash")
    )
    guests = firsts.select("doc_id", "text", "_hash", "_range", F.lit(True).alias("_guest"))
    both = ranged.withColumn("_guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("_range").orderBy("_guest", F.asc_nulls_first("doc_id"), "_hash", "text")
    return both.withColumns(
        {"_at": F.row_number().over(order), "next_text": F.lead("text").over(order)}
    ).drop("_hash")


def edited_pairs(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's text.

    The edited text is the text without its last quarter (`floor(n/4)` code points), followed by as many
    code points of the next document, or all it has. Returned per row: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, next_fingerprint. A missing text is an empty one; rows with equal doc_id stay
    apart; a table of one row is its own next; an empty table gives no rows; other columns are ignored.

    Text is dealt once, by id range; all later steps keep that partitioning.
    """
    pairs = with_next(documents)
    length = F.length("text")
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), length - cut), F.col("next_text").substr(F.lit(1), cut)
    )
    pairs = pairs.withColumn("edited", edited)
    key = ["_range", "_at", "_edited"]
    forms = pairs.select(
        "_range",
        "_at",
        F.inline(
            F.when(
                F.col("next_text").isNull(),
                F.array(F.struct(F.lit(0).alias("_edited"), F.col("text").alias("form"))),
            ).otherwise(
                F.array(
                    F.struct(F.lit(0).alias("_edited"), F.col("text").alias("form")),
                    F.struct(F.lit(1).alias("_edited"), F.col("edited").alias("form")),
                )
            )
        ),
    )
    prints = fingerprints(forms, key, "form").groupBy("_range", "_at").agg(
        F.max(F.when(F.col("_edited") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_edited") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    facts = pairs.select(
        "_range",
        "_at",
        "_guest",
        "doc_id",
        length.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    joined = facts.join(prints, ["_range", "_at"])
    order = Window.partitionBy("_range").orderBy("_at")
    return (
        joined.withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .filter(~F.col("_guest"))
        .drop("_range", "_at", "_guest")
    )
