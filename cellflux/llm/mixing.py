"""Sources mixed to target weights by iterative proportional fitting (operator 7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflux.llm.common import WORD, materialise

DIMENSIONS = ("source", "lang", "topic")
TEMPER = 0.85  # targets of the query: token shares to this power
BUDGET = 1.0  # tokens of the sample, as a share of all tokens
COPIES = 4.0  # no document is expected more often than this
ITERATIONS = 10
SEED = "mix-1"
# A cell table up to this many rows is raked in one task and broadcast; a larger one by joins, over salts.
BROADCAST_CELLS = 100_000
SALTS = 16


def word_count(text: str | Column) -> Column:
    """Words of a text; a missing one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def form_topic(text: str | Column) -> Column:
    """What a text is about as far as its form shows: `documents` has no topic column.

    Tables (cells between bars), notices (licences), lists (many short lines), prose.
    """
    text = F.coalesce(text, F.lit(""))
    bars = F.regexp_count(text, F.lit(r" [|] "))
    lines = F.regexp_count(text, F.lit(r"\n")) + 1
    return (
        F.when(bars >= 5, "table")
        .when(F.contains(text, F.lit("icense")), "notice")
        .when(F.length(text) < 80 * lines, "list")
        .otherwise("prose")
    )


def tempered_shares(cells: DataFrame, column: str, power: float = TEMPER) -> DataFrame:
    """Target shares of one margin: its token totals to a power, scaled to 1."""
    sums = cells.groupBy(column).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))
    return sums.withColumn("share", F.col("share") / F.sum("share").over(Window.partitionBy()))


def reachable(cells: DataFrame, column: str, shares: DataFrame, tokens: float, copies: float) -> DataFrame:
    """Tokens that each value of a margin is to have: its share of `tokens`, or all it can have if that is less.

    What some values cannot take goes to the others in proportion to their shares: each gets the smaller of its bound
    (`copies` times its tokens) and its share times one factor. By rising ratio of bound and share, the factor
    is the largest that leaves the values before at their bounds, which running sums find. One number per value
    is sorted in one task.
    """
    bounds = cells.groupBy(column).agg((F.sum("tokens") * F.lit(copies)).alias("bound"))
    share = shares.select(F.col(column).alias("_value"), F.col("share").cast("double").alias("share"))
    known = bounds.join(share, bounds[column].eqNullSafe(share["_value"]), "left").drop("_value")
    known = known.withColumn("share", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0)))
    order = Window.orderBy(F.when(F.col("share") > 0, F.col("bound") / F.col("share")), column)
    wanted = known.filter("share > 0")
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("share").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    factors = wanted.select(((F.lit(tokens) - before) / rest).alias("factor"))
    factor = factors.agg(F.max("factor")).first()[0]
    target = F.least("bound", F.col("share") * F.lit(float(factor or 0.0)))
    return known.select(column, target.alias("target"))


def token_cells(documents: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Tokens per combination of the dimensions, added up in each task before the shuffle."""
    return documents.groupBy(*dimensions).agg(F.sum("tokens").alias("tokens"))


def raked(
    cells: DataFrame,
    shares: Mapping[str, DataFrame],
    budget: float = BUDGET,
    copies: float = COPIES,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """Cells with `weight`, the tokens that the sample is to have of them, and `expected`, that per token of theirs.

    `shares`: per dimension a table (value, share); a value without a share gets none of the weight. All weights
    add up to `budget` times the tokens of all cells, as near to the margins as the bound allows: no cell is
    expected more than `copies` times. Each step scales the weights of one dimension's groups to
    that dimension's targets (see `reachable`) and cuts them at their bounds; what was cut off, the next rounds deal to
    the other cells. So a rare cell that wants more than it can have takes nothing from the others. Cells without
    tokens are expected once (there is nothing to weigh), and so is everything where nothing has tokens.

    Cells are sums, and usually few (sources x languages x topics): then they stand in one partition, so that no step
    shuffles. Beyond `BROADCAST_CELLS` each step adds up its groups where the cells are and joins the sums.
    """
    cells = materialise(cells, "mix-cells")
    facts = cells.agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("cells")).first()
    if not facts.tokens:
        return cells.withColumns({"weight": F.col("tokens").cast("double"), "expected": F.lit(1.0)})
    few = facts.cells <= BROADCAST_CELLS
    weighed = cells
    for column, share in shares.items():
        target = reachable(cells, column, share, float(budget * facts.tokens), copies)
        target = target.select(F.col(column).alias("_value"), F.col("target").alias(f"_{column}"))
        weighed = weighed.join(target, weighed[column].eqNullSafe(target["_value"]), "left").drop("_value")
    weighed = weighed.withColumn("weight", F.col("tokens").cast("double"))
    if few:
        weighed = materialise(weighed, "mix-start").coalesce(1)
    bound = F.col("tokens") * F.lit(copies)
    for _ in range(iterations):
        if not few:
            weighed = materialise(weighed, "mix-round")
        for column in shares:
            if few:
                group = F.sum("weight").over(Window.partitionBy(column))
                weighed = weighed.withColumn("_group", group)
            else:
                sums = weighed.groupBy(column).agg(F.sum("weight").alias("_group"))
                sums = sums.withColumnRenamed(column, "_value")
                weighed = weighed.drop("_group").join(sums, weighed[column].eqNullSafe(sums["_value"])).drop("_value")
            scaled = F.least(bound, F.col("weight") * F.col(f"_{column}") / F.col("_group"))
            weighed = weighed.withColumn("weight", F.when(F.col("_group") > 0, scaled).otherwise(0.0))
    expected = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0)
    return weighed.withColumn("expected", expected).drop("_group", *[f"_{c}" for c in shares])


def margin_gaps(weights: DataFrame, shares: Mapping[str, DataFrame]) -> DataFrame:
    """How far raked weights are from the shares asked for: dimension, value, share, reached, per margin."""
    out = None
    for column, share in shares.items():
        sums = weights.groupBy(column).agg(F.sum("weight").alias("weight"))
        total = F.sum("weight").over(Window.partitionBy())
        reached = sums.select(F.col(column).alias("value"), (F.col("weight") / total).alias("reached"))
        wanted = share.select(F.col(column).alias("_value"), "share")
        both = reached.join(wanted, F.col("value").eqNullSafe(F.col("_value")), "left")
        rows = both.select(F.lit(column).alias("dimension"), F.col("value").cast("string"), "share", "reached")
        out = rows if out is None else out.unionByName(rows)
    return out


def uniform(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed only; a missing id has one too."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def _with_weights(facts: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with the `weight` and `expected` of their cell.

    A small cell table is broadcast, after its rows have been counted. A larger one is repeated
    over salts, so that a cell with a third of the documents is dealt to as many tasks.
    """
    cells = materialise(cells.select(*DIMENSIONS, "weight", "expected"), "mix-weights")
    renamed = cells.withColumnsRenamed({c: f"_{c}" for c in DIMENSIONS})
    on = F.lit(True)
    for c in DIMENSIONS:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    if renamed.count() <= BROADCAST_CELLS:
        renamed = F.broadcast(renamed)
    else:
        renamed = renamed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = on & (F.pmod(F.xxhash64("row"), F.lit(SALTS)) == F.col("_salt"))
    return facts.join(renamed, on).drop(*[f"_{c}" for c in DIMENSIONS], "_salt")


def dealt(
    documents: DataFrame,
    power: float = TEMPER,
    budget: float = BUDGET,
    copies: float = COPIES,
    iterations: int = ITERATIONS,
    seed: str = SEED,
) -> DataFrame:
    """Every document as `row`, a struct of all its columns, with source, lang, topic, tokens, weight, expected, taken.

    `taken` is how often the sample has the document: `expected` rounded up or down, by a hash of the id, so that it
    does not depend on partitions and repeats exactly. `documents` needs doc_id, text, lang and source; as columns of
    a struct, its others clash with nothing, whatever their names. Missing sources and languages are groups of their
    own; rows with equal doc_id are taken equally often if they share a cell. An empty table gives none.
    """
    facts = documents.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        form_topic("text").alias("topic"),
        word_count("text").alias("tokens"),
    )
    cells = materialise(token_cells(facts), "mix-sums")
    shares = {c: tempered_shares(cells, c, power) for c in DIMENSIONS}
    weights = raked(cells, shares, budget, copies, iterations)
    rows = _with_weights(facts, weights)
    whole = F.floor("expected")
    more = F.when(uniform("row.doc_id", seed) < F.col("expected") - whole, 1).otherwise(0)
    return rows.withColumn("taken", (whole + more).cast("int"))


def mixing_sql(
    power: float = TEMPER,
    budget: float = BUDGET,
    copies: float = COPIES,
    iterations: int = ITERATIONS,
    seed: str = SEED,
) -> str:
    """The same for DuckDB; each raking step is a common table expression."""
    steps, last = [], "w0"
    number = 0
    for _ in range(iterations):
        for c in DIMENSIONS:
            number += 1
            steps.append(
                f"w{number} AS (SELECT * REPLACE (CASE WHEN g > 0 THEN least(tokens * {copies}::DOUBLE, weight * t_{c} / g) "
                "ELSE 0 END AS weight) "
                f"FROM (SELECT * EXCLUDE (g), sum(weight) OVER (PARTITION BY {c}) AS g FROM {last}))"
            )
            last = f"w{number}"
    shares = ", ".join(
        f"""s_{c} AS (SELECT {c}, sum(tokens) * {copies}::DOUBLE AS bound,
            pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS share FROM cells GROUP BY {c}),
        f_{c} AS (SELECT max(({budget}::DOUBLE * total - ahead) / rest) AS factor FROM (
            SELECT coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
                sum(share) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
            FROM s_{c} WHERE share > 0 WINDOW o AS (ORDER BY bound / share, {c} NULLS FIRST)), totals),
        t_{c} AS (SELECT {c}, least(bound, share * factor) AS t_{c} FROM s_{c}, f_{c})"""
        for c in DIMENSIONS
    )
    joins = " ".join(f"JOIN t_{c} ON cells.{c} IS NOT DISTINCT FROM t_{c}.{c}" for c in DIMENSIONS)
    return f"""
    WITH docs AS (
        SELECT doc_id, source, lang,
            CASE WHEN len(regexp_extract_all(t, ' [|] ')) >= 5 THEN 'table'
                 WHEN contains(t, 'icense') THEN 'notice'
                 WHEN length(t) < 80 * (len(regexp_extract_all(t, '\\n')) + 1) THEN 'list'
                 ELSE 'prose' END AS topic,
            len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS tokens
        FROM (SELECT *, coalesce(text, '') AS t FROM documents)
    ),
    cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM docs GROUP BY ALL),
    totals AS (SELECT sum(tokens)::DOUBLE AS total FROM cells),
    {shares},
    w0 AS (SELECT cells.*, t_source, t_lang, t_topic, cells.tokens::DOUBLE AS weight, 0.0::DOUBLE AS g FROM cells {joins}),
    {", ".join(steps)},
    cell AS (SELECT source, lang, topic, weight, CASE WHEN tokens > 0 THEN weight / tokens ELSE 1.0 END AS expected
        FROM {last})
    SELECT doc_id, docs.source, docs.lang, docs.topic, docs.tokens::BIGINT AS tokens,
        round(weight, 6) AS weight, round(expected, 8) AS expected,
        (floor(expected) + CASE WHEN
            ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / {float(16**12)}
                < expected - floor(expected) THEN 1 ELSE 0 END)::INTEGER AS taken
    FROM docs JOIN cell ON docs.source IS NOT DISTINCT FROM cell.source
        AND docs.lang IS NOT DISTINCT FROM cell.lang AND docs.topic = cell.topic
    """
