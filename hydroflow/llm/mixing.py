"""Mixing sources to target weights by temperature.

Each source has a share p of all tokens; its weight is p ** a, normalised. The exponent a is found by bisection, many
points at a time in one aggregation over the per-source totals, so the sources are never gathered: the weights reach
the wanted share of the largest possible entropy, and where that would repeat a small source more often than allowed,
a is raised until it does not.

The weights are realised in blocks. A source's documents are dealt by hash into blocks of about ``block_tokens`` tokens,
a large source into many; each pass over a source puts its blocks into an order of its own and takes them until the
source's budget of tokens is spent; of the block where it ends, documents are taken in hash order. What a document
needs to know is one row per source, so texts are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroflow.llm.common import fresh, text_or_empty
from hydroflow.session import stored

SEED = 17
#: Share of the largest possible entropy that the mix has, passes over one source, and tokens of a block.
ENTROPY_SHARE, MAX_PASSES, BLOCK_TOKENS = 0.95, 4.0, 1_000_000
#: Points of the bisection that one aggregation looks at, and how many times it narrows them.
POINTS, ROUNDS = 32, 6


def count_tokens(text: Column) -> Column:
    """Words between ASCII blanks; none in a NULL text."""
    plain = F.trim(F.translate(text_or_empty(text), "\t\n\x0b\x0c\r", "     "))
    return F.when(plain == "", 0).otherwise(F.size(F.split(plain, " +"))).cast("long")


def _at_points(sources: DataFrame, low: float, high: float, budget: float) -> list:
    """Exponent, entropy in bits and most passes for evenly spaced exponents, in one aggregation per quantity."""
    step = (high - low) / POINTS
    points = F.explode(F.array(*[F.lit(low + step * i) for i in range(POINTS + 1)])).alias("a")
    powers = sources.select("share", "tokens", points).withColumn("w", F.pow("share", F.col("a")))
    # H = log2 Z - sum(w log2 w) / Z; most passes = budget / Z * max(w / tokens).
    z = F.sum("w")
    rows = powers.groupBy("a").agg(
        (F.log2(z) - F.sum(F.col("w") * F.log2("w")) / z).alias("entropy"),
        (F.lit(float(budget)) / z * F.max(F.col("w") / F.col("tokens"))).alias("passes"),
    )
    return sorted(rows.collect(), key=lambda r: r["a"])


def _first(sources: DataFrame, budget: float, holds) -> float:
    """The largest exponent in [0, 1] up to which ``holds`` is true of all looked-at points, or 0."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = _at_points(sources, low, high, budget)
        if holds(points[-1]):
            return high
        if not holds(points[0]):
            return low
        at = max(i for i, p in enumerate(points) if holds(p))
        low, high = points[at]["a"], points[at + 1]["a"]
    return low


def temperature(
    sources: DataFrame, budget: float, entropy_share: float = ENTROPY_SHARE, max_passes: float = MAX_PASSES
) -> float:
    """The exponent: the largest whose entropy reaches the target, or the smallest that keeps to the passes.

    ``sources`` is a stored table with tokens (positive) and share. Entropy and passes both fall as the exponent
    rises to 1, where the mix is the corpus as it is.
    """
    n = sources.count()
    if n < 2:
        return 1.0
    target = entropy_share * math.log2(n)
    wanted = _first(sources, budget, lambda p: p["entropy"] >= target)
    ends = _at_points(sources, wanted, 1.0, budget)
    if ends[0]["passes"] <= max_passes:
        return round(wanted, 6)
    too_many = _first(sources, budget, lambda p: p["passes"] > max_passes)
    return round(min(1.0, too_many + 1e-6), 6)


def _place(block: Column, nth_pass: Column, seed: int) -> Column:
    """The rank of a block in a pass: each pass is a permutation of its own."""
    return F.xxhash64(block, nth_pass, F.lit(seed))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    entropy_share: float = ENTROPY_SHARE,
    max_passes: float = MAX_PASSES,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mix, one row for each pass that takes them, with struct ``mixed``: pass (from 0), block,
    place (the rank of the block in its pass), and the weight and exponent of its source.

    ``budget`` is the number of tokens of the mix, that of the corpus if not given. Every source gets its weight of it
    to within one document: whole passes, and a last one that ends where the budget is met; the document that
    passes the end is the last one taken. NULL is a source of its own. Sources without a token have no weight and
    are left out, as are their documents; NULL and empty texts of other sources go with their block. Rows with equal
    id and text are taken together. A column already called ``mixed`` makes the new one ``_mixed``. No documents
    give no rows.
    """
    body = text_or_empty(text)
    rows = stored(
        docs.select(
            F.col(source).alias("source"),
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(body).alias("k_hash"),
            count_tokens(F.col(text)).alias("tokens"),
        ),
        "token-counts",
    )
    # Documents count towards the size of a block too, so that empty ones do not pile up in it.
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter("tokens > 0")
    totals = stored(totals, "source-tokens")
    all_tokens = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = stored(totals.withColumn("share", F.col("tokens") / F.lit(float(max(1, all_tokens)))), "shares")
    wanted = float(all_tokens if budget is None else budget)
    exponent = temperature(shares, wanted, entropy_share, max_passes)
    z = shares.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0] or 1.0
    plan = stored(
        shares.select(
            "source",
            F.col("tokens").alias("source_tokens"),
            (F.pow("share", F.lit(exponent)) / F.lit(z)).alias("weight"),
            F.ceil((F.col("tokens") + F.col("docs")) / F.lit(block_tokens)).cast("long").alias("blocks"),
        )
        .withColumn("quota", F.round(F.col("weight") * F.lit(wanted)).cast("long"))
        .withColumn("passes", F.ceil(F.col("quota") / F.col("source_tokens")).cast("long")),
        "mix-plan",
    )

    same = rows["source"].eqNullSafe(plan["source"])
    dealt = rows.join(plan.filter("passes > 0"), same).select(
        plan["source"].alias("source"),
        "doc_id",
        "k_hash",
        "tokens",
        (F.col("quota") - (F.col("passes") - 1) * F.col("source_tokens")).alias("in_last"),
        (F.col("passes") - 1).alias("last"),
        _block(F.col("doc_id"), F.col("k_hash"), F.col("blocks"), seed).alias("block"),
    )
    # Only the last pass ends inside its order: the blocks up to there, by a running sum over one row per block.
    sizes = dealt.groupBy("source", "block", "in_last", "last").agg(F.sum("tokens").alias("block_tokens"))
    placed = sizes.withColumn("place", _place(F.col("block"), F.col("last"), seed))
    order = Window.partitionBy("source").orderBy("place", "block")
    before = F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = placed.withColumn("left", F.col("in_last") - F.coalesce(before, F.lit(0))).filter("left > 0")
    final = Window.partitionBy("source").orderBy(F.desc("place"), F.desc("block"))
    ends = stored(
        begun.withColumn("nth", F.row_number().over(final)).filter("nth = 1").select("source", "place", "block", "left"),
        "mix-ends",
    )
    # Of the block where a source's budget ends: its documents in hash order until the budget is met. One such block
    # a source, of bounded size.
    meets = dealt["source"].eqNullSafe(ends["source"]) & (dealt["block"] == ends["block"])
    inner = dealt.join(ends, meets).select(ends["source"].alias("source"), "doc_id", "k_hash", "tokens", "left")
    each = inner.groupBy("source", "left", "doc_id", "k_hash").agg(F.sum("tokens").alias("tokens"))
    ranked = each.withColumn("turn", _turn(F.col("doc_id"), F.col("k_hash"), seed))
    by_turn = Window.partitionBy("source").orderBy("turn", "doc_id", "k_hash")
    earlier = F.coalesce(F.sum("tokens").over(by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = ranked.withColumn("earlier", earlier).filter(F.col("earlier") < F.col("left"))
    bounds = taken.groupBy(F.col("source").alias("b_source")).agg(F.max("turn").alias("last_turn"))
    final_row = ends.join(bounds, ends["source"].eqNullSafe(bounds["b_source"])).select(
        ends["source"].alias("e_source"), "place", "block", "last_turn"
    )
    # One row per source says all that a document needs to know.
    decided = stored(
        plan.join(final_row, plan["source"].eqNullSafe(final_row["e_source"])).select(
            "source", "weight", "blocks", "passes", "place", "block", "last_turn"
        ),
        "mix-decisions",
    )
    return _take(docs, decided, exponent, seed, doc_id, text, source)


def _block(key: Column, k_hash: Column, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, k_hash, F.lit(seed)), blocks)


def _turn(key: Column, k_hash: Column, seed: int) -> Column:
    return F.xxhash64(k_hash, key, F.lit(seed + 1))


def _take(
    docs: DataFrame, decided: DataFrame, exponent: float, seed: int, doc_id: str, text: str, source: str
) -> DataFrame:
    """Each document as often as its source's decision says; texts are only read."""
    name, of_source = fresh(docs, "mixed"), fresh(docs, "of_source")
    decided = decided.select(F.col("source").alias("d_source"), F.struct("*").alias(of_source))
    joined = docs.join(decided, docs[source].eqNullSafe(decided["d_source"])).drop(decided["d_source"])
    says = F.col(of_source)
    key, k_hash = docs[doc_id], F.xxhash64(text_or_empty(docs[text]))
    block, last = _block(key, k_hash, says["blocks"], seed), says["passes"] - 1
    place = _place(block, last, seed)
    inside = (place < says["place"]) | ((place == says["place"]) & (block < says["block"]))
    inside = inside | ((block == says["block"]) & (_turn(key, k_hash, seed) <= says["last_turn"]))
    passes = last + inside.cast("long")
    made = F.transform(
        F.when(passes > 0, F.sequence(F.lit(0).cast("long"), passes - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda p: F.struct(
            p.alias("pass"),
            block.alias("block"),
            _place(block, p, seed).alias("place"),
            says["weight"].alias("weight"),
            F.lit(exponent).alias("exponent"),
        ),
    )
    return joined.withColumn(name, F.explode(made)).drop(of_source)
