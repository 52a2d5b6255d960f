"""Ranked lexical search by bags of words that are scored once.

1. Items are taken in blocks. The terms of a block's items are its vocabulary, and each document is cut down to its bag:
   how often it holds each of these terms, and how many terms it has in all.
2. Documents whose bags and length norms are equal get equal scores from every item. They are brought together by a hash and
   told apart by the whole bag and norm; such a class is scored once, however many copies it has.
3. Each task scores its classes against the items of the block and keeps the best for each item. Of a class only the
   documents of the smallest ids can be among an item's best, so that many of its members are enough.

All scores are whole numbers; equal scores are ordered by ascending id, a NULL id first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.llm.common import PIECE, text_or_empty
from hydroflow.session import stored

#: Documents that an item gets at most.
BEST = 20
#: Items of a block, and the terms that end it (its last item may have more).
BLOCK_ITEMS = 1024
BLOCK_TERMS = 1 << 18
#: Classes that one task scores, and scores that it holds at once.
TASK_CLASSES = 1 << 15
HELD_SCORES = 1 << 21

# Fixed values of the ranking.
SCALE, UNIT, SHORT, SLOPE, NORM = 1000, 1_000_000_000, 75, 25, 12

_KEPT = np.array([c if chr(c).isalnum() else 32 for c in range(128)] + list(range(128, 256)), np.uint8)
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in _KEPT.tolist())


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in blocks: runs of ASCII letters and digits and of all other characters, A-Z lowered."""
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and _FOLD[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_FOLD).split()
        at = end


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Blocks of items (place, terms with repeats), read one after the other."""
    block, held = [], 0
    for row in items.toLocalIterator():
        bag: Counter = Counter()
        for terms in terms_of(bytes(row["body"])):
            bag.update(terms)
        block.append((row["place"], bag))
        held += len(bag)
        if len(block) >= BLOCK_ITEMS or held >= BLOCK_TERMS:
            yield block
            block, held = [], 0
    if block:
        yield block


_BAG = "doc_id long, n long, terms array<int>, counts array<int>"


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row for each document that has a term: its number of terms, and its counts of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids, totals, terms, counts, ends = [], [], [], [], [0]
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body"), strict=True):
                bag, n = Counter(), 0
                for words in terms_of(body.as_py()):
                    n += len(words)
                    bag.update(map(number, words))
                bag.pop(None, None)
                if n:
                    held = sorted(bag.items())
                    ids.append(doc_id)
                    totals.append(n)
                    terms += [t for t, _ in held]
                    counts += [c for _, c in held]
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(totals, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(count, _BAG)


def _weights(bags: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """The weight of every term of the vocabulary; zero for one that no document has."""
    held = bags.select(F.explode("terms").alias("term")).groupBy("term").count()
    rare = (2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("count") + 1).cast("double")
    weights = np.zeros(size, np.int64)
    # One row per term of the vocabulary at most.
    for row in held.select("term", F.floor(F.lit(float(SCALE)) * F.ln(rare)).cast("long").alias("weight")).toLocalIterator():
        weights[row["term"]] = row["weight"]
    return weights


def _score(block: list[tuple[int, Counter]], vocabulary: dict[bytes, int], weights: np.ndarray, best: int):
    """A task's best classes for every item of the block."""
    asked: dict[int, list[tuple[int, int]]] = {}
    for at, (_, bag) in enumerate(block):
        for term, times in bag.items():
            if weights[vocabulary[term]]:
                asked.setdefault(vocabulary[term], []).append((at, times))
    wanted = {t: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for t, rows in asked.items()}
    places, batch_rows = np.array([p for p, _ in block], np.int64), max(1, HELD_SCORES // len(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # score, smallest id and number of the classes kept for each item, best first
        kept = [(np.empty(0, np.int64),) * 3 for _ in block]
        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                part = whole.slice(start, batch_rows)
                first, number, norm = (part.column(c).to_numpy(zero_copy_only=False) for c in ("first", "class", "norm"))
                lists = part.column("terms")
                sizes = np.diff(lists.offsets.to_numpy())
                terms, counts = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
                row = np.repeat(np.arange(len(sizes)), sizes)
                worth = weights[terms] * ((UNIT * counts) // (SCALE * counts + NORM * norm[row]))
                order = np.argsort(terms, kind="stable")
                cuts = np.flatnonzero(np.diff(terms[order])) + 1
                scores = np.zeros((len(block), part.num_rows), np.int64)
                for own in np.split(order, cuts) if len(order) else ():
                    if (rows := wanted.get(int(terms[own[0]]))) is not None:
                        scores[rows[0][:, None], row[own][None, :]] += rows[1][:, None] * worth[own][None, :]
                for at, mine in enumerate(scores):
                    old = kept[at]
                    at_least = old[0][-1] if len(old[0]) == best else 1
                    found = np.flatnonzero(mine >= at_least)
                    if len(found):
                        both = [np.concatenate([o, x[found]]) for o, x in zip(old, (mine, first, number), strict=True)]
                        top = np.lexsort((both[2], both[1], -both[0]))[:best]
                        kept[at] = tuple(x[top] for x in both)
        sizes = [len(k[0]) for k in kept]
        flat = [np.concatenate([k[i] for k in kept]) for i in (0, 1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(places, sizes), *flat)], names=["place", "score", "first", "class"])

    return run


def _numbered(rows: DataFrame, by: list[str], order: list, most: int, into: str) -> DataFrame:
    """The first rows of each group with their number; each task passes on no more than that many of a group."""
    return rows.withColumn(into, F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col(into) <= most)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    best: int = BEST,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the documents with the highest scores above zero for every item, ``best`` at most.

    Every row of ``docs`` is a document and every row of ``items`` a question of its own, repeated rows too: rows of one
    item id have ranks of their own. NULL texts have no terms; a document or item without terms is in no result. Equal
    scores are ordered by id, a NULL id first; rows of one id and equal scores are interchangeable. Ids are whole numbers.
    Other columns are not looked at. No documents or no items: no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), text_or_empty(item_text).cast("binary").alias("body"))
    asked = stored(asked.withColumn("place", F.monotonically_increasing_id()), "search-items")
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).cast("binary").alias("body"))
    out = None
    for block in _blocks(asked.select("place", "body")):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(bag for _, bag in block))))}
        bags = stored(_bags(bodies, vocabulary), "search-bags")
        n_docs, n_terms = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs or not vocabulary:
            continue
        found = _best_of_block(bags, block, vocabulary, n_docs, n_terms, best)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = items.select(F.col(item_id).alias("item_id")).schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out.join(asked.select("place", "item_id"), "place").select("item_id", "rank", "doc_id", "score")


def _best_of_block(
    bags: DataFrame, block: list[tuple[int, Counter]], vocabulary: dict[bytes, int], n_docs: int, n_terms: int, best: int
) -> DataFrame:
    weights = _weights(bags, n_docs, len(vocabulary))
    norm = F.lit(SHORT).cast("long") + F.expr(f"({SLOPE}L * n * {n_docs}L) div {n_terms}L")
    bagged = bags.filter(F.size("terms") > 0).withColumn("norm", norm)
    bagged = bagged.withColumn("bag_hash", F.xxhash64("norm", "terms", "counts"))
    # The hash deals the groups and is compared first; the whole bag decides. Copies fold before the shuffle.
    same = ["bag_hash", "norm", "terms", "counts"]
    smallest = F.min(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    classes = bagged.groupBy(*same).agg(smallest.alias("first"), F.count(F.lit(1)).alias("members"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "search-classes")
    tasks = max(1, -(-classes.count() // TASK_CLASSES))
    scored = (
        classes.select("class", "first", "norm", "terms", "counts")
        .repartition(tasks)
        .mapInArrow(_score(block, vocabulary, weights, best), "place long, score long, first long, class long")
    )
    ranked = _numbered(scored, ["place"], [F.desc("score"), "first", "class"], best, "at")
    # At most ``best`` classes for each item of a block.
    top = stored(ranked.select("place", "score", "class"), "search-best")
    needed = stored(classes.join(F.broadcast(top.select("class").distinct()), "class", "left_semi").select("class", *same), "search-top")
    # Two numbers for each class that is needed clear most documents; of the rest the first of every bag are enough.
    near = bagged.join(F.broadcast(needed.select("bag_hash", "norm").distinct()), ["bag_hash", "norm"], "left_semi")
    members = _numbered(near.select("doc_id", *same), same, [F.asc_nulls_first("doc_id")], best, "nth")
    members = members.join(needed, same).select("class", "doc_id")
    placed = _numbered(top.join(members, "class"), ["place"], [F.desc("score"), F.asc_nulls_first("doc_id")], best, "rank")
    return placed.select("place", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
