"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints within ``max_bits`` of each other agree on at least ``k`` of ``k + max_bits`` blocks of their bits. Each
choice of k blocks is a table, keyed by the bits of these blocks, and a pair meets in some table. Within a table and
key the fingerprints are sorted by their Gray rank, which puts neighbours that differ in few bits side by side, by
one range sort of the cluster that also splits large keys. Runs of the sorted rows are leaves of an index: what all
fingerprints of a run share is factored into its mask and pattern, runs of runs likewise. A search starts at the
upper nodes, adds up the differences on the bits that each node adds to its parent, and leaves a whole group as soon
as the sum is over ``max_bits``.

A run of the sort is at most CHUNK fingerprints. Runs of one key that ended up in several chunks are matched chunk by
chunk, after their headers (mask and pattern) have ruled out those that are too far apart. Each search returns a
spanning set of links, not all pairs, so a large group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import keep_one_of_each, text_or_empty, word_blocks
from hydroflow.llm.components import connected_components
from hydroflow.session import stored

SHINGLE_WORDS, MAX_BITS = 4, 4
SEED = 42
#: Fingerprints in one run of the sort, those of a leaf, and the average that the key width aims at.
CHUNK, FANOUT, KEY_ROWS = 4096, 16, 2048
#: Query fingerprints that walk an index together.
WALKERS = 256


def _bit_sums(shingles: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the XXH64 hashes of all word shingles, as a signed number; zero without a word."""
    total, sums, carry = 0, np.zeros(64, dtype=np.int64), []
    for block in word_blocks(text.encode("utf-8", "surrogatepass").lower()):
        words = carry + block
        if len(words) >= width:
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
            joined = b" ".join(words)
            starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
            stops = (ends[width - 1 :] - 1).tolist()
            sums += _bit_sums([joined[s:e] for s, e in zip(starts, stops, strict=True)])
            total += len(starts)
            carry = words[len(words) - width + 1 :]
        else:
            carry = words
    if not total:
        if not carry:
            return 0
        total, sums = 1, _bit_sums([b" ".join(carry)])
    return int.from_bytes(np.packbits(sums * 2 > total).tobytes(), "big", signed=True)


def fingerprints(text: Column, width: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def marks(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return marks(text_or_empty(text))


def as_hex(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def gray_rank(print_: Column) -> Column:
    """The place of a bit pattern in the Gray sequence, as a signed number of the same order."""
    rank = print_
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def key_masks(n: int, max_bits: int) -> list[int]:
    """The bits that key each table, as signed numbers: k of k + max_bits blocks, and no more of their bits than
    needed for about KEY_ROWS fingerprints a key. k grows until these bits suffice, so a key stays small for any n."""
    wanted = max(0, int(np.ceil(np.log2(max(1, n / KEY_ROWS)))))
    k = 1
    while k * (64 // (k + max_bits)) < wanted and k + max_bits < 16:
        k += 1
    edges = np.linspace(0, 64, k + max_bits + 1).astype(int)
    masks = []
    for chosen in combinations(range(k + max_bits), k):
        bits = [b for c in chosen for b in range(edges[c], edges[c + 1])]
        mask = sum(1 << b for b in bits[:wanted])
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


class GrayIndex:
    """Masks and patterns over the runs of Gray-sorted fingerprints; upper nodes hold what their runs share."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        ones, any_ = prints, prints
        while len(ones) > 1 or not self.levels:
            starts = np.arange(0, len(ones), FANOUT)
            ones, any_ = np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(any_, starts)
            self.levels.append((~(ones ^ any_), ones))
        self.header = (self.levels[-1][0][0], self.levels[-1][1][0])

    def within(self, queries: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, entry) of at most ``max_bits`` differences, by blocks of queries."""
        for first in range(0, len(queries), WALKERS):
            block = queries[first : first + WALKERS]
            q = np.arange(len(block))
            node, far = np.zeros(len(block), dtype=np.int64), np.zeros(len(block), dtype=np.int64)
            known = np.zeros(len(block), dtype=np.uint64)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                # Only the bits that a node adds to its parent are compared; the sum so far comes along.
                far = far + np.bitwise_count((block[q] ^ pattern[node]) & mask[node] & ~known)
                near = far <= max_bits
                q, node, far = q[near], node[near], far[near]
                below = len(self.levels[level - 1][0]) if level else len(self.prints)
                children = node[:, None] * FANOUT + np.arange(FANOUT)
                there = children < below
                q, far, known = (np.repeat(x, FANOUT)[there.ravel()] for x in (q, far, mask[node]))
                node = children[there]
            far = far + np.bitwise_count((block[q] ^ self.prints[node]) & ~known)
            near = far <= max_bits
            yield q[near] + first, node[near]


class Links:
    """Union of entries by the smallest index; only a spanning set of links is left."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def spanning(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tied = np.flatnonzero(self.root != np.arange(len(self.root)))
        return prints[tied], prints[self.root[tied]]


_RUN = "t int, key long, first long, mask long, pattern long, size int, prints array<long>, a array<long>, b array<long>"


def _run_row(t: int, key: int, prints: np.ndarray, max_bits: int, whole: bool) -> tuple:
    index, links = GrayIndex(prints), Links(len(prints))
    for q, x in index.within(prints, max_bits):
        links.add(q, x)
    a, b = links.spanning(prints)
    mask, pattern = (np.uint64(x).view(np.int64) for x in index.header)
    own = None if whole else prints.view(np.int64)
    return t, key, int(prints[:1].view(np.int64)[0]), int(mask), int(pattern), len(prints), own, a.view(np.int64), b.view(np.int64)


def _runs(max_bits: int):
    """Cut each task's sorted rows into runs of one key. A run that cannot be the key's only one carries its prints."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _RUN.split(", ")]
        kept: tuple[np.ndarray, ...] = tuple(np.empty(0, dtype=d) for d in (np.int32, np.int64, np.int64))
        first_key = True

        def rows(t, key, prints, last: bool):
            nonlocal first_key
            edges = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(t)]))
            out = []
            for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
                if not last and i == len(starts) - 1:
                    return out, s
                whole = e - s <= CHUNK and not first_key and not (last and i == len(starts) - 1)
                first_key = False
                for at in range(s, e, CHUNK):
                    run = prints[at : min(e, at + CHUNK)].view(np.uint64)
                    out.append(_run_row(int(t[s]), int(key[s]), run, max_bits, whole))
            return out, len(t)

        for batch in batches:
            new = (batch["t"].to_numpy(np.int32), batch["key"].to_numpy(np.int64), batch["print"].to_numpy(np.int64))
            t, key, prints = (np.concatenate(pair) for pair in zip(kept, new, strict=True))
            if not len(t):
                continue
            # A key that is longer than a few runs is not held back: full runs of it are given out at once.
            out, done = rows(t, key, prints, last=False)
            while len(t) - done >= 4 * CHUNK:
                out.append(_run_row(int(t[done]), int(key[done]), prints[done : done + CHUNK].view(np.uint64), max_bits, False))
                done += CHUNK
                first_key = True  # what is left of this key is not its only run
            kept = (t[done:], key[done:], prints[done:])
            if out:
                yield pd.DataFrame(out, columns=names)
        if len(kept[0]):
            yield pd.DataFrame(rows(*kept, last=True)[0], columns=names)

    return cut


def _across(max_bits: int):
    """Links between two runs of one key."""

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for mine, other in zip(batch["mine"], batch["other"], strict=True):
                x, y = (np.asarray(p, dtype=np.int64).view(np.uint64) for p in (mine, other))
                both, links = np.concatenate((x, y)), Links(len(x) + len(y))
                for q, e in GrayIndex(y).within(x, max_bits):
                    links.add(q, e + len(x))
                a, b = links.spanning(both)
                if len(a):
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return match


def link_prints(prints: DataFrame, column: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) that connect what differences of at most ``max_bits`` connect, and nothing else: within a run each
    fingerprint is tied to the first that it reaches there, over however many steps. ``column`` must hold each
    fingerprint once and be stored or cheap."""
    masks = key_masks(prints.count(), max_bits)
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col(column).bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]
    )
    keyed = prints.select(F.col(column).alias("print"), F.inline(tables)).withColumn("gray", gray_rank(F.col("print")))
    ordered = keyed.repartitionByRange("t", "key", "gray").sortWithinPartitions("t", "key", "gray")
    runs = stored(ordered.select("t", "key", "print").mapInPandas(_runs(max_bits), _RUN), "gray-runs")
    inside = runs.select(F.inline(F.arrays_zip("a", "b")))
    open_ = runs.filter(F.col("prints").isNotNull()).select("t", "key", "first", "mask", "pattern", "prints")
    left, right = open_.alias("l"), open_.alias("r")
    shared = F.col("l.mask").bitwiseAND(F.col("r.mask"))
    apart = F.bit_count(F.col("l.pattern").bitwiseXOR(F.col("r.pattern")).bitwiseAND(shared))
    met = left.join(
        right,
        (F.col("l.t") == F.col("r.t"))
        & (F.col("l.key") == F.col("r.key"))
        & (F.col("l.first") < F.col("r.first"))
        & (apart <= max_bits),
    ).select(F.col("l.prints").alias("mine"), F.col("r.prints").alias("other"))
    return inside.unionByName(met.mapInPandas(_across(max_bits), "a long, b long"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: doc_id, print, component_id, root (the component's smallest fingerprint), and the key
    that decisions are joined back on.

    component_id is the smallest doc_id of all documents whose fingerprints are linked, directly or over others.
    NULL and blank texts have fingerprint zero and are linked like any other. NULL ids are passed over when the
    smallest is taken; a component without any id has none. Repeated rows each get a row. Other columns are not
    looked at. No documents: no rows.
    """
    body = text_or_empty(text)
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(body).alias("k_hash"),
            F.octet_length(body).alias("k_len"),
            fingerprints(body, width).alias("print"),
        ),
        "fingerprints",
    )
    smallest = stored(rows.groupBy("print").agg(F.min("doc_id").alias("own")), "prints")
    links = stored(link_prints(smallest.select("print"), "print", max_bits).distinct(), "links")
    tied = connected_components(links, "a", "b")
    members = tied.unionByName(tied.select(F.col("root").alias("node"), "root")).distinct()
    known = members.join(smallest, members["node"] == smallest["print"]).select("print", "root", "own")
    least = known.groupBy("root").agg(F.min("own").alias("least"))
    named = known.join(least, "root").select("print", "root", "least")
    of_print = smallest.join(named, "print", "left").select(
        "print", F.coalesce("least", "own").alias("component_id"), F.coalesce("root", "print").alias("root")
    )
    # Written, so that both sides of the join are dealt for it and a print of many documents can be split.
    of_print = stored(of_print, "print-components")
    return rows.join(of_print, "print").select("doc_id", "print", "component_id", "root", "k_hash", "k_len")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One document of each component, the one whose id is the component's; columns unchanged.

    Where that id occurs several times in the component, the row of the smallest text hash stays, once.
    Of a component without any id the row of the smallest text hash stays.
    """
    found = near_duplicates(docs, doc_id, text, width, max_bits)
    keyed = stored(
        found.groupBy(F.col("doc_id").alias("k_id"), "k_hash", "k_len", "component_id", "root").agg(
            F.count(F.lit(1)).alias("times")
        ),
        "near-duplicates",
    )
    holds = F.col("k_id").eqNullSafe(F.col("component_id"))
    first = keyed.filter(holds).groupBy("root").agg(F.min("k_hash").alias("least"))
    kept = holds & (F.col("k_hash") == F.col("least"))
    decided = keyed.join(first, "root").select("k_id", "k_hash", "k_len", "times", kept.alias("kept"))
    return keep_one_of_each(docs, stored(decided, "near-kept"), doc_id, text)
