"""Language-model scores by context-tree weighting over binary-decomposed byte contexts.

A byte is eight binary decisions, most significant bit first, so there are 255 decision nodes; each has a tree over the
bytes before it, down to DEPTH of them. A tree node holds how often each bit followed its context and estimates the
next bit by Krichevsky and Trofimov. Weighting mixes, at every node, its own estimate with that of its children, by how
well either coded the training texts; this gives the code length of a byte as a mixture over all depths.

Training is counting: every task counts byte n-grams and words of its training texts, sorts its n-grams so that the last
TOP + 1 bytes of the context come first, and packs them by buckets of these bytes: one row holds many. One exchange brings
the rows of a bucket together; tasks add them up and write pieces of whole buckets, a row each, so all nodes deeper than
TOP lie within one piece, and later steps read pieces without another exchange. A node's key holds the context, its last byte lowest, and the decision. With every piece go
the sums that it gives the nodes of depth TOP; from there one aggregation per depth gives the weights of the upper nodes,
and what these mix is sent to the tasks (2 ** 24 nodes at most) for the way down. Deeper nodes are never gathered: they
grow with the texts.

Every n-gram of the documents gets its code length from the deepest nodes that were seen. The FREQUENT_GRAMS most
frequent ones go to the tasks as a table of that size; all other n-grams of a text are packed by bucket and meet the code
lengths of their bucket in a second exchange, from which each task gives one sum per text.

The base score is a unigram model with add-one smoothing over words and an end token. Counts of the FREQUENT most
frequent words go to the tasks as a table of that size; all other words of a text are joined with the full counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.llm.common import crc_remainder, text_or_empty, word_blocks
from hydroflow.session import stored

#: Bytes of context of the registered query; with the byte itself an n-gram is a long of 56 bits, so 6 is also the most.
DEPTH = 6
#: Nodes up to this depth are sent to all tasks.
TOP = 2
#: N-grams of a piece, at least; buckets stay whole.
PIECE_GRAMS = 1 << 17
FOLDS, HELD_OUT_FOLD = 7, 2
#: Words whose counts every task has; the others go through a join.
FREQUENT = 1 << 17
#: N-grams whose code length every task has; 16 bytes each.
FREQUENT_GRAMS = 1 << 20
#: Distinct words that a counting task holds before it gives them out, and bytes of text that it counts at once.
HELD_WORDS, HELD_BYTES = 1 << 18, 1 << 21
#: Distinct n-grams that a counting task holds before it gives them out.
HELD_GRAMS = 1 << 21
#: Buckets for each task of the exchange, and the fewest.
TASK_BUCKETS, LEAST_BUCKETS = 8, 256
#: A word up to this many bytes is its own key; a longer one is replaced by its 128-bit hash, marked by a zero byte.
KEY_BYTES = 32
#: The end token; no word begins with a blank.
END = b" "


def word_key(word: bytes) -> bytes:
    return word if len(word) <= KEY_BYTES else b"\0" + xxhash.xxh3_128_digest(word)


def grams(text: bytes, depth: int) -> np.ndarray:
    """For each byte the number made of the bytes before it and itself; before the text are zero bytes."""
    a = np.frombuffer(bytes(depth) + text, dtype=np.uint8).astype(np.int64)
    out = np.zeros(len(text), dtype=np.int64)
    for k in range(depth + 1):
        out = (out << 8) | a[k : k + len(text)]
    return out


def gram_blocks(text: bytes, depth: int) -> Iterator[np.ndarray]:
    """The n-grams of a text in blocks, so that memory does not follow its length."""
    for at in range(0, len(text), HELD_BYTES):
        before = text[max(0, at - depth) : at]
        yield grams(before + text[at : at + HELD_BYTES], depth)[len(before) :]


_COUNTS = "bucket int, n int, grams binary, times binary, words array<binary>, word_times array<long>"


def _turned(gram: np.ndarray, depth: int) -> np.ndarray:
    """N-grams with the last TOP + 1 bytes of their context first: their order is that of the groups."""
    low = 8 * (min(TOP, depth - 1) + 2)
    group = gram >> 8 & (1 << low - 8) - 1
    return group << 8 * (depth + 1) - low + 8 | gram >> low << 8 | gram & 255


def _turned_back(key: np.ndarray, depth: int) -> np.ndarray:
    low = 8 * (min(TOP, depth - 1) + 2)
    shift = 8 * (depth + 1) - low + 8
    return (key >> 8 & (1 << shift - 8) - 1) << low | key >> shift << 8 | key & 255


def _buckets(key: np.ndarray, depth: int, n: int) -> np.ndarray:
    """The bucket of each turned n-gram: that of its group."""
    group = (key >> 8 * (depth + 1) - 8 * (min(TOP, depth - 1) + 2) + 8).astype(np.uint64)
    return ((group * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


def _bucket_parts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """Bucket, start and end of each run of equal buckets."""
    if not len(bucket):
        return []
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return list(zip(bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True))


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers, np.int64).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 8 * n, codec="zstd", asbytes=True), np.int64)


def _add_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, and the sums of their counts; quick for parts that are in order themselves."""
    if len(held) == 1 and (len(held[0][0]) < 2 or (np.diff(held[0][0]) > 0).all()):
        return held[0]
    gram, times = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, times = gram[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.empty(0, np.int64)
    return gram[first], np.add.reduceat(times, first) if len(first) else times


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _count(depth: int, n_buckets: int):
    """Word and n-gram counts of a task's training texts, folded as far as memory allows and packed by bucket. N-grams of
    held-out texts are listed with a count of zero, because they get a code length as well."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        blocks: dict[bool, list] = {False: [], True: []}
        size, held = 0, []

        def word_rows() -> pa.RecordBatch:
            lists: dict[int, tuple[list, list]] = {}
            for word, times in words.items():
                key = word_key(word)
                own = lists.setdefault(crc32(key) % n_buckets, ([], []))
                own[0].append(key)
                own[1].append(times)
            words.clear()
            none = pa.nulls(len(lists), pa.binary())
            return _batch(
                bucket=pa.array(lists, pa.int32()), n=pa.nulls(len(lists), pa.int32()), grams=none, times=none,
                words=pa.array([w for w, _ in lists.values()], pa.list_(pa.binary())),
                word_times=pa.array([t for _, t in lists.values()], pa.list_(pa.int64())),
            )

        def fold() -> int:
            for held_out, own in blocks.items():
                if own:
                    found, times = np.unique(np.concatenate(own), return_counts=True)
                    held.append((found, times.astype(np.int64) * (not held_out)))
                    own.clear()
            if len(held) > 1 and sum(len(g) for g, _ in held) >= HELD_GRAMS:
                held[:] = [_add_up(held)]
            return sum(len(g) for g, _ in held)

        def gram_rows() -> pa.RecordBatch:
            key, times = _add_up(held)
            held.clear()
            bucket = _buckets(key, depth, n_buckets)
            order = np.argsort(bucket, kind="stable")
            key, times, bucket = key[order], times[order], bucket[order]
            parts = _bucket_parts(bucket)
            return _batch(
                bucket=pa.array([k for k, *_ in parts], pa.int32()), n=pa.array([b - a for _, a, b in parts], pa.int32()),
                grams=pa.array([_packed(np.diff(key[a:b], prepend=0)) for _, a, b in parts], pa.binary()),
                times=pa.array([_packed(times[a:b]) for _, a, b in parts], pa.binary()),
                words=pa.nulls(len(parts), pa.list_(pa.binary())), word_times=pa.nulls(len(parts), pa.list_(pa.int64())),
            )

        for batch in batches:
            for body, held_out in zip(batch.column("body"), batch.column("held_out").to_pylist(), strict=True):
                raw = body.as_py().lower()
                if not held_out:
                    words[END] += 1
                    for block in word_blocks(raw):
                        words.update(block)
                        if len(words) >= HELD_WORDS:
                            yield word_rows()
                for part in gram_blocks(raw, depth):
                    blocks[held_out].append(_turned(part, depth))
                    size += len(part)
                    if size >= HELD_BYTES:
                        size = 0
                        if fold() >= HELD_GRAMS:
                            yield gram_rows()
        fold()
        if words:
            yield word_rows()
        if held:
            yield gram_rows()

    return count


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for positive values: Stirling's series eight steps up."""
    y, shift = x + 8, np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    inverse = 1 / y
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


# ln gamma of k + 1/2 and of k + 1 for small counts.
_HALVES, _WHOLES = _log_gamma(np.arange(4096) + 0.5), _log_gamma(np.arange(4096) + 1.0)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    a, b = np.asarray(zeros, dtype=np.float64), np.asarray(ones, dtype=np.float64)

    def each(x: np.ndarray, table: np.ndarray, step: float) -> np.ndarray:
        out = table[np.minimum(x, len(table) - 1).astype(np.int64)]
        large = x >= len(table)
        if large.any():
            out[large] = _log_gamma(x[large] + step)
        return out

    return each(a, _HALVES, 0.5) + each(b, _HALVES, 0.5) - each(a + b, _WHOLES, 1.0) - math.log(math.pi)


_BITS = [(np.arange(256) + 256) >> (8 - level) for level in range(8)]
_ONES = [((np.arange(256) >> (7 - level)) & 1).astype(bool) for level in range(8)]


def byte_code_lengths(one: np.ndarray) -> np.ndarray:
    """log10 of the probability of each byte, from the probability of a one at each decision node."""
    p = np.clip(one, 1e-300, 1.0)
    logs, rest = np.log10(p), np.log10(np.clip(1 - p, 1e-300, 1.0))
    out = np.zeros((*one.shape[:-1], 256))
    for nodes, ones in zip(_BITS, _ONES, strict=True):
        out += np.where(ones, logs[..., nodes], rest[..., nodes])
    return out


def _log_gamma_column(x: Column) -> Column:
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    y = x + 8
    i = 1 / y
    series = i * (1 / 12 - i * i * (1 / 360 - i * i * (1 / 1260 - i * i / 1680)))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - F.ln(product)


def _log_kt_column(zeros: Column, ones: Column) -> Column:
    """``log_kt`` as a column expression."""
    return _log_gamma_column(zeros + 0.5) + _log_gamma_column(ones + 0.5) - _log_gamma_column(zeros + ones + 1.0) - math.log(math.pi)


def _mask(depth: int) -> int:
    """The bits of a key that name a node of this depth."""
    return (1 << 8 * (depth + 1)) - 1


def _decision_keys(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key at full depth and bit of the eight decisions of each n-gram, by level."""
    byte = gram & 255
    keys = [(gram - byte) + ((byte | 256) >> (8 - level)) for level in range(8)]
    return np.stack(keys), np.stack([(byte >> (7 - level)) & 1 for level in range(8)])


def _add_below(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, the place of each key among them, and sums of the values."""
    found, place = np.unique(keys, return_inverse=True)
    return found, place, [np.bincount(place, v, len(found)).astype(np.float64) for v in values]


def _climb(gram: np.ndarray, times: np.ndarray, depth: int, upper: int):
    """The nodes of a piece from ``depth`` up to ``upper + 1``, each depth as (keys, own estimate, weight, place of the
    parent), and the sums that the nodes of depth ``upper`` get: keys, zeros, ones, weighted probability below."""
    keys, bits = _decision_keys(gram[times > 0])
    n = np.broadcast_to(times[times > 0].astype(np.float64), keys.shape).ravel()
    bits = bits.ravel()
    keys, _, (zeros, ones) = _add_below(keys.ravel(), n * (1 - bits), n * bits)
    below, nodes = None, []
    for d in range(depth, upper, -1):
        own = log_kt(zeros, ones)
        if below is None:
            weighted, weight = own, np.ones(len(own))
        else:
            weighted = math.log(0.5) + np.logaddexp(own, below)
            weight = np.exp(math.log(0.5) + own - weighted)
        estimate = (ones + 0.5) / (zeros + ones + 1)
        parents, place, (zeros, ones, below) = _add_below(keys & _mask(d - 1), zeros, ones, weighted)
        nodes.append((keys, estimate, weight, place))
        keys = parents
    return nodes, (keys, zeros, ones, below)


_SUMS = ("keys", "zeros", "ones", "below")
_FOLDED = "word binary, times long, grams array<long>, counts array<long>, keys array<long>, zeros array<double>, ones array<double>, below array<double>"


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _fold(depth: int):
    """Packed rows of a partition sorted by bucket become a row per word, and a row per piece with the sums that it gives the
    nodes of depth TOP."""
    upper = min(TOP, depth - 1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        done: list[tuple[np.ndarray, np.ndarray]] = []  # of whole buckets
        open_: list[tuple[np.ndarray, np.ndarray]] = []  # of the bucket that is being read

        def held(parts: list) -> int:
            return sum(len(g) for g, _ in parts)

        def word_rows() -> pa.RecordBatch:
            keys = pa.array(words, pa.binary())
            empty = {c.split()[0]: pa.nulls(len(keys), pa.list_(pa.int64() if "long" in c else pa.float64())) for c in _FOLDED.split(", ")[2:]}
            rows = _batch(word=keys, times=pa.array(words.values(), pa.int64()), **empty)
            words.clear()
            return rows

        def piece() -> pa.RecordBatch:
            key, times = (np.concatenate(x) for x in zip(*done, strict=True))
            done.clear()
            gram = _turned_back(key, depth)
            keys, zeros, ones, below = _climb(gram, times, depth, upper)[1]
            sums = {c: _list(v) for c, v in zip(_SUMS, (keys, zeros, ones, np.zeros(len(keys)) if below is None else below), strict=True)}
            return _batch(word=pa.nulls(1, pa.binary()), times=pa.nulls(1, pa.int64()), grams=_list(gram), counts=_list(times), **sums)

        now = None
        for batch in batches:
            columns = [batch.column(c) for c in ("bucket", "n", "grams", "times", "words", "word_times")]
            for bucket, n, grams_, times, own, own_times in zip(*columns, strict=True):
                if now != bucket.as_py():
                    now = bucket.as_py()
                    if open_:
                        done.append(_add_up(open_))
                        open_ = []
                    if held(done) >= PIECE_GRAMS:
                        yield piece()
                    if len(words) >= HELD_WORDS:
                        yield word_rows()
                if n.as_py() is None:
                    for word, count in zip(own.as_py(), own_times.as_py(), strict=True):
                        words[word] += count
                else:
                    size = n.as_py()
                    open_.append((np.cumsum(_unpacked(grams_.as_py(), size)), _unpacked(times.as_py(), size)))
                    if len(open_) > 1 and held(open_) >= 2 * max(PIECE_GRAMS, len(open_[0][0])):
                        open_ = [_add_up(open_)]
        if open_:
            done.append(_add_up(open_))
        if done:
            yield piece()
        if words:
            yield word_rows()

    return fold


def train_contexts(counts: DataFrame, depth: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The nodes of depth 0 to TOP from the sums of the pieces: keys in order, the probability of a one that the
    depths down to there give, and the weight that is left for deeper ones.

    Every n-gram has a full context, so the counts of a node are the sums over its children.
    """
    upper = min(TOP, depth - 1)
    sums = F.inline(F.arrays_zip(F.col("keys").alias("key"), *[F.col(c) for c in _SUMS[1:]]))
    nodes = counts.filter("keys is not null").select(sums)
    levels: list[DataFrame] = []
    for d in range(upper, -1, -1):
        nodes = nodes.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
        nodes = nodes.withColumn("kt", _log_kt_column(F.col("zeros"), F.col("ones")))
        most, least = F.greatest("kt", "below"), F.least("kt", "below")
        nodes = nodes.withColumn("weighted", math.log(0.5) + most + F.log1p(F.exp(least - most)))
        nodes = nodes.withColumn("weight", F.exp(math.log(0.5) + F.col("kt") - F.col("weighted")))
        levels.insert(0, stored(nodes.select("key", "zeros", "ones", "weighted", "weight"), f"nodes-{d}"))
        if d:
            parent = F.col("key").bitwiseAND(F.lit(_mask(d - 1)))
            nodes = levels[0].select(parent.alias("key"), "zeros", "ones", F.col("weighted").alias("below"))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for d, level in enumerate(levels):
        found = level.select("key", ((F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)).alias("own"), "weight").toArrow()
        order = np.argsort(found["key"].to_numpy())
        keys, own, weight = (found[c].to_numpy()[order] for c in ("key", "own", "weight"))
        given, rest = np.zeros(len(keys)), np.ones(len(keys))
        if d:
            place = np.searchsorted(out[-1][0], keys & _mask(d - 1))
            given, rest = out[-1][1][place], out[-1][2][place]
        out.append((keys, given + rest * weight * own, rest * (1 - weight)))
    return out


def _lengths(tops, depth: int, n_buckets: int):
    """log10 of the probability of the last byte of every n-gram. A decision that never occurred after a context is a
    half below the deepest node where it did."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, own_tops = min(TOP, depth - 1), tops.value
        rows = (r for b in batches for r in zip(b.column("grams"), b.column("counts"), strict=True))
        for gram, times in ((g.values.to_numpy(), n.values.to_numpy()) for g, n in rows):
            nodes, (top_keys, *_) = _climb(gram, times, depth, upper)
            place = np.searchsorted(own_tops[upper][0], top_keys)
            given, rest = own_tops[upper][1][place], own_tops[upper][2][place]
            levels = list(own_tops)
            for keys, own, weight, place in reversed(nodes):
                given, rest = given[place], rest[place]
                given, rest = given + rest * weight * own, rest * (1 - weight)
                levels.append((keys, given, rest))
            keys, bits = _decision_keys(gram)
            one, open_ = np.full(keys.size, 0.5), np.arange(keys.size)
            flat = keys.ravel()
            for d in range(depth, -1, -1):
                known, given, rest = levels[d]
                if not len(known) or not len(open_):
                    continue
                wanted = flat[open_] & _mask(d)
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = known[at] == wanted
                one[open_[hit]] = given[at[hit]] + 0.5 * rest[at[hit]]
                open_ = open_[~hit]
            p = np.where(bits.ravel() == 1, one, 1 - one)
            length = np.log10(np.clip(p, 1e-300, 1.0)).reshape(keys.shape).sum(axis=0)
            key = _turned(gram, depth)
            for bucket, a, b in _bucket_parts(_buckets(key, depth, n_buckets)):
                yield _batch(
                    bucket=pa.array([bucket], pa.int32()), n=pa.array([b - a], pa.int32()),
                    grams=pa.array([_packed(np.diff(key[a:b], prepend=0))], pa.binary()),
                    times=pa.array([_packed(times[a:b])], pa.binary()),
                    length=pa.array([_packed(length[a:b].view(np.int64))], pa.binary()),
                )

    return descend


def bucket_count(spark: SparkSession) -> int:
    """Buckets of n-grams: some for each task of an exchange."""
    return max(LEAST_BUCKETS, TASK_BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")))


def count_texts(texts: DataFrame, depth: int, n_buckets: int) -> DataFrame:
    """Stored counts of ``texts`` (body binary, held_out): a row per word (word, times), and a row per piece of n-grams
    (grams, counts, and the sums for the nodes of depth TOP)."""
    counted = texts.mapInArrow(_count(depth, n_buckets), _COUNTS)
    dealt = counted.repartition("bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(_fold(depth), _FOLDED), "counts")


_LENGTHS = "bucket int, n int, grams binary, times binary, length binary"


def gram_code_lengths(counts: DataFrame, depth: int, n_buckets: int) -> DataFrame:
    """The stored code lengths of all n-grams, trained or not, in a row per bucket: its number of n-grams, and packed the
    turned n-grams in order, their counts and their code lengths."""
    tops = counts.sparkSession.sparkContext.broadcast(train_contexts(counts, depth))
    pieces = counts.filter("grams is not null").select("grams", "counts")
    return stored(pieces.mapInArrow(_lengths(tops, depth, n_buckets), _LENGTHS), "code-lengths")


def _unpacked_rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    """Rows with ``n`` and packed columns, the first of them n-grams."""
    for batch in batches:
        for row in zip(batch.column("n").to_pylist(), *[batch.column(c) for c in names], strict=True):
            n, grams, *others = row
            yield [np.cumsum(_unpacked(grams.as_py(), n)), *[_unpacked(x.as_py(), n) for x in others]]


def _levels(times: np.ndarray) -> np.ndarray:
    """Count levels are eighths of a power of two, so there are a few hundred of them."""
    return np.floor(np.log2(times) * 8).astype(np.int64)


def _frequent_grams(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, turned and in order, and their code lengths: all from the smallest count level on of which
    there are no more than FREQUENT_GRAMS."""

    def count_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, times in _unpacked_rows(batches, "grams", "times"):
            level, n = np.unique(_levels(times[times > 0]), return_counts=True)
            total.update(dict(zip(level.tolist(), n.tolist(), strict=True)))
        yield _batch(level=pa.array(total, pa.int64()), n=pa.array(total.values(), pa.int64()))

    levels = lengths.select("n", "grams", "times").mapInArrow(count_levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("count"))
    least = _least(levels, FREQUENT_GRAMS)
    if least is None:
        return np.empty(0, dtype=np.int64), np.empty(0)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, times, length in _unpacked_rows(batches, "grams", "times", "length"):
            own = np.flatnonzero(times > 0)
            own = own[_levels(times[own]) >= least]
            yield _batch(gram=pa.array(key[own]), length=pa.array(length.view(np.float64)[own]))

    found = lengths.mapInArrow(pick, "gram long, length double").toArrow()
    gram, length = found["gram"].to_numpy(), found["length"].to_numpy()
    order = np.argsort(gram)
    return gram[order], length[order]


_SCORED = (
    "row long, doc_id string, n_tokens long, n_known long, known double, score double, rare array<binary>, rare_times array<long>, "
    "bucket int, n int, grams binary, times binary, rows binary"
)
#: Texts whose n-grams are looked up at once: their number in the block takes the eight bits that an n-gram leaves.
BLOCK_TEXTS = 256


def _score(frequent: Broadcast, model: Broadcast, depth: int, n_buckets: int):
    """A row per document, and rows of packed n-grams that have to be joined, without n_tokens."""
    simple = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    lists = {"array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}
    kinds = [(name, (simple | lists)[kind]) for name, kind in (c.split() for c in _SCORED.split(", "))]

    def rows_of(how_many: int, **columns) -> pa.RecordBatch:
        return _batch(**{c: pa.array(columns[c], kind) if c in columns else pa.nulls(how_many, kind) for c, kind in kinds})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, (known_grams, lengths) = frequent.value, model.value
        texts: list[list] = []  # of the rows that are not given out yet
        block: list[np.ndarray] = []
        members: list[int] = []  # the place among ``texts`` of each text of the block
        rare: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def resolve() -> None:
            """Add to each text what is known of its n-grams in the block, and keep the others."""
            both = np.concatenate([key.astype(np.uint64) << np.uint64(8) | np.uint64(i) for i, key in enumerate(block)])
            both.sort()
            first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            times = np.diff(np.append(first, len(both)))
            key, member = (both[first] >> np.uint64(8)).astype(np.int64), (both[first] & np.uint64(255)).astype(np.int64)
            at = np.minimum(np.searchsorted(known_grams, key), max(0, len(known_grams) - 1))
            hit = known_grams[at] == key if len(known_grams) else np.zeros(len(key), bool)
            sums = np.bincount(member[hit], lengths[at[hit]] * times[hit], len(block)) if hit.any() else np.zeros(len(block))
            for place, value in zip(members, sums.tolist(), strict=True):
                texts[place][5] += value
            row = np.array([texts[place][0] for place in members], np.int64)
            rare.append((key[~hit], times[~hit], row[member[~hit]]))
            block.clear()
            members.clear()

        def rare_rows() -> pa.RecordBatch:
            key, times, row = (np.concatenate(x) for x in zip(*rare, strict=True))
            rare.clear()
            order = np.argsort(key, kind="stable")
            order = order[np.argsort(_buckets(key[order], depth, n_buckets), kind="stable")]
            key, times, row = key[order], times[order], row[order]
            parts = _bucket_parts(_buckets(key, depth, n_buckets))
            spans = [slice(a, b) for _, a, b in parts]
            return rows_of(
                len(parts), bucket=[k for k, *_ in parts], n=[b - a for _, a, b in parts],
                grams=[_packed(np.diff(key[x], prepend=0)) for x in spans], times=[_packed(times[x]) for x in spans],
                rows=[_packed(row[x]) for x in spans],
            )

        def text_rows() -> pa.RecordBatch:
            columns = dict(zip([c for c, _ in kinds[:8]], zip(*texts, strict=True), strict=True))
            given = rows_of(len(texts), **columns)
            texts.clear()
            return given

        for batch in batches:
            columns = [batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("body")]
            for row, doc_id, body in zip(*columns, strict=True):
                raw = body.as_py().lower()
                times = Counter({END: 1})
                for words in word_blocks(raw):
                    times.update(words)
                n = np.fromiter(times.values(), np.int64, len(times))
                log = np.fromiter(map(logs.get, times, repeat(math.nan)), np.float64, len(times))
                hit, distinct = ~np.isnan(log), list(times)
                unknown = [word_key(distinct[i]) for i in np.flatnonzero(~hit).tolist()]
                known = float((n[hit] * log[hit]).sum())
                texts.append([row, doc_id, int(n.sum()), int(n[hit].sum()), known, 0.0, unknown, n[~hit].tolist()])
                for part in gram_blocks(raw, depth):
                    block.append(_turned(part, depth))
                    members.append(len(texts) - 1)
                    size += len(part)
                    if size >= HELD_BYTES or len(block) == BLOCK_TEXTS:
                        resolve()
                        size = 0
                        if sum(len(k) for k, *_ in rare) >= HELD_BYTES:
                            yield rare_rows()
                if not block and len(texts) >= BLOCK_TEXTS:
                    yield text_rows()
        if block:
            resolve()
        if rare:
            yield rare_rows()
        if texts:
            yield text_rows()

    return score


def _slots(row: np.ndarray, n: int) -> np.ndarray:
    return ((row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    rows, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    distinct, place = np.unique(rows, return_inverse=True)
    return distinct, np.bincount(place, values, len(distinct))


def _settle(n_slots: int):
    """Rows of a partition sorted by bucket, the code lengths of a bucket before the n-grams of its texts: sums per text,
    packed by slots of the texts' numbers."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held, known, lengths = 0, np.empty(0, np.int64), np.empty(0)

        def sums() -> pa.RecordBatch:
            row, value = _summed(found)
            found.clear()
            slot = _slots(row, n_slots)
            order = np.argsort(slot, kind="stable")
            row, value = row[order], value[order]
            parts = _bucket_parts(slot[order])
            return _batch(
                slot=pa.array([k for k, *_ in parts], pa.int32()), n=pa.array([b - a for _, a, b in parts], pa.int32()),
                rows=pa.array([_packed(row[a:b]) for _, a, b in parts], pa.binary()),
                values=pa.array([_packed(value[a:b].view(np.int64)) for _, a, b in parts], pa.binary()),
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("n", "grams", "length", "times", "rows")]
            for n, grams, length, times, rows in zip(*columns, strict=True):
                size = n.as_py()
                key = np.cumsum(_unpacked(grams.as_py(), size))
                if length.is_valid:
                    # A bucket's code lengths are in one row.
                    known, lengths = key, _unpacked(length.as_py(), size).view(np.float64)
                    continue
                value = lengths[np.searchsorted(known, key)] * _unpacked(times.as_py(), size)
                found.append(_summed([(_unpacked(rows.as_py(), size), value)]))
                held += len(found[-1][0])
                if held >= HELD_BYTES:
                    held = 0
                    yield sums()
        if found:
            yield sums()

    return settle


def _add_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sums of a partition sorted by slot: one sum per text."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    now = None

    def given() -> pa.RecordBatch:
        row, value = _summed(found)
        found.clear()
        return _batch(gram_row=pa.array(row), rare_score=pa.array(value))

    for batch in batches:
        for slot, n, rows, values in zip(*[batch.column(c) for c in ("slot", "n", "rows", "values")], strict=True):
            if slot.as_py() != now:
                now = slot.as_py()
                if sum(len(r) for r, _ in found) >= BLOCK_TEXTS:
                    yield given()
            size = n.as_py()
            found.append((_unpacked(rows.as_py(), size), _unpacked(values.as_py(), size).view(np.float64)))
    if found:
        yield given()


def _rare_scores(scored: DataFrame, lengths: DataFrame) -> DataFrame:
    """(gram_row, rare_score): the code lengths of the n-grams that were not at hand, added up per text. Sums cross the second
    exchange packed as well: each task has some for nearly every text."""
    asked = scored.filter("bucket is not null").select("bucket", "n", "grams", "times", "rows", F.lit(None).cast("binary").alias("length"))
    known = lengths.select("bucket", "n", "grams", F.lit(None).cast("binary").alias("times"), F.lit(None).cast("binary").alias("rows"), "length")
    met = known.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
    dealt = met.repartition("bucket").sortWithinPartitions("bucket", "asked").drop("bucket", "asked")
    # Every task has a row for every slot: one slot for each task of the exchange.
    n_slots = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = dealt.mapInArrow(_settle(n_slots), "slot int, n int, rows binary, values binary")
    return parts.repartition("slot").sortWithinPartitions("slot").mapInArrow(_add_scores, "gram_row long, rare_score double")


def _level() -> Column:
    """Levels are eighths of a power of two, so there are a few hundred of them."""
    return F.floor(F.log2("times") * 8).cast("int")


def _least(levels: DataFrame, most: int) -> int | None:
    """The smallest count level from which on there are no more than ``most`` rows, of (level, count)."""
    total, least = 0, None
    for r in sorted(levels.collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    return least


def _frequent(words: DataFrame) -> dict[bytes, float]:
    """Logarithms for the most frequent words, FREQUENT at most: all words from the smallest count level on of which
    there are no more."""
    own = words.filter(F.octet_length("word") <= KEY_BYTES).select("word", "times")
    least = _least(own.groupBy(_level().alias("level")).count(), FREQUENT)
    if least is None:
        return {}
    return {bytes(r["word"]): math.log10(r["times"] + 1) for r in own.filter(_level() >= least).collect()}


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose crc32(doc_id as text) modulo 7 is not 2; a NULL id is learned from and not held
    out. NULL texts count as empty: one end token and a score of 0. Repeated rows are learned from
    and scored each. Other columns are not looked at. If there is nothing to learn from, counts are zero and every
    bit is a half; no documents give no rows. ``depth`` is the number of bytes of context, 1 to 6.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6")
    spark: SparkSession = docs.sparkSession
    body = text_or_empty(text).cast("binary")
    held_out = F.coalesce(crc_remainder("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    n_buckets = bucket_count(spark)
    counts = count_texts(rows.select("body", held_out.alias("held_out")), depth, n_buckets)
    words = counts.filter("word is not null").select("word", "times")
    train_tokens, vocabulary = words.agg(F.sum("times"), F.count(F.lit(1))).first()
    train_tokens = train_tokens or 0
    frequent = spark.sparkContext.broadcast(_frequent(words))
    lengths = gram_code_lengths(counts, depth, n_buckets)
    model = spark.sparkContext.broadcast(_frequent_grams(lengths))
    # Rows are numbered and written in one go, so the numbers hold whatever is computed again later.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "body")
    scored = stored(numbered.mapInArrow(_score(frequent, model, depth, n_buckets), _SCORED), "scores")
    rare = scored.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("rare_times").alias("n"))))
    found = rare.join(words.select("word", "times"), "word")
    found = found.groupBy(F.col("row").alias("of_row")).agg(
        F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("times") + 1)).alias("rare_log")
    )
    others = _rare_scores(scored, lengths)
    size = math.log10(train_tokens + vocabulary + 1)
    texts = scored.filter("n_tokens is not null").select("row", "doc_id", "n_tokens", "n_known", "known", "score")
    both = texts.join(found, F.col("row") == F.col("of_row"), "left").join(others, F.col("row") == F.col("gram_row"), "left")
    known = F.col("known") + F.coalesce("rare_log", F.lit(0.0))
    return both.select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (known - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
