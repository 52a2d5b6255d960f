"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import xxhash

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words(text):
    return [w for w in BLANKS.split(lowered(text)) if w]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, width=4):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def components(prints, max_bits=4):
    """Root index of each fingerprint by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def simhash(rows, max_bits=4):
    """{doc_id: (fingerprint, component_id)} for distinct ids."""
    rows = sorted(rows)
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, components(distinct, max_bits), strict=True))
    least = {}
    for (doc_id, _), p in zip(rows, prints, strict=True):
        least.setdefault(root[p], doc_id)
    return {d: (f"{p:016x}", least[root[p]]) for (d, _), p in zip(rows, prints, strict=True)}


def held_out(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def kt(a, b):
    """ln of the Krichevsky-Trofimov probability, bit by bit."""
    out, zeros, ones = 0.0, 0, 0
    for bit, n in ((0, a), (1, b)):
        for _ in range(n):
            out += math.log(((ones if bit else zeros) + 0.5) / (zeros + ones + 1))
            zeros, ones = zeros + (bit == 0), ones + (bit == 1)
    return out


class Ctw:
    """Context-tree weighting with dictionaries: one node per context and decision."""

    def __init__(self, texts, depth=2):
        self.depth, self.counts = depth, {}
        for raw in texts:
            for context, byte in self.positions(raw):
                for d in range(depth + 1):
                    node = 1
                    for level in range(8):
                        bit = byte >> (7 - level) & 1
                        self.counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1
                        node = 2 * node + bit
        self.weighted, self.weight = {}, {}
        for d in range(depth, -1, -1):
            children = Counter()
            for (context, node), value in self.weighted.items():
                if len(context) == d + 1:
                    children[context[1:], node] += value
            for key, (a, b) in [x for x in self.counts.items() if len(x[0][0]) == d]:
                own = math.log(0.5) + kt(a, b)
                rest = math.log(0.5) + children[key] if d < depth else None
                total = kt(a, b) if rest is None else max(own, rest) + math.log1p(math.exp(-abs(own - rest)))
                self.weighted[key] = total
                self.weight[key] = 1.0 if rest is None else math.exp(own - total)

    def positions(self, raw):
        padded = bytes(self.depth) + raw
        for i in range(len(raw)):
            yield padded[i : i + self.depth], raw[i]

    def one(self, context, node, d=0):
        key = (context[self.depth - d :], node)
        if key not in self.counts:
            return 0.5
        a, b = self.counts[key]
        own = (b + 0.5) / (a + b + 1)
        w = self.weight[key]
        return own if d == self.depth else w * own + (1 - w) * self.one(context, node, d + 1)

    def log10(self, raw):
        total = 0.0
        for context, byte in self.positions(raw):
            node = 1
            for level in range(8):
                bit, p = byte >> (7 - level) & 1, self.one(context, node)
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        return total


def lm_scores(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score, score)} for distinct ids."""
    training = [t for d, t in rows if not held_out(d, 7, 2)]
    counts = Counter(w for t in training for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    model = Ctw([lowered(t).encode() for t in training])
    out = {}
    for d, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out[d] = (held_out(d, 7, 2), len(tokens), sum(w in counts for w in tokens), n, base, model.log10(lowered(t).encode()))
    return out


def plain_words(text):
    return [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", x).lower() for x in text.split()) if w]


def contained(document, item, share=0.8, window=5):
    """Whether the document has this share of the item's plain word windows."""
    d, i = plain_words(document), plain_words(item)
    have = {tuple(d[k : k + window]) for k in range(len(d) - window + 1)}
    wanted = [tuple(i[k : k + window]) for k in range(len(i) - window + 1)]
    return bool(wanted) and sum(w in have for w in wanted) >= share * len(wanted)


def hashed(*values):
    """64-bit hash of a row of columns, each one's hash the seed of the next: long of 8 bytes, ``(int,)`` of 4, text; NULL is passed over."""
    h = 42
    for v in values:
        if isinstance(v, str):
            h = xxhash.xxh64_intdigest(v.encode(), h)
        elif isinstance(v, tuple):
            h = xxhash.xxh64_intdigest(v[0].to_bytes(4, "little"), h)
        elif v is not None:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), h)
    return h - (h >> 63 << 64)


def mix(rows, exponent, budget, block_tokens, seed=17):
    """Counter of (doc_id, pass, block, place) for (doc_id, source, text), walking every block of every pass."""
    sources = {}
    for doc_id, source, text in rows:
        sources.setdefault(source, []).append((doc_id, hashed(text or ""), len(words(text))))
    totals = {s: sum(t for _, _, t in docs) for s, docs in sources.items()}
    power = {s: (n / sum(totals.values())) ** exponent for s, n in totals.items() if n}
    out = Counter()
    for source, p in power.items():
        left = math.floor(p / sum(power.values()) * budget + 0.5)
        n_blocks = -(-(totals[source] + len(sources[source])) // block_tokens)
        blocks = {}
        for doc_id, k_hash, tokens in sources[source]:
            at = hashed(doc_id, k_hash, (seed,)) % n_blocks
            blocks.setdefault(at, []).append((hashed(k_hash, doc_id, (seed + 1,)), doc_id, tokens))
        nth = 0
        while left > 0:
            for place, block in sorted((hashed(b, nth, (seed,)), b) for b in blocks):
                for _, doc_id, tokens in sorted(blocks[block]):
                    if left > 0:
                        out[doc_id, nth, block, place] += 1
                    left -= tokens
            nth += 1
    return out


def page_lines(page):
    """The lines of a page that holds no table, by replacing its tags: blocks and breaks end a line, list items are marked."""
    page = re.sub(r"(?s)<!--.*?-->|<head>.*?</head>|<!DOCTYPE[^>]*>", "", page or "")
    page = re.sub(r"<li>", "\n- ", re.sub(r"\s+", " ", page))
    page = re.sub(r"</?(?:p|li|nav|ul|div|article|h1|footer|body|html|br)\b[^>]*>", "\n", page)
    lines = html.unescape(re.sub(r"</?[ab]\b[^>]*>", "", page)).split("\n")
    return [x.strip() for x in lines if x.strip()]
