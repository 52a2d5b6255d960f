"""Byte-pair encoding and decoding by speculation.

1. Greedy longest match proposes tokens for a word.
2. A proposal is the result of merging if every token in it is the result of merging its own text, and no two neighbours
   would have merged across their border. The second is looked up for all neighbours of many words at once: going back in
   the merges of both tokens, the later one first, the parts that touch at the border must never be a merge that comes
   before the ones that took them away.
3. Only words that fail are merged exactly, lowest rank first.

The check needs merges in the order in which their parts were made; with a file that has another order every word is
merged exactly. Words once encoded are remembered, up to a bound.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import fresh, text_or_empty

#: Characters of texts that are cut into words at once; words that a worker remembers twice over, and their longest length.
PIECE = 1 << 20
REMEMBERED = 1 << 18
REMEMBERED_LENGTH = 64
#: Words that are looked up at once, and ids that are given on at once.
HELD = 1 << 17
#: Symbols of a word that is merged by looking through its pairs.
SHORT = 48

_NEVER = np.int64(1) << 40
_LAST = 1 << 40
# The white space of Unicode.
_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_AT_SPACE = re.compile(f"[{_SPACE}]")

# Combining characters, first to last, that the tokenizer's tables of composition do not know yet.
_UNCOMPOSED = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E),
    (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34),
    (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
)
_APART = re.compile("([" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _UNCOMPOSED) + "])")


def _composed(text: str) -> str:
    """NFC as the tokenizer has it: what its tables do not know stays where it is and composes with nothing."""
    try:
        text.encode("latin-1")
        return text  # nothing here composes
    except UnicodeEncodeError:
        pass
    return "".join([x if i % 2 else unicodedata.normalize("NFC", x) for i, x in enumerate(_APART.split(text))])


def _class(major: str) -> str:
    """The inside of a character class of all characters whose general category starts with ``major``."""
    out, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] == major
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(code - 1))}")
            start = None
    return "".join(out)


def _byte_names() -> list[str]:
    """One visible character for each byte: itself if it is printable Latin-1, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


class Vocabulary:
    """Vocabulary and merges of a tokenizer file (word-level splits, byte-level symbols, a mark at the end of a word)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names: list[str] = [""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for name, number in [*self.ids.items(), *self.added.items()]:
            self.names[number] = name
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if (
            [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
            or model["type"] != "BPE"
            or not self.suffix
            or not plain
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        ):
            raise ValueError("This tokenizer file has settings that are not supported.")
        self.pattern: str = cuts[0]["pattern"]["Regex"]
        self._read_merges(model["merges"])
        self._known: dict[str, Sequence[int]] = {}
        self._older: dict[str, Sequence[int]] = {}

    def _read_merges(self, merges: Sequence) -> None:
        size = len(self.names)
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.made = np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        ordered = True
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            ordered &= self.made[z] < 0 and self.made[x] < rank and self.made[y] < rank
            self.left[z], self.right[z], self.made[z] = x, y, rank
            self.merge[x, y] = (rank, z)
        keys = np.array([x * size + y for x, y in self.merge], np.int64)
        ranks = np.array([rank for rank, _ in self.merge.values()], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], ranks[order]
        # A part that is made after the merge that uses it would break the order of events that the check relies on.
        made = [(self.made[x], self.made[y], rank) for (x, y), (rank, _) in self.merge.items()]
        self.ordered = bool(ordered) and all(a < rank and b < rank for a, b, rank in made)

    # What follows is built where it is used, once in a worker.

    @cached_property
    def _words(self) -> tuple[re.Pattern, re.Pattern]:
        """The split of a lowered text: of any, and of one with ASCII only."""
        letters, numbers = _class("L"), _class("N")
        whole = self.pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace(r"\s", _SPACE)
        ascii_only = self.pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(r"\s", "\t-\r ")
        return re.compile(whole), re.compile(ascii_only)

    @cached_property
    def _specials(self) -> re.Pattern | None:
        longest_first = sorted(self.added, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    @cached_property
    def _symbols(self) -> tuple[list[int | None], list[int | None]]:
        """Ids of the bytes inside a word, and at its end."""
        names = _byte_names()
        return [self.ids.get(n) for n in names], [self.ids.get(n + self.suffix) for n in names]

    @cached_property
    def _tables(self) -> tuple[dict[bytes, int], dict[bytes, int], int]:
        """Tokens by the bytes that they stand for, inside a word and at its end, and the largest number of bytes.

        Only tokens that merging their own bytes gives again; no other ever is a result.
        """
        inner, final = self._symbols
        text: dict[int, tuple[bytes, bool]] = {}
        for b in range(256):
            for number, ends in ((inner[b], False), (final[b], True)):
                if number is not None:
                    text[number] = (bytes([b]), ends)
        pairs = list(self.merge.items())
        left, right = (np.array([p[0][i] for p in pairs], np.int64) for i in (0, 1))
        whole = self.compatible(left, right, but_whole=True)
        for ((x, y), (_, z)), sound in zip(pairs, whole.tolist(), strict=True):
            a, b = text.get(x), text.get(y)
            if sound and a and b and not a[1]:
                text[z] = (a[0] + b[0], b[1])
        tables = [{t: n for n, (t, ends) in text.items() if ends == side} for side in (False, True)]
        return tables[0], tables[1], max((len(t) for t, _ in text.values()), default=1)

    def _rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, or a number beyond all where there is none."""
        if not len(self._keys):
            return np.full(len(x), _NEVER)
        key = x.astype(np.int64) * len(self.names) + y
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, but_whole: bool = False) -> np.ndarray:
        """Whether merging the text of ``a`` and ``b`` together gives just these two tokens, for arrays of pairs.

        The parts at the border are followed back in time. Parts x and y that touch would have merged if their merge
        comes before x is taken from the left and not after y is taken from the right: of equal merges the leftmost
        is first. With ``but_whole`` the merge of ``a`` and ``b`` themselves does not count.
        """
        good, live = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_until, y_until = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(live):
            rank = self._rank(x, y)
            crossed = (rank < x_until) & (rank <= y_until)
            if but_whole:
                crossed[:], but_whole = False, False
            good[live[crossed]] = False
            x_made, y_made = self.made[x], self.made[y]
            on = ~crossed & ((x_made >= 0) | (y_made >= 0))
            live, x, y, x_made, y_made = live[on], x[on], y[on], x_made[on], y_made[on]
            x_until, y_until = x_until[on], y_until[on]
            back = x_made > y_made
            x_until, y_until = np.where(back, x_made, x_until), np.where(back, y_until, y_made)
            x, y = np.where(back, self.right[x], x), np.where(back, y, self.left[y])
        return good

    @cached_property
    def _reach(self) -> dict[bytes, int]:
        """The largest number of bytes of a token inside a word, by its first two bytes."""
        out: dict[bytes, int] = {}
        for text in self._tables[0]:
            if len(text) > 1:
                out[text[:2]] = max(out.get(text[:2], 0), len(text))
        return out

    def _propose(self, word: bytes) -> list[int] | None:
        """Longest matches from the left; None where a byte has no token or nothing fits the end."""
        inner, final, longest = self._tables
        reach, out, at, n = self._reach.get, [], 0, len(word)
        while True:
            rest = n - at
            if rest <= longest and (number := final.get(word[at:])) is not None:
                out.append(number)
                return out
            end = at + min(reach(word[at : at + 2], 1), rest - 1)
            while end > at and (number := inner.get(word[at:end])) is None:
                end -= 1
            if end == at:
                return None
            out.append(number)
            at = end

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, of equal ranks the leftmost. Bytes without a token are left out."""
        inner, final = self._symbols
        tokens = [inner[b] for b in word[:-1]] + [final[b] for b in word[-1:]]
        tokens = [t for t in tokens if t is not None]
        return self._merged_short(tokens) if len(tokens) <= SHORT else self._merged_long(tokens)

    def _merged_short(self, tokens: list[int]) -> list[int]:
        """By looking through all ranks for every merge."""
        merge, none = self.merge.get, (_LAST, -1)
        steps = [merge(pair, none) for pair in zip(tokens, tokens[1:], strict=False)]
        while steps and (step := min(steps)) is not none:
            at = steps.index(step)
            tokens[at : at + 2] = [step[1]]
            del steps[at]
            if at:
                steps[at - 1] = merge((tokens[at - 1], tokens[at]), none)
            if at < len(steps):
                steps[at] = merge((tokens[at], tokens[at + 1]), none)
        return tokens

    def _merged_long(self, tokens: list) -> list[int]:
        """With a queue of merges, so that time does not follow the square of the length."""
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> tuple[int, int, int, int] | None:
            pair = (tokens[i], tokens[after[i]])
            return (self.merge[pair][0], i, *pair) if pair in self.merge else None

        queue = [x for i in range(n - 1) if (x := offer(i))]
        heapify(queue)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i] if tokens[i] == a else n
            if j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.merge[a, b][1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if x := offer(i):
                    heappush(queue, x)
            if before[i] >= 0 and (x := offer(before[i])):
                heappush(queue, x)
        return [t for t in tokens if t is not None]

    def _learn(self, words: set[str]) -> dict[str, Sequence[int]]:
        """Tokens of words: proposals whose neighbours all fit, and exact merges of the others."""
        spelled = {w: w.encode() for w in words}
        if not self.ordered:
            return {w: tuple(self.merged(raw)) for w, raw in spelled.items()}
        proposed = {w: self._propose(raw) for w, raw in spelled.items()}
        several = [w for w, tokens in proposed.items() if tokens and len(tokens) > 1]
        if several:
            flat = np.fromiter(chain.from_iterable(proposed[w] for w in several), np.int64)
            ends = np.cumsum([len(proposed[w]) for w in several])
            inside = np.ones(len(flat) - 1, bool)
            inside[ends[:-1] - 1] = False
            at = np.flatnonzero(inside)
            wrong = at[~self.compatible(flat[at], flat[at + 1])]
            for k in np.unique(np.searchsorted(ends, wrong, side="right")).tolist():
                proposed[several[k]] = None
        return {w: tuple(self.merged(spelled[w]) if t is None else t) for w, t in proposed.items()}

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens, normalised."""
        if text.isascii():
            return self._words[1].findall(text.lower())
        # One character at a time: a sigma at the end of a word is lowered like any other.
        return self._words[0].findall(_composed(text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words, and ids of added tokens, in order; a long text in blocks that end before white space."""
        at, n = 0, len(text)
        while at < n:
            end = n
            if n - at > PIECE:
                space = _AT_SPACE.search(text, at + PIECE)
                end = space.start() if space else n
            block, start = text[at:end], 0
            for found in self._specials.finditer(block) if self._specials else ():
                yield self.words(block[start : found.start()])
                yield self.added[found.group()]
                start = found.end()
            yield self.words(block[start:] if start else block)
            at = end

    def _know(self, words: set[str]) -> None:
        """See that all these words are known. Words not seen for a while are forgotten first."""
        if len(self._known) > REMEMBERED:
            self._known, self._older = {w: t for w, t in self._known.items() if w in words}, self._known
        missing = words.difference(self._known)
        older = {w: self._older[w] for w in missing if w in self._older}
        self._known |= older
        self._known |= self._learn(missing.difference(older))

    def blocks(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, list[int]]]:
        """Ids of texts in order, with how many each text has, in blocks of some texts."""
        ids, lengths = array("i"), []
        group: list[tuple[int, list[str] | int]] = []
        held = 0

        def number() -> None:
            words = set(chain.from_iterable(p for _, p in group if not isinstance(p, int)))
            self._know(words)
            tokens = self._known.__getitem__
            for at, piece in group:
                before = len(ids)
                ids.extend((piece,) if isinstance(piece, int) else chain.from_iterable(map(tokens, piece)))
                lengths[at] += len(ids) - before
            for word in words:
                if len(word) > REMEMBERED_LENGTH:
                    del self._known[word]
            group.clear()

        for text in texts:
            lengths.append(0)
            for piece in self.pieces(text):
                group.append((len(lengths) - 1, piece))
                held += 1 if isinstance(piece, int) else len(piece)
                if held >= HELD:
                    number()
                    held = 0
            if len(ids) >= HELD:
                number()
                yield np.frombuffer(ids, np.int32), lengths
                ids, lengths, held = array("i"), [], 0
        number()
        yield np.frombuffer(ids, np.int32), lengths

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [own for ids, lengths in self.blocks(texts) for own in np.split(ids, np.cumsum(lengths)[:-1]) if lengths]

    def decode(self, ids: Sequence[int | None]) -> str:
        """The tokens of the ids, special ones too, joined by blanks; numbers that are no token's are left out."""
        names, n = self.names, len(self.names)
        return " ".join([names[i] for i in ids if i is not None and 0 <= i < n and names[i]])


def read_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the token ids of each whole text, as the tokenizer of the file gives them without template tokens.

    A NULL text counts as empty and has no ids. Added tokens that stand in a text get their own id. Letters and numbers are
    those of the interpreter's Unicode tables; characters newer than these count as signs. Rows and other columns stay as
    they are; if the frame has a column called ``into``, the new one gets a leading underscore. The vocabulary
    is broadcast; its size is that of the file.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for ids, lengths in shared.value.blocks(body.as_py() for body in batch):
                yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), pa.array(ids, pa.int32()))

    return df.withColumn(fresh(df, into), F.arrow_udf(run, "array<int>")(text_or_empty(text)))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of a column of ids. NULL lists give an empty text; NULLs and unknown numbers in a list are left out."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends, there = batch.offsets.to_numpy(), batch.is_valid().to_numpy(zero_copy_only=False)
            out, held = [], 0
            for at, known in enumerate(there.tolist()):
                own = batch.values[ends[at] : ends[at + 1]]
                ids = own.to_pylist() if own.null_count else own.to_numpy().tolist()
                out.append(shared.value.decode(ids) if known else "")
                held += len(ids)
                if held >= HELD:
                    yield pa.array(out, pa.string())
                    out, held = [], 0
            yield pa.array(out, pa.string())

    return df.withColumn(fresh(df, into), F.arrow_udf(run, "string")(F.col(ids)))
