"""Benchmark decontamination by template canonicalisation.

A text becomes a list of template tokens: words in lower case without outer punctuation, with numbers, names and units
replaced by typed placeholders whose values are kept aside as slots. Windows of WINDOW tokens of the benchmark items
are hashed into an index table. Documents are read once in Arrow batches; a bitmap of bounded size lets pass only
windows whose hash may be in the index, and those are hash-joined with it, template against template. Along one
alignment of a document with an item each slot value of the item must stand for one value in the document, else the
windows with that slot do not count. A document is contaminated by an item if it has SHARE of its windows.

Names are known by their capitals, so a copy in other letter case has other names. Windows are therefore filed and looked up
in a second, folded form, where names are words like any other; the same rules hold in it. A window of the first form
counts as found if the folded one that starts at the same word is.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import text_or_empty, without_rows
from hydroflow.session import stored

WINDOW, SHARE = 5, 0.8
#: Words that a window must have besides its slots to be looked for.
TELLING = 2
#: Bits of the map that documents' windows are looked up in before the join; it has a fixed size.
MAP_BITS = 23
#: Raw words that a task remembers the template token of.
REMEMBERED = 1 << 19
#: Characters of the texts whose tokens a task works on at a time; a longer text is worked on alone.
AT_ONCE = 1 << 19

NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
# Written units that may follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft feet foot yd yard yards mi mile miles mg g kg t lb lbs oz ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents usd eur gbp pound pounds percent % degree degrees c f k hz khz mhz ghz w kw kwh "
    "v a j kj pa kpa mph kmh km/h m/s kb mb gb tb".split()
)

_EMPTY, _TITLE, _NUMBER, _UNIT, _ENDS, _WITH_UNIT = 1, 2, 4, 8, 16, 32
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_ASCII_OUTER = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_STOPS, _CLOSING = (".", "!", "?"), "\"')]}»”’"
_IS_NUMBER = re.compile(r"\d[\d.,:/]*(?:st|nd|rd|th)?")
_NUMBER_UNIT = re.compile(r"(\d[\d.,]*)([^\W\d_/]+(?:/[a-z])?)")
_P = np.uint64(0x9E3779B97F4A7C15)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 7)


def _look(raw: str) -> tuple[int, str, str]:
    """What a raw word looks like, its literal token, and the unit written together with it."""
    if raw.isalpha():
        flags, lower = 0, raw.casefold()
        if lower in UNITS:
            flags = _UNIT
        if raw[0].isupper() and len(raw) > 1 and not raw[1:].isupper():
            flags |= _TITLE
        return flags, lower, ""
    core = raw.strip(_ASCII_OUTER) if raw.isascii() else _OUTER.sub("", raw)
    flags = _ENDS if raw.rstrip(_CLOSING).endswith(_STOPS) else 0
    lower, value = core.casefold(), ""
    if not core:
        flags |= _UNIT if raw == "%" else _EMPTY
        lower = raw
    elif core[0].isdecimal():
        if _IS_NUMBER.fullmatch(core):
            flags |= _NUMBER
            if raw.rstrip(".,;:!?)]").endswith("%"):
                flags |= _WITH_UNIT
                value = "%"
        elif (m := _NUMBER_UNIT.fullmatch(core)) and m[2].lower() in UNITS:
            flags |= _NUMBER | _WITH_UNIT
            lower, value = m[1], m[2].lower()
    else:
        if lower in UNITS:
            flags |= _UNIT
        if core[0].isupper() and len(core) > 1 and not core[1:].isupper():
            flags |= _TITLE
    return flags, lower, value


class Lexicon(dict):
    """Raw word to a number; arrays hold, by number, the hash of its literal token and what it looks like."""

    def __init__(self) -> None:
        super().__init__()
        # Number 0 is no word: the arrays are never empty.
        self.words: list[str] = [""]
        self._hashes, self._flags = array("Q", [0]), array("B", [0])

    @property
    def hashes(self) -> np.ndarray:
        return np.frombuffer(self._hashes, dtype=np.uint64)

    @property
    def flags(self) -> np.ndarray:
        return np.frombuffer(self._flags, dtype=np.uint8)

    def __missing__(self, raw: str) -> int:
        at = self[raw] = len(self.words)
        flags, lower, _ = _look(raw)
        self.words.append(raw)
        self._hashes.append(_hash(lower))
        self._flags.append(flags)
        return at


_KINDS = ("", NUMBER, NAME, UNIT)
_KIND_HASH = np.array([0, *(_hash(k) for k in _KINDS[1:])], dtype=np.uint64)


class Template:
    """The template tokens of texts, one text after the other: hash, kind and text per token, and on demand their words."""

    def __init__(self, texts: str | Sequence[str], lexicon: Lexicon, name_first: bool = False):
        """Of one text or several; with ``name_first`` the first word of a text may be a name."""
        raw, ends = [], [0]
        for text in [texts] if isinstance(texts, str) else texts:
            raw += text.split()
            ends.append(len(raw))
        ids = np.fromiter(map(lexicon.__getitem__, raw), dtype=np.int64, count=len(raw))
        flags = lexicon.flags[ids]
        lengths = np.diff(ends)
        starts = np.ones(len(ids), dtype=bool)
        starts[1:] = (flags[:-1] & _ENDS) != 0
        starts[np.array(ends[:-1], dtype=np.int64)[lengths > 0]] = not name_first
        used = (flags & _EMPTY) == 0
        text = np.repeat(np.arange(len(lengths)), lengths)
        self._assemble(ids[used], flags[used], starts[used], text[used], lexicon)

    def folded(self) -> Template:
        """The same texts with names as words."""
        out = Template.__new__(Template)
        out._assemble(self.ids, self.flags, np.ones(len(self.ids), dtype=bool), self.of_word, self.lexicon)
        return out

    def _assemble(self, ids: np.ndarray, flags: np.ndarray, starts: np.ndarray, text: np.ndarray, lexicon: Lexicon) -> None:
        """A titled word is a name unless it is among ``starts``."""
        kind = np.zeros(len(ids), dtype=np.uint8)
        kind[(flags & _NUMBER) != 0] = 1
        kind[((flags & _TITLE) != 0) & ~starts] = 2
        within = text[1:] == text[:-1]
        follows = np.zeros(len(ids), dtype=bool)
        follows[1:] = (kind[:-1] == 1) & ((flags[:-1] & _WITH_UNIT) == 0) & within
        kind[((flags & _UNIT) != 0) & follows] = 3
        # A name of several words is one slot; a number written together with its unit is two.
        goes_on = np.zeros(len(ids), dtype=bool)
        goes_on[1:] = (kind[1:] == 2) & (kind[:-1] == 2) & within
        first = np.flatnonzero(~goes_on)
        words = np.diff(np.append(first, len(ids)))
        times = np.where((flags[first] & _WITH_UNIT) != 0, 2, 1)
        self.at, self.words = np.repeat(first, times), np.repeat(words, times)
        self.unit_part = np.zeros(len(self.at), dtype=bool)
        self.unit_part[1:] = self.at[1:] == self.at[:-1]
        self.kind = np.where(self.unit_part, 3, kind[self.at]).astype(np.uint8)
        self.hashes = np.where(self.kind > 0, _KIND_HASH[self.kind], lexicon.hashes[ids[self.at]]) if len(ids) else np.empty(0, np.uint64)
        self.ids, self.flags, self.of_word, self.lexicon = ids, flags, text, lexicon
        self.text = text[self.at]

    def __len__(self) -> int:
        return len(self.at)

    def starts(self) -> np.ndarray:
        """Where each token begins, in a numbering that both forms of the texts share."""
        return 2 * self.at + self.unit_part

    def windows(self, length: int) -> np.ndarray:
        """A hash per window of ``length`` tokens; some may lie across two texts."""
        n = len(self) - length + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        out = np.full(n, np.uint64(length))
        for i in range(length):
            out = (out ^ self.hashes[i : i + n]) * _P
            out ^= out >> np.uint64(29)
        return out

    def within(self, length: int) -> np.ndarray:
        """Whether each window lies in one text."""
        return self.text[: max(len(self) - length + 1, 0)] == self.text[length - 1 :]

    def telling(self, length: int) -> np.ndarray:
        """Where the windows start that have at least TELLING words besides their slots."""
        n = len(self) - length + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        words = np.concatenate(([0], np.cumsum(self.kind == 0)))
        return np.flatnonzero(words[length:] - words[:-length] >= TELLING)

    def shown(self, start: int, length: int) -> tuple[str, list[str]]:
        """The template of a window and the values of its slots, in order."""
        tokens, slots = [], []
        for i in range(start, start + length):
            own = [_look(self.lexicon.words[k]) for k in self.ids[self.at[i] : self.at[i] + self.words[i]]]
            value = own[0][2] if self.unit_part[i] else " ".join(lower for _, lower, _ in own)
            kind = _KINDS[self.kind[i]]
            tokens.append(kind or value)
            if kind:
                slots.append(f"{kind}{value}")
        return " ".join(tokens), slots


_INDEX = (
    "item string, form int, place int, start int, in_named boolean, n_named int, n_folded int, length int, hash long, "
    "template string, slots array<string>"
)


def _item_windows(window: int):
    """The windows of each item in both forms. Its first word may be a name in a document where no sentence ends before
    it, so windows that begin with it are filed both ways."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lexicon, out = Lexicon(), []
            for item, text in zip(batch["item"], batch["body"], strict=True):
                plain, named = Template(text, lexicon), Template(text, lexicon, name_first=True)
                forms = (plain, plain.folded())
                places = [t.telling(window) for t in forms]
                totals, in_named = [len(p) for p in places], set(plain.starts()[places[0]].tolist())
                for form, template in enumerate(forms):
                    hashes, starts = template.windows(window).view(np.int64), template.starts().tolist()
                    for place in places[form].tolist():
                        shown = template.shown(place, window)
                        out.append((item, form, place, starts[place], starts[place] in in_named, *totals, window, hashes[place], *shown))
                if totals[0] and places[0][0] == 0 and named.kind[0] != plain.kind[0] and 0 in named.telling(window):
                    first = named.windows(window).view(np.int64)[0]
                    out.append((item, 0, 0, 0, True, *totals, window, first, *named.shown(0, window)))
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _INDEX.split(", ")])

    return cut


def index_items(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The stored index: item, form, place and start of its windows, how many there are by form, hash, template, slots."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), text_or_empty(text).alias("body"))
    return stored(items.mapInPandas(_item_windows(window), _INDEX), "item-windows")


def _window_map(index: DataFrame) -> np.ndarray:
    """Which low bits occur among the index's hashes: 2 ** MAP_BITS flags, whatever the size of the index."""
    low = index.select(F.col("hash").bitwiseAND(F.lit((1 << MAP_BITS) - 1)).cast("int").alias("low")).distinct()
    found = np.zeros(1 << MAP_BITS, dtype=bool)
    found[[r["low"] for r in low.toLocalIterator()]] = True
    return np.packbits(found)


_HITS = "doc_id string, k_hash long, k_len int, form int, spot int, hash long, template string, slots array<string>"


def _portions(bodies: Sequence[str]) -> Iterator[slice]:
    """Rows next to one another of AT_ONCE characters together, or one longer one."""
    start = held = 0
    for at, body in enumerate(bodies):
        if held and held + len(body) > AT_ONCE:
            yield slice(start, at)
            start, held = at, 0
        held += len(body)
    yield slice(start, len(bodies))


def _document_windows(window: int, packed_map):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, mask = np.unpackbits(packed_map.value).view(bool), np.uint64((1 << MAP_BITS) - 1)
        lexicon = Lexicon()
        for batch in batches:
            bodies, named = batch["body"].tolist(), list(zip(batch["doc_id"], batch["k_hash"], batch["k_len"], strict=True))
            out = []
            for rows in _portions(bodies):
                if len(lexicon) > REMEMBERED:
                    lexicon = Lexicon()
                texts, own = bodies[rows], named[rows]
                plain = Template(texts, lexicon)
                for form, template in enumerate((plain, plain.folded())):
                    hashes = template.windows(window)
                    found = np.flatnonzero(known[hashes & mask] & template.within(window))
                    text = template.text[found]
                    spots = found - np.searchsorted(template.text, text)
                    for at, i, spot, signed in zip(found.tolist(), text.tolist(), spots.tolist(), hashes[found].view(np.int64).tolist(), strict=True):
                        out.append((*own[i], form, spot, signed, *template.shown(at, window)))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "k_hash", "k_len", "form", "spot", "hash", "template", "slots"])

    return find


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """One row per document and item that it contains: doc_id, item_id, n_windows, n_found, share, reparameterised
    (some slot has another value than in the item), and the row key.

    NULL and empty texts contain nothing. Windows with fewer than TELLING words besides their slots are not looked for;
    items without another window, also those shorter than a window, are never found;
    items of equal text are found alike. NULL item ids are left out, documents with a NULL id are rows like
    any other; rows with equal id and text are one. Extra columns are not looked at. Either table may be empty.
    """
    spark = docs.sparkSession
    index = index_items(benchmark.filter(F.col(item_id).isNotNull()), item_id, item_text, window)
    body = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.xxhash64(body).alias("k_hash"),
        F.octet_length(body).alias("k_len"),
        body.alias("body"),
    )
    packed = spark.sparkContext.broadcast(_window_map(index))
    hits = stored(rows.mapInPandas(_document_windows(window, packed), _HITS), "window-hits")
    own = index.drop("length").withColumnRenamed("slots", "item_slots")
    met = hits.join(own, ["form", "hash", "template"]).select(
        "doc_id", "k_hash", "k_len", "item", "form", "place", "start", "in_named", "n_named", "n_folded", (F.col("spot") - F.col("place")).alias("line"), "slots", "item_slots"
    )
    met = stored(met.distinct(), "window-matches")
    found = _consistent(met, share)
    kinds = {"doc_id": docs.schema[doc_id].dataType, "item_id": benchmark.schema[item_id].dataType}
    return found.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


def _consistent(met: DataFrame, share: float) -> DataFrame:
    line = ["k_hash", "k_len", "item", "form", "line"]
    pairs = met.filter("size(slots) > 0").select("doc_id", *line, "place", F.inline(F.arrays_zip("item_slots", "slots")))
    values = pairs.groupBy("doc_id", *line, "item_slots").agg(F.min("slots").alias("least"), F.max("slots").alias("most"))
    clashing = values.filter("least != most").select(
        F.col("doc_id").alias("c_id"), *[F.col(c).alias(f"c_{c}") for c in line], F.col("item_slots").alias("c_slot")
    )

    def same(other: str) -> Column:
        each = [F.col(c) == F.col(f"{other}_{c}") for c in line]
        out = F.col("doc_id").eqNullSafe(F.col(f"{other}_id"))
        for x in each:
            out = out & x
        return out

    broken = (
        pairs.join(clashing, same("c") & (F.col("item_slots") == F.col("c_slot")))
        .select(F.col("doc_id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in line], F.col("place").alias("b_place"))
        .distinct()
    )
    sound = met.join(broken, same("b") & (F.col("place") == F.col("b_place")), "left_anti")
    key = ["doc_id", "k_hash", "k_len", "item", "n_named", "n_folded"]
    places = sound.groupBy(*key, "start").agg(
        F.max(F.col("in_named").cast("int")).alias("named"),
        F.max("form").alias("folded"),
        F.min((F.col("slots") != F.col("item_slots")).cast("int")).alias("other"),
    )
    found = places.groupBy(*key).agg(F.sum("named").alias("named"), F.sum("folded").alias("folded"), F.max("other").alias("other"))
    # The form of which more is found; the first one if both are alike.
    first = F.col("named") * F.col("n_folded") >= F.col("folded") * F.col("n_named")
    first = (F.col("n_named") > 0) & ((F.col("n_folded") == 0) | first)
    total, n_found = F.when(first, F.col("n_named")).otherwise(F.col("n_folded")), F.when(first, F.col("named")).otherwise(F.col("folded"))
    found = found.withColumns({"total": total.cast("long"), "n_found": n_found})
    return found.filter(F.col("n_found") >= F.lit(share) * F.col("total")).select(
        "doc_id",
        F.col("item").alias("item_id"),
        F.col("total").alias("n_windows"),
        "n_found",
        (F.col("n_found") / F.col("total")).alias("share"),
        (F.col("other") == 1).alias("reparameterised"),
        "k_hash",
        "k_len",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents that contain no item, columns unchanged; options as in ``find_contaminated``."""
    found = find_contaminated(docs, benchmark, doc_id, text, **options)
    keys = found.select(F.col("doc_id").alias("k_id"), "k_hash", "k_len").distinct()
    return without_rows(docs, stored(keys, "contaminated"), doc_id, text)
