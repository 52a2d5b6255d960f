"""Helpers shared by the operators: free column names, row keys, and removing rows by decision."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(col, UPPER, LOWER)


#: Bytes of one text that are cut into words at once.
PIECE = 1 << 22


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks, so that memory does not follow its length."""
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].split()
        at = end


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo a number; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def row_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What a decision about a row is joined back on: its id, and hash and length of its text.

    Rows that agree in all three are taken as copies of one row.
    """
    body = text_or_empty(df[text])
    return [df[doc_id].alias("k_id"), F.xxhash64(body).alias("k_hash"), F.octet_length(body).alias("k_len")]


#: Bits of the filter that is broadcast to find candidate rows: 2 MB at most, whatever the number of keys.
FILTER_BITS = 1 << 24


def key_bitmap(keys: DataFrame, columns: list[str]) -> DataFrame:
    """A bitmap of hashed keys as rows (bucket, bits): at most FILTER_BITS / 32768 rows of 4 KB."""
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    return (
        keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("position"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
    )


def by_bitmap(df: DataFrame, key: list[Column], bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not among the bitmap's, and the rest, which an exact join has to decide.

    Neither is shuffled: the bitmap is broadcast, its size is bounded.
    """
    place, bucket, bits = (fresh(df, n) for n in ("key_place", "key_bucket", "key_bits"))
    joined = df.withColumn(place, F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))).join(
        F.broadcast(bitmap.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))),
        F.bitmap_bucket_number(F.col(place)) == F.col(bucket),
        "left",
    )
    position = F.bitmap_bit_position(F.col(place))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    own = [place, bucket, bits]
    return joined.filter(~is_set).drop(*own), joined.filter(is_set).drop(*own)


def _matches(df: DataFrame, keys: DataFrame, doc_id: str, text: str) -> Column:
    mine = row_key(df, doc_id, text)
    return (
        mine[0].eqNullSafe(keys["k_id"]) & (mine[1] == keys["k_hash"]) & (mine[2] == keys["k_len"])
    )


def _split(df: DataFrame, keys: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    return by_bitmap(df, row_key(df, doc_id, text), key_bitmap(keys, ["k_id", "k_hash", "k_len"]))


def without_rows(df: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key is not among ``dropped`` (k_id, k_hash, k_len, a stored table); columns unchanged.

    Only rows that the bitmap cannot clear take part in the exact join, so most texts are not moved.
    """
    clear, maybe = _split(df, dropped, doc_id, text)
    return clear.unionByName(maybe.join(dropped, _matches(maybe, dropped, doc_id, text), "left_anti"))


def one_row_each(df: DataFrame, keys: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each key of ``keys`` that the frame has, whichever of its repeated rows; columns unchanged."""
    maybe = _split(df, keys, doc_id, text)[1]
    found = maybe.join(keys, _matches(maybe, keys, doc_id, text), "left_semi")
    body = text_or_empty(F.col(text))
    named = [fresh(df, "k_hash"), fresh(df, "k_len")]
    keyed = found.withColumns({named[0]: F.xxhash64(body), named[1]: F.octet_length(body)})
    return keyed.dropDuplicates([doc_id, *named]).drop(*named)


def keep_one_of_each(docs: DataFrame, decided: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Apply stored decisions (k_id, k_hash, k_len, times, kept): rows of a key that is not kept go, and of a kept key
    that occurs several times one row stays. Rows without a decision stay; columns unchanged."""
    only = ["k_id", "k_hash", "k_len"]
    rest = without_rows(docs, decided.filter("not kept or times > 1").select(*only), doc_id, text)
    repeated = decided.filter("kept and times > 1").select(*only)
    return rest if repeated.isEmpty() else rest.unionByName(one_row_each(docs, repeated, doc_id, text))
