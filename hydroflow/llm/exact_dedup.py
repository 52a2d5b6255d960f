"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

1. One narrow pass gives every text its length and 64-bit hash. Only texts that share both with another row can
   be equal to one; the others are done, and their text is never moved.
2. The rest is cut into chunks where the content says so: equal texts have equal cuts. A chunk's identifier is its
   64-bit hash, and identifiers are verified: distinct chunks are brought together by hash once (copies fold
   before the shuffle), and chunks of different content under one hash get a running number.
3. A recipe is the ordered list of a text's identifiers. Rows are grouped by recipe, so what is compared and
   shuffled is eight bytes a chunk, however long the documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroflow.llm.common import by_bitmap, keep_one_of_each, key_bitmap, text_or_empty
from hydroflow.session import stored

# Where a chunk may end, by its last letters: rare in prose, in digits and codes, and in scripts without blanks.
_ENDS = (
    r"[aeou][nrst]\s[dfmw]|[\u0430\u0432\u0435\u0438\u043e][\u043d\u0440\u0441\u0442]\s[\u0432\u043d\u043f\u0441]|"
    r"[0-3bdfhj][4-7lnp][89tvxz][0-7a-m]|[A-H][I-P][Q-Z]|[\u4e00-\u527f]{3}"
)
#: A chunk ends at the first such place after 256 characters, or after 8192. Places are about as far apart as the least
#: length or farther, so that cuts follow the content and not the cut before: texts that differ in one place soon agree again. Only a text that
#: has no such place for 8192 characters, one that repeats a short piece for instance, is cut by length.
CHUNK = rf"((?s:.{{256}}.{{0,7932}}?(?:{_ENDS})|.{{1,8192}}))"


def chunks(text: Column, pattern: str = CHUNK) -> Column:
    """The text's chunks in order; joined they give the text again. None for an empty text."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _prints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(body).alias("n_bytes"),
        F.xxhash64(body).alias("print"),
        body.alias("body"),
    )


def _recipes(rows: DataFrame, shared: DataFrame, pattern: str) -> DataFrame:
    """Rows whose print is among ``shared`` with their recipe: the verified identifiers of their chunks, in order.

    ``rows`` are those that may be. Digest and recipe are made where a text is read; what crosses an exchange is a row's
    id, print and recipe, and every distinct chunk once.
    """
    digest = F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")
    cut = rows.select("doc_id", "n_bytes", "print", digest, chunks(F.col("body"), pattern).alias("parts"))
    # Every distinct chunk moves once; the partial aggregation folds copies before the shuffle.
    hashed = cut.select(F.explode("parts").alias("chunk")).distinct().withColumn("chunk_hash", F.xxhash64("chunk"))
    clashing = stored(
        hashed.groupBy("chunk_hash").count().filter("count > 1").select("chunk_hash"), "chunk-clashes"
    )
    recipes = cut.select(
        "doc_id", "n_bytes", "print", "text_sha256", F.transform("parts", lambda c: F.xxhash64(c)).alias("recipe")
    )
    if not clashing.isEmpty():
        number = F.row_number().over(Window.partitionBy("chunk_hash").orderBy("chunk"))
        recipes = _with_numbers(cut, hashed.join(clashing, "chunk_hash").withColumn("number", number))
    return recipes.join(shared, ["print", "n_bytes"], "left_semi")


def _with_numbers(cut: DataFrame, numbered: DataFrame) -> DataFrame:
    """Recipes where some hash stands for several contents: the identifier gets the content's number."""
    row = cut.withColumn("row", F.monotonically_increasing_id())
    row = stored(row, "cut-rows")
    parts = row.select("row", F.posexplode("parts").alias("place", "chunk"))
    parts = parts.withColumn("chunk_hash", F.xxhash64("chunk"))
    marked = parts.join(numbered, ["chunk_hash", "chunk"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("place", "number"))).alias("marks")
    )
    hashes = F.transform("parts", lambda c: F.xxhash64(c))
    return row.join(marked, "row", "left").select(
        "doc_id",
        "n_bytes",
        "print",
        "text_sha256",
        F.concat(
            hashes,
            F.coalesce(
                F.flatten(F.transform("marks", lambda m: F.array(m["place"].cast("long"), m["number"].cast("long")))),
                F.array().cast("array<bigint>"),
            ),
        ).alias("recipe"),
    )


def find_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", pattern: str = CHUNK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (and n_bytes, print).

    Of equal texts the row with the largest doc_id is kept, exactly one row of each text also where that id occurs
    several times. A NULL text counts as empty, all empty texts are equal; a NULL doc_id is smaller than any other
    and is kept only if all ids of its text are NULL. Other columns are not looked at. No documents: no rows.
    """
    prints = _prints(docs, doc_id, text)
    shared = stored(
        prints.groupBy("print", "n_bytes").count().filter("count > 1").select("print", "n_bytes"), "shared-prints"
    )
    digest = F.sha2(F.col("body").cast("binary"), 256)
    alone = prints.select("doc_id", "n_bytes", "print", digest.alias("text_sha256")).join(shared, ["print", "n_bytes"], "left_anti")
    alone = alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        "n_bytes",
        "print",
    )
    # The bitmap clears most rows without a shuffle.
    shared_bits = key_bitmap(shared, ["print", "n_bytes"])
    maybe = by_bitmap(prints, [F.col("print"), F.col("n_bytes")], shared_bits)[1]
    recipes = _recipes(maybe, shared, pattern)
    of_text = ["print", "n_bytes", "recipe"]
    rows = stored(
        recipes.groupBy(*of_text, "doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("times")), "recipes"
    )
    # Written, so that both sides of the join are dealt for it and a text of many documents can be split.
    groups = stored(
        rows.groupBy(*of_text).agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")), "recipe-groups"
    )
    named = rows.join(groups, of_text).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    named = named.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
        "n_bytes",
        "print",
    )
    return alone.unionByName(named)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each text left, columns unchanged; which one as in ``find_copies``."""
    found = find_copies(docs, doc_id, text).filter("group_size > 1")
    keys = [F.col("doc_id").alias("k_id"), F.col("print").alias("k_hash"), F.col("n_bytes").alias("k_len"), "kept"]
    by_key = stored(
        found.select(*keys)
        .groupBy("k_id", "k_hash", "k_len")
        .agg(F.count(F.lit(1)).alias("times"), F.max("kept").alias("kept")),
        "copies",
    )
    return keep_one_of_each(docs, by_key, doc_id, text)
