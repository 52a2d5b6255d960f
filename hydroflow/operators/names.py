"""Texts looked up in station names through an index of three-letter pieces.

Every place of a name gives one piece, so the index has as many rows as the names have letters. A text fetches the names
that hold its rarest piece, and only those are searched. Texts of up to three letters are themselves pieces, or their
beginnings, and are looked up directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.session import stored

GRAM = 3


def _pieces(text: Column) -> Column:
    """The piece at every place of a text; the last ones are shorter."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substr(text, i, F.lit(GRAM)))


def name_index(things: DataFrame) -> DataFrame:
    """``(gram, iot_id)`` of every place of every name, in lower case."""
    low = F.lower("name")
    return things.filter(F.length("name") > 0).select("iot_id", F.explode(_pieces(low)).alias("gram"))


def _short(asked: DataFrame, index: DataFrame) -> DataFrame:
    """Texts of up to three letters: the smallest id among names with a piece that begins so."""
    heads = F.array(*[F.substring("gram", 1, n) for n in range(1, GRAM + 1)])
    begins = index.select("iot_id", F.explode(F.array_distinct(heads)).alias("part"))
    first = begins.groupBy("part").agg(F.min("iot_id").alias("thing_id"))
    return asked.filter(F.length("part").between(1, GRAM)).join(first, "part").select("part", "thing_id")


def _long(asked: DataFrame, index: DataFrame, things: DataFrame) -> DataFrame:
    """Longer texts: the smallest id among the names with the text's rarest piece that hold the whole text."""
    counts = index.filter(F.length("gram") == GRAM).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    whole = F.array_distinct(F.filter(_pieces(F.col("part")), lambda g: F.length(g) == GRAM))
    held = asked.filter(F.length("part") > GRAM).select("part", F.explode(whole).alias("gram")).join(counts, "gram", "left")
    # A piece that no name has is the rarest, and fetches nothing.
    rarest = held.groupBy("part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("own"))
    fetched = rarest.filter("own.n > 0").select("part", F.col("own.gram").alias("gram")).join(index.distinct(), "gram")
    names = things.select("iot_id", F.lower("name").alias("low"))
    verified = fetched.join(names, "iot_id").filter(F.contains("low", F.col("part")))
    return verified.groupBy("part").agg(F.min("iot_id").alias("thing_id"))


def resolve_names(texts: DataFrame, things: DataFrame) -> DataFrame:
    """``(text, thing_id, station)``: for each distinct ``text`` the station of the smallest id whose name holds it in any
    case, NULL where there is none, or where the text is empty or NULL."""
    asked = texts.select("text").distinct().withColumn("part", F.lower("text"))
    parts = asked.select("part").filter(F.length("part") > 0).distinct()
    index = stored(name_index(things), "name-index")
    found = _short(parts, index).unionByName(_long(parts, index, things))
    names = things.select(F.col("iot_id").alias("thing_id"), F.col("name").alias("station"))
    return asked.join(found, "part", "left").join(names, "thing_id", "left").select("text", "thing_id", "station")
