"""Correlation of every pair of many columns in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroflow.functions import null_if_nan
from hydroflow.operators.positions import null_safe_join


def correlation_matrix(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, a, b, n, corr)`` for every pair of columns, a before b: Pearson over the rows where both are present.

    A row gives its pairs of present values, and counts, sums and products of each pair add up in one aggregation, so that
    no pair needs a pass of its own. Values are taken relative to the mean of their column, which keeps the sums of
    products small. NaN counts as missing; a correlation that is undefined (a constant side, fewer than two rows) is
    NULL, also where no row has both. NULL keys are a group like any other.
    """
    keys, names = list(keys), list(columns)
    values = F.array(*[null_if_nan(c) for c in names])
    rows = df.select(*keys, values.alias("_values"))
    means = rows.groupBy(*keys).agg(F.array(*[F.avg(F.get("_values", F.lit(i))) for i in range(len(names))]).alias("_means"))
    # One row for each group of keys.
    near = null_safe_join(rows, means, keys) if keys else rows.crossJoin(F.broadcast(means))
    shifted = near.select(*keys, F.zip_with("_values", "_means", lambda x, m: x - m).alias("v"))
    pairs = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.get("v", F.lit(i)).alias("x"), F.get("v", F.lit(j)).alias("y"))
        for i in range(len(names))
        for j in range(i + 1, len(names))
    ]
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(both, F.col("x")), F.when(both, F.col("y"))
    sums = shifted.select(*keys, F.inline(F.array(*pairs))).groupBy(*keys, "i", "j").agg(
        F.count(x).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy")
    )
    co = F.expr("xy - sx * sy / n")
    spread = F.expr("(xx - sx * sx / n) * (yy - sy * sy / n)")
    labels = F.array(*[F.lit(c) for c in names])
    return sums.select(
        *keys,
        F.get(labels, F.col("i")).alias("a"),
        F.get(labels, F.col("j")).alias("b"),
        "n",
        F.when((F.col("n") > 1) & (spread > 0), F.try_divide(co, F.sqrt(F.greatest(spread, F.lit(0.0))))).alias("corr"),
    )
