"""Look-back windows: the last rows up to a cut-off as one flat, time-major array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.functions import null_if_nan
from hydroflow.operators.positions import global_positions, null_safe_join


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: Sequence[str],
    cutoffs: DataFrame,
    window: int,
) -> DataFrame:
    """``(keys, cutoff, status, n_rows, lookback)`` for every row of ``cutoffs`` (keys, cutoff).

    ``lookback`` is ``[t0f0, t0f1, …, t1f0, …]`` over the last ``window`` rows up to and including the cut-off
    row (the first one if its time repeats), and NULL unless the status is ``ok``. Other states:
    ``no_cutoff`` (time not in the data), ``short_history``, ``missing_values``. A NULL key is a group like any other.

    Only keys and times get positions and are stored. Positions are cut into chunks of ``window`` rows, a window
    touches at most two of them, so rows and cut-offs meet in an equi-join on the chunk; features are fetched by a
    semi-join for the rows inside a window only.
    """
    keys, order = list(keys), list(order)
    placed = global_positions(df.select(*keys, *order), keys, order, "_pos")
    asked = cutoffs.select(*keys, "cutoff").distinct()

    times = placed.select(*keys, F.col(order[0]).alias("cutoff"), "_pos")
    found = (
        null_safe_join(times, asked, [*keys, "cutoff"], "left_semi")
        .groupBy(*keys, "cutoff")
        .agg(F.min("_pos").alias("_at"))
    )
    first_chunk = F.floor((F.col("_at") - (window - 1)) / window)
    last_chunk = F.floor(F.col("_at") / window)
    touched = found.withColumn("_chunk", F.explode(F.sequence(first_chunk, last_chunk)))

    rows = placed.withColumn("_chunk", F.floor(F.col("_pos") / window))
    inside = (F.col("_pos") <= F.col("_at")) & (F.col("_pos") > F.col("_at") - window)
    met = null_safe_join(rows, touched.withColumnRenamed("cutoff", "_cutoff"), [*keys, "_chunk"], also=inside)
    needed = met.select(*keys, *order, "_cutoff", "_pos")
    # Rows that repeat a whole sort key are told apart by their number, in the order of their values.
    sort_key = [*keys, *order]
    needed = needed.withColumn("_nth", F.row_number().over(W.partitionBy(*sort_key, "_cutoff").orderBy("_pos")))
    wanted = needed.select(*sort_key).distinct()
    values = df.select(*sort_key, F.array(*[null_if_nan(c) for c in features]).alias("_values"))
    values = null_safe_join(values, wanted, sort_key, "left_semi")
    values = values.withColumn("_nth", F.row_number().over(W.partitionBy(*sort_key).orderBy("_values")))

    windows = (
        null_safe_join(needed, values, [*sort_key, "_nth"])
        .select(*keys, F.col("_cutoff").alias("cutoff"), "_pos", "_values")
        .groupBy(*keys, "cutoff")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_values"))).alias("_rows"))
        .select(
            *keys,
            "cutoff",
            F.size("_rows").alias("n_rows"),
            F.flatten(F.col("_rows._values")).alias("_flat"),
        )
    )
    status = (
        F.when(F.col("n_rows").isNull(), F.lit("no_cutoff"))
        .when(F.col("n_rows") < window, F.lit("short_history"))
        .when(F.exists("_flat", lambda x: x.isNull()), F.lit("missing_values"))
        .otherwise(F.lit("ok"))
    )
    return (
        null_safe_join(asked, windows, [*keys, "cutoff"], "left")
        .withColumn("status", status)
        .select(
            *keys,
            "cutoff",
            "status",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.when(F.col("status") == "ok", F.col("_flat")).alias("lookback"),
        )
    )
