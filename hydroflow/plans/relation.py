"""How power follows discharge: daily means of both, joined on the day, and their correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hydroflow.operators.resample import correlations, daily_mean, join_daily, zone_free


def daily_relation(
    power: DataFrame,
    power_time: str,
    power_values: Sequence[str],
    flow: DataFrame,
    flow_time: str,
    flow_value: str,
    keys: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    """Daily power (empty days as NULL) next to the daily discharge of the same day.

    With a ``zone`` the instants of either side are brought to its clock before their day is taken.
    """
    if zone is not None:
        power, flow = zone_free(power, power_time, zone), zone_free(flow, flow_time, zone)
    return join_daily(
        daily_mean(power, power_time, power_values, keys), daily_mean(flow, flow_time, [flow_value], keys), keys
    )


def relation_strength(
    daily: DataFrame, power_values: Sequence[str], flow_value: str, keys: Sequence[str] = ()
) -> DataFrame:
    """``corr_<value>`` of each power value against the discharge."""
    return correlations(daily, [(v, flow_value, f"corr_{v}") for v in power_values], keys)
