"""Readers: landed catalogue pages, observation files and plant tables."""

from hydroflow.sources.pages import (
    page_completeness,
    read_datastreams,
    read_locations,
    read_observations,
    read_pages,
    read_things,
)
from hydroflow.sources.tables import (
    clean_plant_export,
    read_observation_csv,
    read_plant_csv,
    read_plant_export,
    read_wide,
)

__all__ = [
    "clean_plant_export",
    "page_completeness",
    "read_datastreams",
    "read_locations",
    "read_observation_csv",
    "read_observations",
    "read_pages",
    "read_plant_csv",
    "read_plant_export",
    "read_things",
    "read_wide",
]
