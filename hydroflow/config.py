"""Fixed values and forecast settings shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# They must equal what the sensor catalogue and the plant tables use.
FREQ_TO_TYPE = {
    "1D": "TH_PEGELDATEN_1D",
    "15min": "TH_PEGELDATEN_15MIN",
}
PLANT_TARGETS = {
    "Burgau (Jena)": "power_burgau",
    "Unterpreilipp (Rudolstadt)": "power_rudolstadt",
}
EXPORT_COLUMNS = ("Datum_von", "Datum_bis", "el", "el1")
EXPORT_PREAMBLE_ROWS = 5
GERMAN_TIMESTAMP = "dd.MM.yyyy HH:mm:ss"
FOREST_TREES = 50
FOREST_SEED = 42
DAY_TREND_ROWS = 16
TOP_FEATURES = 10
EXCEEDANCE_ROWS = 20
SAMPLE_ROWS = 5

# The forest: MLlib's largest depth; candidate splits per feature (all distinct values where there are fewer; the
# statistics of every node grow with them); the least number of tasks and the rows that one holds, so that tasks follow
# the rows; and the memory for the statistics of the nodes of one pass.
FOREST_DEPTH = 30
FOREST_BINS = 256
FOREST_TASKS, FOREST_TASK_ROWS = 4, 50_000
FOREST_MEMORY_MB = 1024


@dataclass(frozen=True)
class ForecastConfig:
    """Settings that travel with a fitted forecast model."""

    feature_prefix: str = "discharge"
    target_col: str = "power"
    time_col: str = "ts"
    ma_hours: int = 4
    steps_per_hour: int = 4
    demo_hour: int = 10
    window_steps: int = 96
    horizon_steps: int = 96
    feature_cols: tuple[str, ...] = ()
    source: str = ""

    @property
    def ma_rows(self) -> int:
        return self.ma_hours * self.steps_per_hour

    @property
    def ma_col(self) -> str:
        return f"power_ma_{self.ma_hours}h"
