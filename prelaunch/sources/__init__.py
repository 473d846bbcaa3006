"""Sources and sinks: Parquet/CSV scans, feature/result/model persistence."""

from prelaunch.sources.tables import read_table, present, require_path  # noqa: F401
from prelaunch.sources.games import GAMES_SCHEMA, read_games  # noqa: F401
