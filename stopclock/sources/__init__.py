from stopclock.sources.folders import MODES, path_exists, write_together
from stopclock.sources.timetable import read_csv, read_parquet, timed_path, write_lines, write_result

__all__ = [
    "MODES",
    "path_exists",
    "read_csv",
    "read_parquet",
    "timed_path",
    "write_lines",
    "write_result",
    "write_together",
]
