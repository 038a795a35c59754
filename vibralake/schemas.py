"""Schemas of inputs and outputs. Column order of the two feature tables is contractual."""

from __future__ import annotations

#: A decoded member of an archive: one row a file.
WAVEFORM = (
    "path string, member string, system string, system_id string, sensor_dir string, sensor_id string, "
    "timestamp timestamp_ntz, hour timestamp_ntz, file_size bigint, n_records bigint, t_ms array<bigint>, v array<float>"
)
#: What became of every archive and member.
STATUS = "path string, member string, ok boolean, n_records bigint, error string"
DYNAMIC_COLUMNS = ("time", "sensor_id", "ptp", "mean", "std", "rms", "noise_level", "data_count", "is_valid", "1st_mode", "2nd_mode", "3rd_mode")
STATIC_COLUMNS = ("time", "sensor_id", "mean", "std", "min", "max", "ptp", "data_count", "is_valid")

#: Sampling rate in Hz, the common frequency grid, and validity bounds.
SAMPLING_RATE = 100.0
GRID_LOW, GRID_HIGH, GRID_POINTS = 0.5, 30.0, 2000
FEW_RECORDS, MANY_RECORDS, VALUE_BOUND = 320_000, 400_000, 100.0
