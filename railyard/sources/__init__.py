"""Readers: timetable XML snapshots, station JSON, Parquet, generated time slots, parametrised SQL."""
