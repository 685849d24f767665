"""Timetable and realtime transit analytics as Spark table and stream jobs."""

__version__ = "0.1.0"
