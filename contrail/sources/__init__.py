"""Scans: supplied tables, flight views over them, streams and stores."""

from contrail.sources.tables import (  # noqa: F401
    read_table, flight_events, flight_history, event_airports,
    airlines,
)
