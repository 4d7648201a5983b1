"""Builder queries, request shapes and time-series operators over telemetry tables."""
