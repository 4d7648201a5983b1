"""Reading stored tables and deriving telemetry tables from them."""
