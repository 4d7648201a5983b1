"""DataFrame jobs: scans and sinks, row upgrades, name pairing, planning,
retention, verification and document rewriting."""
