"""Scans (raw exports, JDBC, the partitioned activity dataset) and report sinks."""
