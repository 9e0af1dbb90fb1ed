"""Inputs: message bus, JDBC tables and the driver's parquet tables."""
