"""Readers (season CSV files, parquet test tables, derived stand-ins) and sinks."""
