"""Scans: Parquet tables, JDBC, delimited text, workbooks, text files,
HTML pages, vector collections, literals and generated sequences."""
