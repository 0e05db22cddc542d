"""Sinks: delimited export, tables, text, workbooks, parameter files."""
