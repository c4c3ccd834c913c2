"""Spark jobs for a very large document archive: listings, reading journals, cases and reports."""
