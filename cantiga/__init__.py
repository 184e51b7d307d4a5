"""Lyrics catalogue jobs on PySpark: pages in, a clean versioned catalogue out."""
