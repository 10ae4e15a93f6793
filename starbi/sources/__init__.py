"""Readers and writers: raw CSV, the TPC-H-like test tables, the star."""
