"""Composite operators: ETL builders, distributed ranking, audits, measures."""
