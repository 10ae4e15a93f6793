"""starbi — a Spark-native e-commerce BI pipeline.

Raw order tables are cleaned into a star schema at order-item grain
(one fact, five dimensions), audited, and queried with DataFrame plans
that Catalyst can prune, push down and re-plan at runtime (AQE).

Layout
------
``functions``  Column -> Column helpers (text cleaning, day arithmetic,
               exact HALF_UP rounding of ratios).
``sources``    readers (raw CSV, TPC-H-like test tables, persisted star)
               and writers (CSV / Parquet sinks with a star-join layout).
``operators``  ETL builders, distributed ranking (exact NTILE, top-k dense
               rank), quality / integrity audits, BI measures.
``plans``      the star pipeline and every analytical query.
"""

from starbi.plans.star import Star, build_star, star_for  # noqa: F401

__all__ = ["Star", "build_star", "star_for"]
