"""Point look-ups of order items by product, seller or customer (K-4).

The fact is stored by month and order.  A second copy, laid out along the
interleaved ranks of the three keys (:mod:`starbi.operators.clustering`), is the
access path for questions about one product, seller or customer: each reads a
small share of its row groups, whichever key is asked for.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbi.operators.clustering import write_by_keys
from starbi.plans.star import Star
from starbi.session import checkpoint_dir, describe_jobs, remove_at_exit

KEYS = ("product_id", "seller_id", "customer_id")
_LOCK = threading.Lock()


def items_by_keys(star: Star) -> DataFrame:
    """The access path, written on first use (beside the star if it is stored)."""
    with _LOCK:
        if star.items_by_keys is None:
            spark = star.fact.sparkSession
            root = star.path or f"{checkpoint_dir(spark).rstrip('/')}/starbi-keys-{uuid.uuid4().hex}"
            remove_at_exit(spark, f"{root}/items_by_keys")
            describe_jobs(spark, "access path: items_by_keys")
            star.items_by_keys = write_by_keys(spark, star.fact, f"{root}/items_by_keys", KEYS)
            describe_jobs(spark, None)
        return star.items_by_keys


def items_of(star: Star, **keys) -> DataFrame:
    """The order items with the given product_id, seller_id and/or customer_id."""
    if not keys or set(keys) - set(KEYS):
        raise ValueError(f"look-ups are by {', '.join(KEYS)}")
    rows = items_by_keys(star)
    for name, value in keys.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows
