"""A lattice of aggregates: sums at every combination of some dimensions, written
once, and the choice of the smallest one that answers a question.

One GROUPING SETS aggregate gives all levels; each is a folder of the written
table, so a question reads one folder.  The sums are mergeable, so a level answers
every question whose dimensions (shown or sliced) it has, by summing over the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = "level"
_APEX = "total"


def level_name(dims: Sequence[str]) -> str:
    return "+".join(dims) or _APEX


def all_levels(hierarchies: Sequence[Sequence[str]]) -> list[tuple[str, ...]]:
    """Every choice of one depth per hierarchy (coarse to fine, or none of it)."""
    cuts = [[tuple(h[:i]) for i in range(len(h) + 1)] for h in hierarchies]
    return [sum(choice, ()) for choice in product(*cuts)]


@dataclass(frozen=True)
class Lattice:
    """``cells`` holds the number of rows of each level (a few numbers)."""
    table: DataFrame
    levels: tuple[tuple[str, ...], ...]
    cells: dict[str, int]

    def route(self, needed: Sequence[str]) -> tuple[str, ...]:
        """The level with the fewest rows that has all ``needed`` dimensions."""
        able = [lv for lv in self.levels if set(needed) <= set(lv)]
        if not able:
            raise ValueError(f"no level has {sorted(needed)}; levels: {list(self.levels)}")
        return min(able, key=lambda lv: (self.cells.get(level_name(lv), 0), len(lv), lv))

    def read(self, needed: Sequence[str], slicers: dict | None = None) -> DataFrame:
        """The rows of the level that answers ``needed`` and the slicers, sliced."""
        slicers = dict(slicers or {})
        level = self.route([*needed, *slicers])
        rows = self.table.where(F.col(LEVEL) == level_name(level))
        for name, values in slicers.items():
            rows = rows.where(F.col(name).isin(list(values)))
        return rows.drop(LEVEL)


def build(rows: DataFrame, hierarchies: Sequence[Sequence[str]], sums: dict[str, Column],
          always: Sequence[str] = ()) -> tuple[DataFrame, tuple[tuple[str, ...], ...]]:
    """All levels of the ``hierarchies`` in one aggregate, each with the columns of
    ``always``; a column that a level lacks is null in it, so ``level`` tells a null
    attribute from one summed over."""
    levels = all_levels(hierarchies)
    dims = [d for h in hierarchies for d in h]
    sets = [[*[F.col(d) for d in lv], *[F.col(a) for a in always]] for lv in levels]
    # grouping() is 1 where a column is summed over
    kept = F.concat_ws("+", *[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
    grouped = rows.groupingSets(sets, *[F.col(c) for c in [*dims, *always]]).agg(
        F.when(kept == "", _APEX).otherwise(kept).alias(LEVEL), *[c.alias(n) for n, c in sums.items()])
    return grouped, tuple(levels)


def opened(table: DataFrame, levels: Sequence[tuple[str, ...]]) -> Lattice:
    """The lattice of a written table (its levels' sizes are counted once)."""
    cells = {r[LEVEL]: r["count"] for r in table.groupBy(LEVEL).count().collect()}
    return Lattice(table, tuple(levels), cells)
