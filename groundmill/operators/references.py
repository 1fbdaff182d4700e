"""References to rows that are not there.

References are composite keys. Rows are grouped by their null mask; each mask is anti-joined on its
non-null columns, under the declared match semantics:

* ``simple``: a reference with any null column is not checked (SQL's MATCH SIMPLE);
* ``partial``: the non-null columns must agree with some target; all null is not checked;
* ``full``: all null is not checked, some null is an orphan at once.

Distinct keys are anti-joined, not rows: partial aggregation folds a hot key before the shuffle, and
the orphans come back to the rows by an inner join that adaptive execution can split. Defined cases:
empty references or targets work; repeated rows stay repeated (callers deduplicate); other columns of
the references are kept, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH = ("simple", "partial", "full")


def orphans(refs: DataFrame, targets: DataFrame, keys: list[str], match: str = "simple") -> DataFrame:
    """The rows of ``refs`` whose key columns name no row of ``targets`` (columns of the same names)."""
    if match not in MATCH:
        raise ValueError(f"match must be one of {MATCH}")
    parts = []
    for mask in product((True, False), repeat=len(keys)):
        held = [k for k, there in zip(keys, mask, strict=True) if there]
        if not held or match == "simple" and not all(mask):
            continue  # not checked under these semantics
        of_mask = refs.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() if there else F.col(k).isNull() for k, there in zip(keys, mask, strict=True)]))
        parts.append(of_mask if match == "full" and not all(mask) else _absent(of_mask, targets, held))
    return reduce(DataFrame.unionByName, parts)


def _absent(refs: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    there = targets.select(*keys).dropna().distinct()
    missing = refs.select(*keys).distinct().join(there, keys, "left_anti")
    return refs.join(missing.withColumnsRenamed({k: f"__missing_{k}" for k in keys}), [F.col(k) == F.col(f"__missing_{k}") for k in keys], "left_semi")


def report(found: DataFrame) -> DataFrame:
    """Orphans per table, field and period."""
    return found.groupBy("source_table", "ref_field", "period").agg(F.count("*").alias("orphan_refs"), F.count_distinct("missing_key").alias("missing_keys"))
