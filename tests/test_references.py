import itertools

import pytest

from groundmill.operators import references as R

KEYS = ["a", "b"]
TARGETS = [("x", "1"), ("x", "2"), ("y", None), ("z", "9")]
REFS = [(i, a, b, "k") for i, (a, b) in enumerate(itertools.product(["x", "y", "q", None], ["1", "9", None])) for _ in range(2)]


def brute(ref, match):
    _, a, b, _ = ref
    key, null = (a, b), [v is None for v in (a, b)]
    if all(null):
        return False
    if any(null):
        if match == "simple":
            return False
        if match == "full":
            return True
    return not any(all(k is None or k == t for k, t in zip(key, target, strict=True)) for target in TARGETS)


@pytest.mark.parametrize("match", R.MATCH)
def test_match_semantics_against_brute_force(spark, match):
    refs = spark.createDataFrame(REFS, "id int, a string, b string, missing_key string")
    targets = spark.createDataFrame(TARGETS, "a string, b string")
    got = sorted(r["id"] for r in R.orphans(refs, targets, KEYS, match).collect())
    assert got == sorted(r[0] for r in REFS if brute(r, match))


def test_empty_sides(spark):
    refs = spark.createDataFrame(REFS, "id int, a string, b string, c string")
    none = spark.createDataFrame([], "a string, b string")
    assert R.orphans(refs, none, KEYS).count() == 12
    assert R.orphans(refs.limit(0), refs.select("a", "b"), KEYS, "partial").count() == 0
    with pytest.raises(ValueError):
        R.orphans(refs, none, KEYS, "other")


def test_hot_key(spark):
    refs = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('k', id)) AS a")
    targets = spark.range(1500).selectExpr("concat('k', id) AS a")
    assert R.orphans(refs, targets, ["a"]).count() == 1000 + sum(1 for i in range(1500, 3000) if i % 3)
