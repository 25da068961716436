import itertools
from collections import Counter

import numpy as np
import pytest

from tixprep.operators import product as PR

COLS = ["category", "subcategory", "assignment_group"]
SCHEMA = "category string, subcategory string, assignment_group string, n string, number int"


def brute(rows):
    seen = Counter(r[:3] for r in rows if None not in r[:3])
    levels = [sorted({r[i] for r in rows if r[i] is not None}) for i in range(3)]
    return {c: seen.get(c, 0) for c in itertools.product(*levels)}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA)


def made(seed, n, sizes):
    rng = np.random.default_rng(seed)
    return [tuple(None if rng.random() < 0.05 else f"{'abc'[i]}{rng.integers(0, s):02d}" for i, s in enumerate(sizes)) for _ in range(n)]


CASES = [made(0, 60, (3, 4, 5)), made(2, 5, (9, 9, 9)), list(itertools.product("ab", "cd", "ef")), [*itertools.product("ab", "cd", "ef")][1:-1]]


@pytest.mark.parametrize("rows", CASES)
def test_against_the_product(spark, rows):
    want, df = brute(rows), frame(spark, rows)
    key = lambda r: tuple(r[c] for c in COLS)
    assert {key(r): r["n"] for r in PR.full_combos(df).collect()} == want
    zeros = sorted(c for c, n in want.items() if n == 0)
    assert sorted(key(r) for r in PR.unseen_combos(df, k=4).collect()) == sorted(zeros[-4:])
    assert sorted(key(r) for r in PR.unseen_combos(df, k=4, last=False).collect()) == zeros[:4]
    for end, part in (("top", sorted(want.items(), key=lambda x: (-x[1], x[0]))[:3]), ("bottom", sorted(want.items(), key=lambda x: (x[1], [[-ord(c) for c in s] for s in x[0]]))[:3])):
        assert sorted((key(r), r["n"]) for r in PR.full_top_bottom(df, k=3).collect() if r["end"] == end) == sorted(part)
    total = len(rows)
    for r in PR.full_threshold_report(df).collect():
        below = [n for n in want.values() if (round(n / total * 100, 4) if r["kind"] == "percentage" else n) < r["threshold"]]
        assert (r["combos"], r["combos_below"], r["rows_affected"]) == (len(want), len(below), sum(below))


def test_numbers_beyond_64_bits(spark):
    """Ranks and their labels are exact where the product exceeds a long."""
    n = 300
    cols = [f"c{i}" for i in range(9)]  # 300^9 > 10^22
    rows = [tuple(f"v{(k * (i + 1)) % n:03d}" for i in range(9)) for k in range(n)]
    rows += [tuple(f"v{k:03d}" for _ in range(9)) for k in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    tables, sizes = PR.level_tables(df, cols)
    assert PR.product_size(sizes) == n ** 9 > 2 ** 63
    ranked = PR.ranked_combos(df, cols, tables, sizes)
    for r in ranked.collect():
        number = 0
        for c in cols:
            number = number * n + int(r[c][1:])
        assert int(r["number"]) == number
    back = PR.unranked(ranked.select("number", *[ranked[c].alias(f"old_{c}") for c in cols]), cols, tables, sizes).collect()
    assert len(back) == ranked.count() and all(r[c] == r[f"old_{c}"] for r in back for c in cols)
    last = PR.unseen_combos(df, cols, k=1).collect()[0]  # v299 everywhere is seen
    assert [last[c] for c in cols] == ["v299"] * 8 + ["v298"]
    with pytest.raises(ValueError):
        PR.full_combos(df, cols)


def test_no_rows(spark):
    df = frame(spark, [])
    assert PR.full_combos(df).count() == PR.unseen_combos(df).count() == PR.full_top_bottom(df).count() == 0
    assert all(r["combos"] == 0 and r["combos_pct"] is None for r in PR.full_threshold_report(df).collect())
    nulls = frame(spark, [(None, "a", "b"), ("c", None, "b")])
    assert [tuple(r) for r in PR.full_combos(nulls).collect()] == [("c", "a", "b", 0)]
