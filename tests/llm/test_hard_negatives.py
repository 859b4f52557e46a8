"""op11: hard negatives against a plain enumeration of all anchors and rows, and on odd rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import types as T

from linkloom.llm import hard_negatives as H

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def brute(rows):
    """The contract, row by row: every anchor against every row."""
    valid = []
    for vid, vec, label in rows:
        if vid is None or label is None or vec is None or any(x is None or not math.isfinite(x) or abs(x) >= H.LARGEST for x in vec):
            continue
        lab = (label + 1) % 10 if vid % 7 == 0 else label
        valid.append((vid, lab, [math.floor(256 * float(x)) for x in vec]))
    valid = list(dict.fromkeys((v, lab, tuple(q)) for v, lab, q in valid))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  (zip stops at the shorter: zeros beyond)
    out = set()
    for aid, alab, aq in valid:
        if aid % 100:
            continue
        scored = sorted({(-dot(aq, q), v, lab) for v, lab, q in valid})
        pos = [(v, -s) for s, v, lab in scored if lab == alab and v != aid][:5]
        for pid, ps in pos:
            neg = [(v, -s) for s, v, lab in scored if lab != alab and 30 * ps <= -100 * s <= 90 * ps][:10]
            out |= {(aid, pid, r, v, ps, ns) for r, (v, ns) in enumerate(neg, 1)}
    return out


def result(df):
    return {tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clustered(n, dims=8, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(10)]
    out = []
    for i in range(n):
        label = rng.randrange(10)
        out.append((i, [c + rng.gauss(0, 0.6) for c in centres[label]], label))
    return out


def test_equals_brute_force_over_many_chunks_windows_and_blocks(spark):
    rows = clustered(700)
    assert result(H.hard_negatives(table(spark, rows), window=4, chunk_bytes=8 * 8 * 60, anchors_per_block=2)) == brute(rows)


def test_windows_bound_every_score():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    q = rng.integers(-300, 300, (300, 6))
    refs = np.linalg.qr(rng.standard_normal((6, 6)))[0][:3]
    norms, angles = H._angles(q, refs)
    pdf = pd.DataFrame({"vec_id": range(300), "lab": 0, "q": list(q), "norm": norms, "angles": list(angles)})
    win = H.Windows(pdf, 6)
    for a in range(0, 300, 17):
        lo, hi = win.bounds(norms[a], angles[a])
        for w in range(len(win)):
            s = win.q[win.rows(w)] @ q[a]
            assert lo[w] <= s.min() and s.max() <= hi[w]


def test_ties_go_to_the_smaller_id(spark):
    # the anchor 0 is relabelled from 0 to 1, the label of its tied positives
    same = [0.5, 0.25]
    rows = [(0, [1.0, 0.0], 0)] + [(i, same, 1) for i in (9, 3, 5, 4, 8, 6, 2)] + [(i, [0.3, 0.0], 2) for i in (12, 11, 13)]
    got = result(H.hard_negatives(table(spark, rows)))
    assert got == brute(rows)
    assert {r[1] for r in got} == {2, 3, 4, 5, 6}
    assert [r[3] for r in sorted(got) if r[1] == 2] == [11, 12, 13]


def test_odd_rows_take_no_part_or_a_defined_one(spark):
    base = clustered(250, dims=4, seed=5)
    odd = [
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (1000, None, 1),
        (1100, [1.0, None, 1.0, 1.0], 2),
        (1200, [1.0, float("nan"), 1.0, 1.0], 3),
        (1300, [float("inf"), 0.0, 0.0, 0.0], 3),
        (1400, [1.0, 1.0, 1.0, 1.0], None),
        (1500, [], 4),
        (1600, [0.9, 0.9], 4),
        (1700, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 5),
        (1800, [1e7, 0.0, 0.0, 0.0], 5),
    ]
    rows = base + odd + base[:40]  # repeated rows too
    assert result(H.hard_negatives(table(spark, rows))) == brute(rows)


def test_empty_table_and_table_without_anchors(spark):
    assert H.hard_negatives(table(spark, [])).count() == 0
    assert H.hard_negatives(table(spark, [(1, [1.0], 1), (2, [1.0], 1)])).count() == 0


def test_extra_columns_with_clashing_names(spark):
    rows = clustered(220, dims=4, seed=8)
    df = table(spark, rows).selectExpr("*", "1 AS lab", "2 AS q", "'x' AS norm", "3 AS row", "4 AS chunk", "5 AS block", "6 AS anchor_id", "7 AS rank")
    assert result(H.hard_negatives(df)) == brute(rows)


@pytest.mark.parametrize("n", [1, 3])
def test_one_label_before_relabelling(spark, n):
    rows = [(i * 100 if i < n else i, [1.0, float(i)], 4) for i in range(50)]
    got = result(H.hard_negatives(table(spark, rows)))
    assert got == brute(rows)
    assert {r[3] % 7 for r in got} <= {0}  # only relabelled rows are of another label
