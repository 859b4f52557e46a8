"""Hard-negative mining by angular triangle filtering.

Every row's quantised vector is stored with its norm and its angles to a few
reference directions.  For an anchor ``a`` and a row ``v`` the triangle
inequality on the sphere bounds the angle between them,
``|θa - θv| <= ∠(a, v) <= θa + θv`` for every reference, so the cosine lies in
an interval; multiplied by the norms, and widened by a rounding margin, it
bounds the integer score.  Rows are sorted by their first angle into windows of
``WINDOW`` rows, each summarised by its ranges of angles and norms; an anchor
scores a window with integers only when the window's bounds can reach what is
sought (the top positives, or the band of a negative).

The work is a stated query set (anchors) against all rows, in blocks: rows are
dealt into chunks of a bounded number of bytes, anchors into blocks of at most
``ANCHORS_PER_BLOCK``; each (chunk, block) pair is one pandas task, which
returns per anchor only its best few, and a window function merges them.  No
label, vector or copy group meets in one task: chunks are taken by a row
number, not by a key.

Defined results (see :func:`hard_negatives`): rows with a null id, label or
vector, a null or non-finite component, or a component of magnitude ``2**20``
or more take no part; vectors of different lengths are compared as if padded
with zeros; an empty vector scores 0 with everything; a row never serves as
positive of an anchor with its own id; rows repeated under one id are ranked
once per distinct (id, score), so copies repeat no output row; ties of score
go to the smaller id; a table without anchors, or without valid rows, gives no
rows, and an anchor without positives (or whose positive scores are all below
zero, an empty band) gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.session import stage_table

# Rows of one window: the unit that an anchor either skips or scores with integers.
WINDOW = 64
# Bytes of quantised vectors one chunk of rows holds (and so one task at most).
CHUNK_BYTES = 8 << 20
# Anchors of one block; with their vectors these are what a task holds besides its chunk.
ANCHORS_PER_BLOCK = 4096
# Reference directions: centroids of the most frequent labels (over all rows).
REFERENCES = 8
# Reference directions are centroids up to this many dimensions, seeded random directions beyond.
CENTROID_DIMS = 1024
# Components of this magnitude or more take no part: scores then stay exact in 64-bit integers.
LARGEST = 2.0**20
# Margins that make float bounds safe for integer scores.
ANGLE_EPS, RELATIVE_EPS = 1e-6, 1e-9

_PREPARED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("lab", T.IntegerType()),
        T.StructField("q", T.ArrayType(T.LongType())),
        T.StructField("norm", T.DoubleType()),
        T.StructField("angles", T.ArrayType(T.DoubleType())),
        T.StructField("row", T.LongType()),
    ]
)
_POSITIVES = T.StructType(
    [
        T.StructField("anchor_id", T.LongType()),
        T.StructField("positive_id", T.LongType()),
        T.StructField("positive_score", T.LongType()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("anchor_id", T.LongType()),
        T.StructField("positive_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("negative_id", T.LongType()),
        T.StructField("positive_score", T.LongType()),
        T.StructField("negative_score", T.LongType()),
    ]
)
_NEGATIVES = T.StructType(
    [
        T.StructField("anchor_id", T.LongType()),
        T.StructField("positive_id", T.LongType()),
        T.StructField("negative_id", T.LongType()),
        T.StructField("positive_score", T.LongType()),
        T.StructField("negative_score", T.LongType()),
    ]
)


def quantised(embeddings: DataFrame, scale: int = 256, relabel_every: int = 7, classes: int = 10) -> DataFrame:
    """``vec_id, lab, q`` of the rows that take part: relabelled, each component ``floor(scale * x)``."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(LARGEST))
    lab = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        lab.cast("int").alias("lab"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("q"),
    )


def _matrix(vectors, dims: int) -> np.ndarray:
    """Rows of int64 vectors, zero-padded to ``dims`` columns."""
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        if len(v):
            out[i, : len(v)] = v
    return out


def _references(q: DataFrame, dims: int) -> np.ndarray:
    """Unit reference directions: centroids of the most frequent labels, or seeded random ones."""
    if dims == 0:
        return np.zeros((1, 1))  # every vector is empty: right angles, scores 0
    found: list[np.ndarray] = []
    if dims <= CENTROID_DIMS:
        sums = [F.sum(F.coalesce(F.get("q", i), F.lit(0)).cast("double")).alias(f"s{i}") for i in range(dims)]
        for row in q.groupBy("lab").agg(F.count(F.lit(1)).alias("n"), *sums).orderBy(F.desc("n"), "lab").limit(REFERENCES).collect():
            v = np.array([row[f"s{i}"] for i in range(dims)], float)
            if np.linalg.norm(v) > 0:
                found.append(v / np.linalg.norm(v))
    if not found:
        rng = np.random.default_rng(7)
        found = [v / np.linalg.norm(v) for v in rng.standard_normal((REFERENCES, dims))]
    return np.array(found)


def _angles(matrix: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of integer rows and their angles to unit references; a zero row gets right angles."""
    x = matrix.astype(np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    with np.errstate(invalid="ignore", divide="ignore"):
        cos = (x @ refs.T) / norms[:, None]
    angles = np.arccos(np.clip(np.nan_to_num(cos, nan=0.0), -1.0, 1.0))
    return norms, angles


def prepared(embeddings: DataFrame, **rules) -> tuple[DataFrame, int]:
    """The stored table ``vec_id, lab, q, norm, angles, row`` and the number of dimensions."""
    q = quantised(embeddings, **rules)
    dims = q.agg(F.max(F.size("q")).alias("d")).first()["d"] or 0
    refs = _references(q, dims)

    def measure(batches):
        for pdf in batches:
            norms, angles = _angles(_matrix(pdf["q"].tolist(), refs.shape[1]), refs)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "lab": pdf["lab"], "q": pdf["q"], "norm": norms, "angles": list(angles), "row": pdf["row"]})

    numbered = q.withColumn("row", F.monotonically_increasing_id())
    return stage_table(numbered.mapInPandas(measure, _PREPARED), "hard-negatives"), max(dims, 1)


class Windows:
    """Rows of one chunk sorted by their first angle, in windows of ``WINDOW`` rows with their ranges."""

    def __init__(self, pdf: pd.DataFrame, dims: int, size: int = WINDOW) -> None:
        self.size = size
        angles = np.array(pdf["angles"].tolist(), float).reshape(len(pdf), -1)
        order = np.argsort(angles[:, 0], kind="stable") if len(pdf) else np.arange(0)
        self.ids = pdf["vec_id"].to_numpy(np.int64)[order]
        self.labs = pdf["lab"].to_numpy(np.int64)[order]
        self.q = _matrix(pdf["q"].to_numpy()[order], dims)
        norms, angles = pdf["norm"].to_numpy(float)[order], angles[order]
        self.starts = np.arange(0, len(order), size)
        cut = lambda a, f: f.reduceat(a, self.starts, axis=0) if len(a) else a
        self.amin, self.amax = cut(angles, np.minimum), cut(angles, np.maximum)
        self.nmin, self.nmax = cut(norms, np.minimum), cut(norms, np.maximum)

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self, w: int) -> slice:
        return slice(self.starts[w], self.starts[w] + self.size)

    def bounds(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Safe lower and upper bounds of an anchor's integer score with each window's rows."""
        near = np.maximum(0.0, np.maximum(self.amin - angles, angles - self.amax)).max(axis=1) - ANGLE_EPS
        far = np.minimum(math.pi, (angles + self.amax).min(axis=1)) + ANGLE_EPS
        cos_hi, cos_lo = np.cos(np.maximum(near, 0.0)), np.cos(np.minimum(far, math.pi))
        hi = norm * np.where(cos_hi >= 0, self.nmax * cos_hi, self.nmin * cos_hi)
        lo = norm * np.where(cos_lo >= 0, self.nmin * cos_lo, self.nmax * cos_lo)
        return lo - np.abs(lo) * RELATIVE_EPS - 1.0, hi + np.abs(hi) * RELATIVE_EPS + 1.0


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best distinct (id, score): higher score first, ties by smaller id."""
    order = np.lexsort((ids, -scores))
    s, i = scores[order], ids[order]
    first = np.ones(len(order), bool)
    first[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])  # copies of a row lie side by side
    return order[first][:k]


def _positives_task(positives: int, dims: int, size: int):
    def task(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or anchors.empty:
            return pd.DataFrame(columns=[f.name for f in _POSITIVES])
        win, qa = Windows(rows, dims, size), _matrix(anchors["q"].to_numpy(), dims)
        out = []
        for i, (aid, norm, angles) in enumerate(zip(anchors["vec_id"], anchors["norm"], anchors["angles"], strict=True)):
            lo, hi = win.bounds(norm, np.asarray(angles, float))
            best_s, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for w in np.argsort(-hi, kind="stable"):
                if len(best_s) >= positives and hi[w] < best_s[-1]:
                    break  # no row of this or a later window reaches the current top
                part = win.rows(w)
                s, ids = win.q[part] @ qa[i], win.ids[part]
                keep = ids != aid
                s, ids = np.concatenate([best_s, s[keep]]), np.concatenate([best_id, ids[keep]])
                top = _top(s, ids, positives)
                best_s, best_id = s[top], ids[top]
            out += [(aid, p, s) for p, s in zip(best_id.tolist(), best_s.tolist(), strict=True)]
        return pd.DataFrame(out, columns=[f.name for f in _POSITIVES])

    return task


def _negatives_task(negatives: int, low: int, high: int, dims: int, size: int):
    def task(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or anchors.empty:
            return pd.DataFrame(columns=[f.name for f in _NEGATIVES])
        win, qa = Windows(rows, dims, size), _matrix(anchors["q"].to_numpy(), dims)
        out = []
        for i, a in enumerate(anchors.itertuples(index=False)):
            pos = [(p["positive_id"], p["positive_score"]) for p in a.positives if p["positive_score"] >= 0]
            if not pos:
                continue  # a negative positive score leaves an empty band
            least = low * min(s for _, s in pos) / 100.0
            most = high * max(s for _, s in pos) / 100.0
            lo, hi = win.bounds(a.norm, np.asarray(a.angles, float))
            hit = np.flatnonzero((hi >= least) & (lo <= most))
            if not len(hit):
                continue
            idx = np.concatenate([np.arange(len(win.ids))[win.rows(w)] for w in hit])
            idx = idx[win.labs[idx] != a.lab]
            s, ids = win.q[idx] @ qa[i], win.ids[idx]
            for pid, ps in pos:
                band = (100 * s >= low * ps) & (100 * s <= high * ps)
                top = _top(s[band], ids[band], negatives)
                out += [(a.vec_id, pid, n, ps, ns) for n, ns in zip(ids[band][top].tolist(), s[band][top].tolist(), strict=True)]
        return pd.DataFrame(out, columns=[f.name for f in _NEGATIVES])

    return task


def hard_negatives(
    embeddings: DataFrame,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
    **rules,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose ``vec_id`` is divisible by ``anchor_every``.  Their
    positives are the ``positives`` best other rows of the same label, their
    negatives per positive the ``negatives`` best rows of another label whose
    score lies in ``[low, high]`` percent of the positive's score (both ends
    included, compared as integers).  Higher scores first, ties by smaller id;
    ``window``, ``chunk_bytes`` and ``anchors_per_block`` shape the work only;
    ``rank`` counts from 1 among what is returned.  Which rows take part, and
    what empty or odd input gives, is stated in the module docstring.
    """
    spark = embeddings.sparkSession
    table, dims = prepared(embeddings, **rules)
    rows_n = table.count()
    # a projection of its own, so that cogroups of both sides of one table stay unambiguous
    anchors = table.select(*[F.col(c).alias(c) for c in table.columns]).where(F.col("vec_id") % anchor_every == 0)
    anchors_n = anchors.count()
    if not rows_n or not anchors_n:
        return spark.createDataFrame([], RESULT)
    chunks = max(1, math.ceil(rows_n * dims * 8 / chunk_bytes))
    blocks = max(1, math.ceil(anchors_n / anchors_per_block))
    # keys of one type on both sides: a cogroup does not coerce them, and int and long hash apart
    dealt = table.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    found = dealt.groupBy("lab", "chunk", "block").cogroup(asked.groupBy("lab", "chunk", "block")).applyInPandas(
        _positives_task(positives, dims, window), _POSITIVES
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = found.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    lists = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = asked.join(lists.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = dealt.groupBy("chunk", "block").cogroup(asked.groupBy("chunk", "block")).applyInPandas(
        _negatives_task(negatives, low, high, dims, window), _NEGATIVES
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def oracle(anchor_every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> str:
    """The same mining in DuckDB SQL over ``embeddings``, all pairs of anchors and rows."""
    return f"""
WITH v AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR abs(CAST(x AS DOUBLE)) >= {LARGEST})) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.lab AS alab, r.vec_id AS id, r.lab,
         coalesce(list_sum(list_transform(list_zip(a.q, r.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS score
  FROM v a JOIN v r ON a.vec_id % {anchor_every} = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n
    FROM s WHERE lab = alab AND id <> anchor_id) WHERE n <= {positives}
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.lab <> s.alab
   AND {low} * p.positive_score <= 100 * s.score AND 100 * s.score <= {high} * p.positive_score
) WHERE rank <= {negatives}
"""
