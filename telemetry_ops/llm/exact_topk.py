"""Exact top-k inner products by aggregation of sorted lists without random access.

Components become whole numbers, floor(1024 * x). Candidates are cut into blocks; a block holds one list per dimension,
sorted by component. For a query the lists are read from the end its sign asks for, some entries of every list at a
time. Each vector has a lower and an upper bound: the products read so far, plus the least and the most its unread
dimensions can add (the far end and the reading position of their lists). Reading stops when no unseen vector can reach
the k-th lower bound; the final scores of those whose upper bound reaches it are then resolved. The lists of a block
are read one part after another, and each part starts from the k-th score of those before it.

Queries and candidates both come in blocks; a task holds one block of each, and each pair gives at most k rows per
query. Nothing is broadcast, and equal vectors need no care beyond ties, which go to the smaller id.

Vectors that are null, or hold null or non-finite components, take no part; neither do vectors of another length than
the query's, or rows with a null id. Repeated rows are candidates each; a query is its row, and candidates with its id
are left out. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SCALE = 1024
K = 10
EVERY = 100
BLOCK_ROWS = 8192  # candidates of a block
QUERY_ROWS = 256  # queries of a block
LIST_ROWS = 2048  # candidates of a block that are sorted together


class SortedLists:
    """Whole-number vectors as one sorted list per dimension. Products are added as doubles, exactly below 2 ** 53."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype(float)
        self.order = np.argsort(vectors, axis=0, kind="stable")  # ascending
        self.values = np.take_along_axis(self.vectors, self.order, axis=0)

    def top(self, query: np.ndarray, query_id: int, k: int, floor: float) -> list[tuple[int, int]]:
        """Up to ``k`` (score, id) of the best candidates; those that score less than ``floor`` may be left out."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        q = query[used].astype(float)
        down = q > 0  # read from the largest value
        least = q * np.where(down, self.values[0, used], self.values[-1, used])
        partial, unread = np.zeros(n), np.ones((n, len(used)))
        alive = self.ids != query_id
        depth, step = 0, max(32, n // 8)
        while depth < n and len(used):
            upto = min(n, depth + step)
            place = np.arange(depth, upto)[:, None]
            rows = np.where(down, n - 1 - place, place)
            read = self.order[rows, used]
            gain = self.values[rows, used] * q
            partial += np.bincount(read.ravel(), gain.ravel(), n)
            unread[read, np.arange(len(used))] = 0.0
            depth = upto
            frontier = gain[-1]
            rest = unread @ np.stack((frontier, least), axis=1)
            if alive.sum() > k:
                floor = max(floor, np.partition((partial + rest[:, 1])[alive], -k)[-k])
            if frontier.sum() < floor:  # no vector that is still unseen can qualify
                alive &= partial + rest[:, 0] >= floor
                break
        at = np.flatnonzero(alive)
        scores = self.vectors[at] @ query.astype(float)
        best = np.lexsort((self.ids[at], -scores))[:k]
        return [(int(scores[i]), int(self.ids[at[i]])) for i in best]


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors that take part, as whole numbers."""
    x = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(key).cast("long").alias("id"), whole.alias("v"))


def _pair(ids_c, vectors_c, ids_q, vectors_q, k):
    """The best of a block of candidates for every query of a block, list rows after list rows."""
    out = []
    sizes = np.array([len(v) for v in vectors_c])
    for width in sorted({len(v) for v in vectors_q}):
        at = np.flatnonzero(sizes == width)
        asked = [(int(i), np.asarray(v, np.int64)) for i, v in zip(ids_q, vectors_q) if len(v) == width]
        best: list[list] = [[] for _ in asked]
        for a in range(0, len(at), LIST_ROWS):
            part = at[a:a + LIST_ROWS]
            lists = SortedLists(ids_c[part], np.array([vectors_c[i] for i in part], np.int64).reshape(len(part), width))
            for n, (query_id, v) in enumerate(asked):
                floor = best[n][-1][0] if len(best[n]) == k else -np.inf
                found = best[n] + lists.top(v, query_id, k, floor)
                best[n] = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
        out += [(query_id, i, s) for (query_id, _), found in zip(asked, best) for s, i in found]
    return out


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K,
          scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: queries are the rows whose id is divisible by ``every``."""
    whole = whole_vectors(vectors, key, vector, scale)
    total = vectors.count()
    n_blocks = max(1, -(-total // BLOCK_ROWS))
    n_query = max(1, -(-total // (every * QUERY_ROWS)))
    # a row's block comes from its id and its content, so copies of one id spread too
    spread = F.xxhash64("id", "v")
    candidates = whole.select(F.pmod(spread, F.lit(n_blocks)).cast("int").alias("block"),
                              F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("qblock"), "id", "v")
    queries = whole.where(F.pmod("id", F.lit(every)) == 0).distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("v", "id"), F.lit(n_query)).cast("int").alias("qblock"), "id", "v")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = _pair(left["id"].to_numpy(), left["v"].tolist(), right["id"].tolist(), right["v"].tolist(), k) \
            if len(left) and len(right) else []
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = candidates.groupBy("block", "qblock").cogroup(queries.groupBy("block", "qblock")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = f"""WITH whole AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({SCALE} * x) AS DOUBLE)) AS v
  FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
