"""Nearest vectors by cosine: an inverted file whose lists are read with an adaptive dimension scan.

Vectors are scaled to length one and turned by a random rotation, so that squared distance orders like cosine and every block of
columns holds an equal share of it on average. Coarse centroids are fitted to a bounded sample; the number of lists that a query probes is the
smallest that finds ``TARGET`` of the true neighbours of sampled queries in the sample. All vectors are indexed.

In a list the vectors stand in column blocks. The distance of a query is summed block by block; after each a hypothesis test compares
the part seen so far with the best distances found, and candidates that are farther with high confidence are abandoned. Survivors
are scored exactly, in double precision on the original vectors.

Hot lists: of identical vectors only the ids that can be among the results are kept (they tie, smaller ids win), lists are cut into
blocks of vectors and of queries of bounded size, and each block is a task's group of its own.

Defined cases: vectors that are null, zero, of another length than most, or hold a null or non-finite component take no part, nor do rows without
an id; of rows that repeat an id the smallest vector counts. With fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import quoted, stored

NEAREST = 5
#: Rows of the sample, queries of the calibration, lists, and the share of true neighbours that must be in probed lists.
SAMPLE, TRIALS, MOST_LISTS, TARGET = 8192, 256, 1024, 0.975
#: Vectors and queries of a block.
VECTORS, QUERIES = 8192, 256
#: Columns of a block, and the test's width: a candidate is abandoned if its part exceeds the bound by this many deviations.
COLUMNS, WIDTH = 16, 2.5


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return (unit @ self.rotation).astype(np.float32)

    def lists(self, turned: np.ndarray) -> np.ndarray:
        """All lists by distance of their centroids, nearest first."""
        far = (self.centroids**2).sum(axis=1) - 2 * turned @ self.centroids.T
        return np.argsort(far, axis=1, kind="stable")


def fitted(sample: np.ndarray, total: int, seed: int = 3) -> Index:
    """Rotation, centroids (k-means on the sample) and the calibrated number of probes."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    index = Index(np.linalg.qr(rng.standard_normal((size, size)))[0], np.zeros((1, size), np.float32), 1)
    turned = index.turned(sample)
    lists = int(max(1, min(MOST_LISTS, len(sample) // 32, np.sqrt(total) / 4)))
    centroids = turned[rng.choice(len(turned), lists, replace=False)]
    for _ in range(8):
        near = ((centroids**2).sum(axis=1) - 2 * turned @ centroids.T).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, turned)
        n = np.bincount(near, minlength=lists)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], turned[rng.choice(len(turned), lists)]).astype(np.float32)
    index.centroids = centroids
    trials = turned[:TRIALS]
    cosine = trials @ turned.T
    cosine[np.arange(len(trials)), np.arange(len(trials))] = -2
    k = min(NEAREST, len(turned) - 1)
    if k > 0 and lists > 1:
        best = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        home = index.lists(turned)[:, 0]
        place = np.argsort(index.lists(trials), axis=1)  # place of each list in the order of each trial
        index.probes = int(np.quantile(np.take_along_axis(place, home[best], axis=1), TARGET, method="higher")) + 1
    return index


def scan(query: np.ndarray, columns: list[np.ndarray], seen: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the k nearest. columns: blocks of all rows; seen: their distance in the first block."""
    n, size = len(seen), len(query)
    width = columns[0].shape[1]
    first = np.argpartition(seen, k - 1)[:k] if k < n else np.arange(n)
    whole = sum(((c[first] - query[i * width:i * width + c.shape[1]]) ** 2).sum(axis=1) for i, c in enumerate(columns))
    bound = float(whole.max())
    rows, part, read = np.arange(n), seen, width
    for i, block in enumerate(columns):
        if i:
            step = block[rows] - query[i * width:i * width + block.shape[1]]
            part = part + np.einsum("ij,ij->i", step, step)
            read += block.shape[1]
        share = min(1.0, read / size)
        slack = 1.0 if read >= size else (1 + WIDTH / np.sqrt(read)) ** 2
        near = part <= bound * share * slack + 1e-5
        rows, part = rows[near], part[near]
        if len(rows) <= k:
            return rows
    return rows


def _block(group: pd.DataFrame, index: Index, dtype: str, k: int) -> pd.DataFrame:
    """The k nearest in a block for each of its queries, exactly scored."""
    ask = group["ask"].to_numpy()
    vectors = np.stack([np.frombuffer(b, dtype=dtype) for b in group["vector"]]).astype(np.float64)
    ids = group["vec_id"].to_numpy(dtype=np.int64)
    base, base_ids, queries, query_ids = vectors[~ask], ids[~ask], vectors[ask], ids[ask]
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(base) and len(queries):
        turned, wanted = index.turned(base), index.turned(queries)
        columns = [np.ascontiguousarray(turned[:, c:c + COLUMNS]) for c in range(0, turned.shape[1], COLUMNS)]
        head, mine = columns[0], wanted[:, :COLUMNS]
        first = np.maximum((mine**2).sum(axis=1)[:, None] + (head**2).sum(axis=1) - 2 * mine @ head.T, 0)
        norms = np.sqrt((base * base).sum(axis=1))
        for q, own in enumerate(queries):
            rows = scan(wanted[q], columns, first[q], k + 1)  # one more: the query itself may be among them
            rows = rows[base_ids[rows] != query_ids[q]]
            score = (base[rows] * own).sum(axis=1) / (norms[rows] * np.sqrt((own * own).sum()))
            best = np.lexsort((base_ids[rows], -score))[:k]
            out["query_id"].append(np.full(len(best), query_ids[q]))
            out["vec_id"].append(base_ids[rows[best]])
            out["score"].append(score[best])
    return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.float64 if c == "score" else np.int64) for c, v in out.items()})


def usable(vectors: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, str, int]:
    """(vec_id, vector as bytes) of the rows that take part, the type of the bytes and the number of components."""
    element = vectors.schema[vector].dataType.elementType.simpleString()
    dtype = "<f4" if element == "float" else "<f8"
    rows = vectors.select(F.col(quoted(id_column)).cast("bigint").alias("vec_id"), F.col(quoted(vector)).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = common["n"] if common else 0

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            table = flat.reshape(-1, size) if size else flat.reshape(len(lists), 0)
            good = np.isfinite(table).all(axis=1) & (table != 0).any(axis=1)
            packed = [row.tobytes() for row in table[good] + 0.0]  # -0 becomes 0
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.array(packed, pa.binary())], ["vec_id", "vector"])

    whole = rows.where((F.size("v") == size) & ~F.exists("v", lambda x: x.isNull()))
    cleaned = whole.mapInArrow(clean, "vec_id bigint, vector binary")
    return stored(cleaned.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors"), dtype, size


def nearest(vectors: DataFrame, queries: str, id_column: str = "vec_id", vector: str = "embedding", k: int = NEAREST) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``. queries: SQL condition on ``vec_id`` of the rows that ask."""
    rows, dtype, size = usable(vectors, id_column, vector)
    total = rows.count()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], result)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    index = fitted(np.stack([np.frombuffer(r["vector"], dtype=dtype) for r in sample]).astype(np.float64), total)
    sent = vectors.sparkSession.sparkContext.broadcast(index)

    def listed(probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = np.stack([np.frombuffer(b, dtype=dtype) for b in batch.column(1).to_pylist()]).astype(np.float64)
                lists = sent.value.lists(sent.value.turned(own))[:, :probes]
                row = pa.array(np.repeat(np.arange(len(own)), lists.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.ravel().astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row)], ["list", "vec_id", "vector"])

        return run

    schema = "list int, vec_id bigint, vector binary"
    same = Window.partitionBy(F.md5("vector")).orderBy("vec_id")
    useful = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).select("vec_id", "vector")
    base = stored(useful.mapInArrow(listed(1), schema), "lists")
    ask = stored(rows.where(queries).mapInArrow(listed(index.probes), schema), "queries")
    count = lambda frame, most: {r["list"]: -(-r["count"] // most) for r in frame.groupBy("list").count().collect()}
    vector_blocks, query_blocks = count(base, VECTORS), count(ask, QUERIES)  # a row for each list
    names = range(len(index.centroids))
    of = lambda blocks: F.get(F.array(*[F.lit(blocks.get(i, 1)) for i in names]), F.col("list"))
    salt = F.xxhash64("vec_id")
    placed = base.withColumn("i", F.pmod(salt, of(vector_blocks)).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), of(query_blocks) - 1))).withColumn("ask", F.lit(False))
    asking = ask.withColumn("j", F.pmod(salt, of(query_blocks)).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), of(vector_blocks) - 1))).withColumn("ask", F.lit(True))
    found = placed.unionByName(asking).groupBy("list", "i", "j").applyInPandas(
        lambda group: _block(group, sent.value, dtype, k), "query_id bigint, vec_id bigint, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
