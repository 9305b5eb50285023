"""Blocked search of a stated query set against all vectors of a table.

Vectors are dealt by a hash of their id to *shards* of about ``shard_rows``
rows; a task builds one index per shard and stores it as a row. Queries are
dealt to blocks; every (shard, query block) pair is one task-sized piece of
work that returns at most k rows per query, so no task sees all vectors, all
queries or all results. The shards' k best are merged by a ranked window.

Rows take part when id and vector are not null and the vector is not empty
and holds only finite components. If rows share an id, the vector that is
smallest component by component stands for the id (in both roles). Vectors are
compared with vectors of the same length only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 2048
INDEX = "shard long, dim int, image binary"
FOUND = "query_id long, vec_id long, score {score}"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vector of double, dim) of the rows that take part."""
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vec_col).cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .filter(~F.coalesce(bad, F.lit(True)))
            .withColumn("dim", F.size("vector")))


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids (ascending, distinct) and their vectors."""
    ids = np.asarray(table.column("vec_id").combine_chunks())
    flat = table.column("vector").combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.chunked_array(flat).combine_chunks().flatten()
    x = np.asarray(flat, dtype=np.float64).reshape(len(ids), -1)
    order = np.lexsort([*x.T[::-1], ids]) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    ids, x = ids[order], x[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], x[first]


def top_k(rows: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:k]


def search(vectors: DataFrame, build, find, k: int, score_type: str, is_query,
           id_col: str, vec_col: str, shard_rows: int = SHARD_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best.

    ``build(ids, x)`` -> index bytes; ``find(image, query_ids, q)`` -> arrays
    (query position, vec_id, score) of the shard's best, own id left out."""
    rows = usable(vectors, id_col, vec_col)
    size = rows.agg(F.count(F.lit(1)).alias("n"),
                    F.count(F.when(is_query(F.col("vec_id")), 1)).alias("q")).first()
    shards = max(1, math.ceil(size["n"] / shard_rows))
    blocks = max(1, math.ceil(size["q"] / query_rows))

    def make(key, table):
        ids, x = matrix(table)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                         "dim": pa.array([key[1].as_py()], pa.int32()),
                         "image": pa.array([build(ids, x)], pa.binary())})

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("long")
    index = (rows.select(shard.alias("shard"), "dim", "vec_id", "vector")
             .groupBy("shard", "dim").applyInArrow(make, INDEX)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (rows.filter(is_query(F.col("vec_id")))
             .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
             .select("shard", "dim", "block", "vec_id", "vector"))

    def look(key, left, right):
        if left.num_rows == 0 or right.num_rows == 0:
            who = vec = score = []
        else:
            q_ids, q = matrix(right)
            at, vec, score = find(left.column("image")[0].as_py(), q_ids, q)
            who = q_ids[np.asarray(at, np.int64)]
        return pa.table({"query_id": pa.array(who, pa.int64()), "vec_id": pa.array(vec, pa.int64()),
                         "score": pa.array(score, pa.int64() if score_type == "long" else pa.float64())})

    keys = ["shard", "dim", "block"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(look, FOUND.format(score=score_type))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
