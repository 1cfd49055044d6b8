"""Nearest neighbours by randomly rotated one-bit codes, with error bounds and exact reranking.

Vectors are taken relative to the mean of all, scaled to length one, padded with zeros to 256
dimensions (the next power of two above, for longer ones) and rotated by a fixed random rotation. The signs
are the code, packed into bits. With ``a`` the inner product of a vector and its code, the inner
product of code and rotated query, divided by ``a``, estimates that of vector and query without bias;
it errs by about sqrt((1 - a*a) / (a*a * (D - 1))). ``EPSILON`` such errors bound it: every candidate
whose upper bound reaches the k-th best lower bound is reranked on the original vectors.

Queries and candidates are dealt into blocks of bounded size; each cell of a query block and a
candidate block gives its best k for each query, and the best k of those are the result. So every
query meets every row, no task holds more than two blocks, and nothing passes through the driver but
the mean and two counts. The rotation is drawn from a fixed seed in each task.

Defined results: vectors that are null, of length zero, or hold null or non-finite components take no
part; vectors of other lengths than the query's do not meet it. A null id is never a query, and comes
last among ties. All rows of the query's id count as its own; equal rows with a query's id are one
query. An empty table gives no rows. Further columns are not looked at.
"""

from __future__ import annotations

import functools
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, register, staged, table

NEAREST = 20
EPSILON = 2.2
BITS = 256
QUERY_BLOCK = 1024
ROW_BLOCK = 16384
SEED = 20240229


@functools.cache
def rotation(size: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]


def code_size(length: int) -> int:
    return max(BITS, 1 << (length - 1).bit_length())


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Padded with zeros and rotated."""
    length = vectors.shape[1]
    return vectors @ rotation(code_size(length))[:length]


def encoded(vectors: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length relative to the mean, and inner product of unit vector and code."""
    apart = vectors - mean
    length = np.linalg.norm(apart, axis=1)
    turned = rotated(apart / np.where(length, length, 1)[:, None])
    size = turned.shape[1]
    return np.packbits(turned >= 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(size)


def bounds(bits: np.ndarray, length: np.ndarray, agree: np.ndarray, own: np.ndarray, mean: np.ndarray, queries: np.ndarray):
    """Estimates of all inner products (queries by rows) and how far they may be off."""
    apart = queries - mean
    reach = np.linalg.norm(apart, axis=1)
    turned = rotated(apart).astype(np.float32)
    size = turned.shape[1]
    signs = np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1
    safe = np.maximum(agree, 1e-6)
    middle = (turned @ signs.T) * (length / (safe * np.sqrt(size))).astype(np.float32)
    # <o, q> = <o - m, q - m> + <o, m> + <q - m, m>
    middle += (own @ mean).astype(np.float32) + (apart @ mean).astype(np.float32)[:, None]
    spread = EPSILON * length * np.sqrt(np.maximum(1 - safe**2, 0) / (safe**2 * (size - 1)))
    slack = 1e-5 * (1 + np.abs(length))
    return middle, reach.astype(np.float32)[:, None] * (spread + slack).astype(np.float32) + np.float32(1e-6)


def best(ids: np.ndarray, none: np.ndarray, rows: np.ndarray, own: pa.Table, queries: np.ndarray, names: np.ndarray, mean: np.ndarray, k: int):
    """The k nearest of a block for each query: query number, row number, exact score."""
    bits = np.frombuffer(b"".join(own["code"].to_pylist()), dtype=np.uint8).reshape(len(rows), -1)
    middle, off = bounds(bits, own["far"].to_numpy(), own["agree"].to_numpy(), rows, mean, queries)
    self_row = (ids[None, :] == names[:, None]) & ~none[None, :]
    low = np.where(self_row, -np.inf, middle - off)
    high = np.where(self_row, -np.inf, middle + off)
    if len(rows) > k:
        floor = -np.partition(-low, k - 1, axis=1)[:, k - 1]
        query, row = np.nonzero((high >= floor[:, None]) & ~self_row)
    else:
        query, row = np.nonzero(~self_row)
    score = np.empty(len(query))
    for at in range(0, len(query), 1 << 17):
        cut = slice(at, at + (1 << 17))
        score[cut] = np.einsum("ij,ij->i", queries[query[cut]], rows[row[cut]])
    order = np.lexsort((ids[row], none[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], row[rank < k], score[rank < k]


def one_bit_index(vectors: DataFrame, id_column: str, vector_column: str, mean: list[float]) -> DataFrame:
    """id, vector, code (packed bits), far and agree for each vector of the mean's length."""
    centre = np.array(mean)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits, far, agree = encoded(matrix(batch.column("vector"), len(centre)), centre)
        codes = pa.array([b.tobytes() for b in bits], type=pa.binary())
        columns = [batch.column("id"), batch.column("vector"), codes, pa.array(far), pa.array(agree)]
        return pa.RecordBatch.from_arrays(columns, ["id", "vector", "code", "far", "agree"])

    source = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return source.mapInArrow(per_batch(encode), "id long, vector array<double>, code binary, far double, agree double")


def usable(vectors: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector can take part."""
    v = F.col(vector_column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0))


def nearest(
    vectors: DataFrame, query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = NEAREST
) -> DataFrame:
    """The k rows of largest inner product for each row that ``query`` holds for: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    vectors = usable(vectors.select(id_column, vector_column, query.alias("__asks")), vector_column)
    v = F.col(vector_column)
    lengths = [r[0] for r in vectors.select(F.size(v)).distinct().collect()]
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for length in sorted(lengths):
        same = vectors.where(F.size(v) == length)
        total = same.agg(
            F.count("*").alias("n"),
            F.count_if(F.col("__asks")).alias("asks"),
            *[F.avg(v[i].cast("double")).alias(f"m{i}") for i in range(length)],
        ).first()
        if not total["asks"]:
            continue
        mean = [total[f"m{i}"] for i in range(length)]
        out = out.unionByName(_search(same, id_column, vector_column, mean, total["n"], total["asks"], k))
    return out


def _search(same: DataFrame, id_column: str, vector_column: str, mean: list[float], n: int, asks: int, k: int) -> DataFrame:
    row_blocks, query_blocks = -(-n // ROW_BLOCK), -(-asks // QUERY_BLOCK)
    centre = np.array(mean)
    # Dealt by place in the table, so that no id or vector, however frequent, makes a large block.
    place = F.monotonically_increasing_id()
    index = staged(one_bit_index(same, id_column, vector_column, mean), "one-bit")
    rows = index.select(
        F.pmod(F.xxhash64(place), F.lit(row_blocks)).cast("int").alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "*"
    )
    asking = (
        same.where("__asks")
        .select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
        .distinct()
        .select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(query_blocks)).cast("int").alias("qb"), "id", "vector")
    )
    asking = staged(asking, "asking").select("*", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))

    def cell(key, block: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and queries.num_rows:
            block = block.combine_chunks()
            own = matrix(block["vector"].combine_chunks(), len(centre))
            asked = matrix(queries["vector"].combine_chunks(), len(centre))
            none = block["id"].is_null().to_numpy(zero_copy_only=False)
            ids, names = block["id"].fill_null(0).to_numpy(), queries["id"].to_numpy()
            for at in range(0, len(names), 128):
                q, r, s = best(ids, none, own, block, asked[at : at + 128], names[at : at + 128], centre, k)
                found.append((names[at + q], q + at, r, s))
        if not found:
            return pa.table({c: pa.array([], type=t) for c, t in (("query_id", pa.int64()), ("qkey", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))})
        name, q, r, s = (np.concatenate(x) for x in zip(*found))
        asked_key = np.array([int.from_bytes(blake2b(row.tobytes(), digest_size=8).digest(), "little", signed=True) for row in asked])
        return pa.table(
            {
                "query_id": pa.array(name),
                "qkey": pa.array(asked_key[q]),
                "vec_id": pa.array(ids[r], mask=none[r]),
                "score": pa.array(s),
            }
        )

    cells = (
        rows.groupBy("rb", "qb")
        .cogroup(asking.groupBy("rb", "qb"))
        .applyInArrow(cell, "query_id long, qkey long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@register("op9_nearest")
def op9(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))
