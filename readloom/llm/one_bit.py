"""Nearest neighbours by largest inner product, from randomly rotated one-bit codes.

Index, one row at a time: a vector less the centre is turned by a fixed random rotation;
the signs of its components are packed into bits, and two scalars correct for what the
bits lose, its length and the inner product of its direction with that of the signs.
Search: queries and candidates meet in blocks of bounded size, every block of one with
every block of the other. In a block the packed bits and scalars give an estimate of each
inner product and a bound of its error. The best estimates are scored exactly, which
gives a floor for the nearest ``k``; whatever could reach the floor within its bound is
scored exactly as well. Only exact scores leave the task, ``k`` for a query and block.

The centre is the mean of at most ``sample`` vectors of smallest hash; it affects speed,
not results. ``errors`` is the width of the bound in standard deviations.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part; vectors meet those of their own length only; rows that share the
query's id are its own; a repeated candidate counts once for each row, a repeated query
once; ties go to the smaller id; an empty table gives none.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers and not all of them zero. Never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same size."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of a list array whose lists all have ``size`` numbers, in double precision."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, length of the vector from the centre, its direction times that of the signs."""
    turned = (vectors - centre) @ turn
    length = np.sqrt((turned**2).sum(axis=1))
    fit = np.abs(turned).sum(axis=1) / np.maximum(length, 1e-300) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, fit, 1.0)


def index(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (id, vector, size, ...) with columns bits, length and fit. Narrow."""

    def code(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        bits, length, fit = np.empty(len(vectors), object), np.empty(len(vectors)), np.empty(len(vectors))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            own = encode(matrix(vectors.take(pa.array(at)), size), centres.get(size, np.zeros(size)), rotation(size))
            bits[at] = [x.tobytes() for x in own[0]]
            length[at], fit[at] = own[1:]
        columns = [pa.array(bits, pa.binary()), pa.array(length), pa.array(fit)]
        return pa.StructArray.from_arrays(columns, ["bits", "length", "fit"])

    coded = F.arrow_udf(code, "bits binary, length double, fit double")
    return rows.withColumn("code", coded("vector"))


def estimates(bits: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray, errors: float):
    """(queries, candidates) inner products with the vectors from the centre, and the bound per candidate.

    ``queries`` are rotated. The bound is for a query of length one.
    """
    size = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1
    scale = length / (fit * np.sqrt(size))
    spread = length * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * errors / np.sqrt(max(size - 1, 1))
    return (queries.astype(np.float32) @ signs.T) * scale.astype(np.float32), spread + 1e-5 * length


def nearest_in_block(candidates: pa.Table, queries: pa.Table, k: int, errors: float, centres: dict) -> pa.Table:
    names = ["query_id", "query_key", "vec_id", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    if not candidates.num_rows or not queries.num_rows:
        return pa.Table.from_arrays([pa.array([], kind) for kind in kinds], names)
    size = candidates["size"][0].as_py()
    centre = centres.get(size, np.zeros(size))
    vectors = matrix(candidates["vector"].combine_chunks(), size)
    wanted = matrix(queries["vector"].combine_chunks(), size)
    code = candidates["code"].combine_chunks()
    bits = np.frombuffer(b"".join(code.field("bits").to_pylist()), np.uint8).reshape(len(vectors), -1)
    length, fit = (code.field(c).to_numpy(zero_copy_only=False) for c in ("length", "fit"))
    guess, spread = estimates(bits, length, fit, wanted @ rotation(size), errors)
    ids, own = candidates["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    key = queries["query_key"].to_numpy()
    out = []
    for i, q in enumerate(wanted):
        others = np.flatnonzero(ids != own[i])
        near = guess[i, others] + centre @ q
        if len(others) > 2 * k:
            first = others[np.argpartition(-near, 2 * k)[: 2 * k]]
            floor = np.sort((vectors[first] * q).sum(axis=1))[-k]
            others = others[near + spread[others] * np.sqrt(q @ q) >= floor]
        score = (vectors[others] * q).sum(axis=1)
        best = np.lexsort((ids[others], -score))[:k]
        out.append((np.full(len(best), own[i]), np.full(len(best), key[i]), ids[others][best], score[best]))
    return pa.Table.from_arrays([pa.array(np.concatenate(c), kind) for c, kind in zip(zip(*out), kinds)], names)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    errors: float = 3.0,
    candidate_block: int = 8192,
    query_block: int = 1024,
    sample: int = 10_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row where ``is_query`` holds."""
    own = F.col(f"`{vector}`")
    rows = vectors.where(usable(own) & F.col(f"`{vec_id}`").isNotNull())
    chosen = rows.where(is_query).select(
        F.col(f"`{vec_id}`").alias("query_id"), own.alias("vector"), F.xxhash64(own).alias("query_key")
    )
    chosen = chosen.dropDuplicates(["query_id", "query_key"]).withColumn("size", F.size("vector"))
    rows = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), own.alias("vector"), F.size(own).alias("size"))
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector", "size").toArrow()
    centres = {}
    for size in set(some["size"].to_pylist()):
        of_size = some.filter(pc.equal(some["size"], size))["vector"].combine_chunks()
        centres[size] = matrix(of_size, size).mean(axis=0)
    candidate_blocks = max(1, -(-rows.count() // candidate_block))
    query_blocks = max(1, -(-chosen.count() // query_block))
    left = index(rows, centres).select(
        # By the row's number, not its id: an id that many rows share must not make one block.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(candidate_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        "size",
        "vec_id",
        "vector",
        "code",
    )
    right = chosen.select(
        F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(query_blocks)).cast("int").alias("query_block"),
        F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))).alias("block"),
        "size",
        "query_id",
        "query_key",
        "vector",
    )
    key = ["block", "query_block", "size"]

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        return nearest_in_block(candidates, queries, k, errors, centres)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        search, "query_id long, query_key long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
