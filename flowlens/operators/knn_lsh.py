"""Nearest neighbours among vectors that no bound prunes: locality-sensitive buckets, exact re-ranking.

``knn.knn_self_join`` is exact, and compares nearly all pairs of unstructured high-dimensional vectors. Here each vector
is put into one bucket of each of several hash tables, by the signs of its projections on random directions. A query looks into the
buckets nearest to its own in each table (multi-probe: the signs of its smallest projections flipped first), and the
points found there are compared with it exactly. Distances are exact; only a neighbour that shares no probed bucket is missed.

* **Recall is a parameter.** The number of signs, tables and probes is chosen as the cheapest whose recall on a sample of
  ``SAMPLE`` queries, compared with all points, reaches ``recall``. Every point is in the index. The sample has the same size at every input
  size; probing all buckets is among the choices, so one always reaches the aim.
* **Bounded tasks.** A bucket is dealt into chunks of points and blocks of queries of about ``TILE_BYTES`` by the hash of
  their ids, whatever its size: copies of one vector are spread, and no task holds a whole bucket. A tile returns the k
  nearest of each query only; they are merged by (query, neighbour).
* **On the driver**: ``CENTRE`` vectors for the centre of the directions, and the sample's queries with their neighbours. The bucket sizes are
  broadcast: at most ``MAX_TABLES`` × 2^``MAX_BITS`` rows.

Rows whose id or vector is NULL take no part. A query that finds fewer than k points in its buckets is compared with all points, in
tiles too, so that only a table of k points or fewer gives fewer answers. Ids must be unique; ties go to the smaller id.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.ranking import first_n, hash_key
from flowlens.session import cut_lineage

SAMPLE = 64
CENTRE = 1024
BUCKET_ROWS = 256
MAX_BITS, MAX_TABLES, MAX_FLIPS = 14, 16, 4
TILE_BYTES = 1 << 20


def masks(bits: int, flips: int = MAX_FLIPS) -> np.ndarray:
    """Every set of at most ``flips`` signs, as a 0/1 row."""
    sets = [s for n in range(min(bits, flips) + 1) for s in itertools.combinations(range(bits), n)]
    out = np.zeros((len(sets), bits))
    for i, s in enumerate(sets):
        out[i, list(s)] = 1
    return out


def directions(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    """tables × dim × bits random directions, at right angles within a table where the dimension allows it."""
    g = np.random.default_rng(seed).standard_normal((tables, dim, bits))
    return np.linalg.qr(g)[0] if bits <= dim else g


def choose(q: np.ndarray, near: np.ndarray, found: np.ndarray, n: int, recall: float, seed: int, bucket_rows: int) -> tuple[int, int, int]:
    """(bits, tables, probes) that reach ``recall`` for the sample with the fewest points to compare.

    q: queries × dim; near: queries × k × dim, their true neighbours; found: which of the k exist. All centred.
    """
    most = max(1, min(MAX_BITS, math.ceil(math.log2(max(2, n / bucket_rows)))))
    best = (math.inf, 1, 1, 2)  # one sign, both buckets: everything
    for bits in range(most, 0, -2 if most > 4 else -1):
        w, flip = directions(q.shape[1], bits, MAX_TABLES, seed), masks(bits)
        number = {tuple(m): i for i, m in enumerate(flip.astype(int).tolist())}
        place = np.full((len(q), near.shape[1], MAX_TABLES), np.inf)  # of the neighbour's bucket among the query's probes
        for t in range(MAX_TABLES):
            p = q @ w[t]
            order = np.argsort(np.argsort((p * p) @ flip.T, axis=1, kind="stable"), axis=1)
            apart = ((near @ w[t] > 0) != (p > 0)[:, None]).astype(int)
            for i, j in np.argwhere(found):
                at = number.get(tuple(apart[i, j].tolist()))
                place[i, j, t] = np.inf if at is None else order[i, at]
        for tables in (1, 2, 4, 8, MAX_TABLES):
            need = np.sort(place[:, :, :tables].min(axis=2)[found])
            last = need[max(0, math.ceil(recall * len(need)) - 1)] if len(need) else 0.0
            if np.isfinite(last):
                # a point that several tables offer is compared again; a probe of a table of few buckets costs more
                cost = tables * (last + 1) / 2**bits
                best = min(best, (cost, bits, tables, int(last) + 1))
    return best[1:]


def _tiles(queries: DataFrame, points: DataFrame, k: int, rows: int, id_type: str) -> DataFrame:
    """(_id, _sid, distance): each query's k nearest in every tile. Both sides: _t, _code, id and vector."""

    def nearest(qdf: pd.DataFrame, sdf: pd.DataFrame) -> pd.DataFrame:
        out_q, out_s, out_d = [], [], []
        if len(qdf) and len(sdf):
            sid, sv = sdf["_sid"].to_numpy(), np.stack(sdf["_sv"].to_numpy())
            qid, qv = qdf["_id"].to_numpy(), np.stack(qdf["_v"].to_numpy())
            norm, length = (sv * sv).sum(axis=1), (qv * qv).sum(axis=1)
            slack = 1e-9 * (1 + norm.max() + length.max())
            step = max(1, TILE // (8 * len(sid)))
            for lo in range(0, len(qid), step):
                about = length[lo:lo + step, None] + norm[None] - 2 * (qv[lo:lo + step] @ sv.T)
                about[qid[lo:lo + step, None] == sid[None]] = np.inf
                limit = np.partition(about, min(k, len(sid)) - 1, axis=1)[:, min(k, len(sid)) - 1]
                for i, row in enumerate(about):
                    few = np.flatnonzero((row <= limit[i] + slack) & np.isfinite(row))
                    d = np.sqrt(((qv[lo + i] - sv[few]) ** 2).sum(axis=1))
                    few_k = np.lexsort((sid[few], d))[:k]
                    out_q.extend([qid[lo + i]] * len(few_k))
                    out_s.extend(sid[few][few_k].tolist())
                    out_d.extend(d[few_k].tolist())
        return pd.DataFrame({"_id": out_q, "_sid": out_s, "distance": out_d})

    TILE = TILE_BYTES  # a local name, so that the helper is shipped by value
    key = ["_t", "_code"]
    size = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(name))
    sizes = F.broadcast(size(points, "_np").join(size(queries, "_nq"), key))  # a row a bucket, at most MAX_TABLES × 2^MAX_BITS
    part = lambda n: F.pmod(F.xxhash64("_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = queries.join(sizes, key).select(*key, part("_nq").alias("_qb"), every("_np").alias("_pb"), "_id", "_v")
    # the two sides may come from the same rows: cogroup wants columns of their own
    p = points.join(sizes, key).select(
        *[F.col(c).alias(f"{c}_") for c in key], every("_nq").alias("_qb_"), part("_np").alias("_pb_"), F.col("_id").alias("_sid"), F.col("_v").alias("_sv")
    )
    tile = [*key, "_qb", "_pb"]
    return q.groupBy(*tile).cogroup(p.groupBy(*[f"{c}_" for c in tile])).applyInPandas(nearest, f"_id {id_type}, _sid {id_type}, distance double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """k nearest of each query, every neighbour once."""
    once = found.groupBy("_id", "_sid").agg(F.min("distance").alias("distance"))
    place = F.row_number().over(Window.partitionBy("_id").orderBy("distance", "_sid"))
    return once.withColumn("rank", place).where(F.col("rank") <= k)


def _one_bucket(df: DataFrame) -> DataFrame:
    return df.select(F.lit(0).alias("_t"), F.lit(0).alias("_code"), "_id", "_v")


def knn_lsh_join(points: DataFrame, id_col: str, vec_col: str, k: int = 5, query: Column | None = None, recall: float = 0.95,
                 bucket_rows: int = BUCKET_ROWS, tile_rows: int | None = None, seed: int = 42) -> DataFrame:
    """(id, neighbor_id, rank, distance): k nearest other points of every point, or of those that meet ``query``.

    ``recall`` is the aim for the sample: the share of true neighbours found. Ranks count what is found.
    """
    id_type = points.schema[id_col].dataType.simpleString()
    is_query = F.lit(True) if query is None else F.coalesce(query, F.lit(False))
    pts = points.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"), is_query.alias("_q"))
    pts = pts.where(F.col("_id").isNotNull() & F.col("_v").isNotNull())
    hashed = pts.withColumn("_h", hash_key(seed, "_id"))
    size = pts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("_v")), F.lit(1)).alias("dim")).first()
    n, dim = size["n"], size["dim"]
    rows = tile_rows or max(64, TILE_BYTES // (8 * dim))

    # what is fitted: a centre and the sizes of the index, on bounded samples
    some = first_n(hashed, "_h", CENTRE).select("_v").collect()
    centre = np.array([r["_v"] for r in some], float).mean(axis=0) if some else np.zeros(dim)
    asked = cut_lineage(first_n(hashed.where("_q"), "_h", SAMPLE).select("_id", "_v"))
    truth = _best(_tiles(_one_bucket(asked), _one_bucket(pts), k, rows, id_type), k)
    truth = truth.join(pts.select(F.col("_id").alias("_sid"), F.col("_v").alias("_sv")), "_sid").select("_id", "rank", "_sv").collect()
    queries = {r["_id"]: r["_v"] for r in asked.collect()}
    at = {i: j for j, i in enumerate(sorted(queries))}
    q = np.array([queries[i] for i in at], float).reshape(len(at), dim) - centre
    near, found = np.zeros((len(at), k, dim)), np.zeros((len(at), k), bool)
    for r in truth:
        near[at[r["_id"]], r["rank"] - 1], found[at[r["_id"]], r["rank"] - 1] = np.array(r["_sv"]) - centre, True
    bits, tables, probes = choose(q, near, found, n, recall, seed, bucket_rows)

    w, flip = directions(dim, bits, MAX_TABLES, seed)[:tables], masks(bits)
    power = 1 << np.arange(bits)
    flipped = flip.astype(bool)

    @F.pandas_udf("array<int>")
    def own(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) - centre if len(v) else np.zeros((0, dim))
        return pd.Series(list(np.stack([(x @ t > 0) @ power for t in w], axis=1).astype(np.int32)) if len(v) else [], dtype=object)

    @F.pandas_udf("array<array<int>>")
    def probed(v: pd.Series) -> pd.Series:
        out = []
        for x in v:
            each = []
            for t in w:
                p = (np.asarray(x, float) - centre) @ t
                first = np.argsort(flip @ (p * p), kind="stable")[:probes]
                each.append((((p > 0)[None] ^ flipped[first]) @ power).astype(np.int32).tolist())
            out.append(each)
        return pd.Series(out, dtype=object)

    in_tables = pts.select(F.posexplode(own("_v")).alias("_t", "_code"), "_id", "_v")
    wanted = pts.where("_q").select("_id", "_v", F.posexplode(probed("_v")).alias("_t", "_codes")).select("_t", F.explode("_codes").alias("_code"), "_id", "_v")
    got = cut_lineage(_best(_tiles(wanted, in_tables, k, rows, id_type), k))
    full = got.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min(k, max(n - 1, 0))).select("_id")
    short = cut_lineage(pts.where("_q").select("_id", "_v").join(full, "_id", "left_anti"))
    rest = _best(_tiles(_one_bucket(short), _one_bucket(pts), k, rows, id_type), k)
    all_found = got.join(full, "_id", "left_semi").unionByName(rest)
    return all_found.select(F.col("_id").alias(id_col), F.col("_sid").alias("neighbor_id"), "rank", "distance")
