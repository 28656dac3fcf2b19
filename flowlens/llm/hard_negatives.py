"""Operator 11: hard negatives of anchors, by rotated one-bit codes with a sound interval for each score.

Vectors are rows of whole numbers; a score is the inner product of two. Every row is rotated by a fixed
orthogonal matrix and coded by the signs of its coordinates: c, the unit vector along those signs, with its
alignment a = <v, c>. What is left, v - a c, is rotated and coded again, ``STAGES`` times in all; stored are
the codes, the alignments and the norm of the last residual r. An anchor goes through the same rotations and is
rounded to ``PLANES`` bits a coordinate before each code, q', so <q', c> is a sum of popcounts of bit planes. Then

    <q, v> = sum of a <q', c>  +  sum of a <q - q', c>  +  <q, r>,

and by Cauchy and Schwarz the second sum is at most that of |a| |q - q'|, and the last term (r is orthogonal to
the last code) at most sqrt(|q|^2 - <q, c>^2) |r|. So each
pair has an estimate and an interval that holds its score for certain (widened for the rounding of floating
point). A pair is dropped only if its interval lies outside what a query can still take: the range of scores
asked for, and above it the k-th best lower end of the pairs seen, or the k-th best score. The pairs that
survive are scored in whole numbers. Nothing is lost: results equal those of a full search.

Anchors are taken in blocks of about ``BLOCK`` (bounded in bytes, so a block is broadcast), each against all
rows: first the anchors' positives (the best rows of the same label), then, for each anchor and positive, the
best rows of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's. A task
keeps the best k for each query, so it returns that many rows at most, whatever its partition holds; no label
or vector is a grouping key, and copies of one vector are spread like other rows. Blocks are written to the
shared folder one by one; a lost executor costs tasks of the block at hand.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors shorter than the
longest one count as filled up with zeros. Rows repeated with the same id count once (the least label, then
vector). Ties of scores go by smaller id. A component beyond the range of long becomes its end, and so does a
score. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import package_reachable, written
from flowlens.session import ensure_checkpoint_dir

PLANES = 6
STAGES = 4
BLOCK = 1024
CHUNK_ROWS = 1024
ROWS_A_PART = 8192
_EXACT = 2.0**53
_LONG = (1 << 63) - 1

CODED = "vec_id long, label long, anchor boolean, v array<long>, code binary, align array<double>, rest double, norm double"
FOUND = "anchor_id long, slot int, id long, score long"


def rotations(d: int) -> list[np.ndarray]:
    """A fixed random orthogonal matrix for each stage."""
    rng = np.random.default_rng(20240611)
    turns = [np.linalg.qr(rng.normal(size=(d, d))) for _ in range(STAGES)]
    return [q * np.sign(np.diag(r)) for q, r in turns]


def numbers(vectors: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column) -> DataFrame:
    """vec_id, label, v (whole numbers), anchor: one row for each id that takes part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"), anchor.alias("anchor"), finite.alias("finite")
    )
    whole = F.transform("x", lambda y: F.floor(y * 256).cast("long"))
    return (
        rows.where("vec_id is not null and label is not null and x is not null and finite")
        .select("vec_id", F.struct("label", whole.alias("v"), F.coalesce("anchor", F.lit(False)).alias("anchor")).alias("row"))
        .groupBy("vec_id")
        .agg(F.min("row").alias("row"))
        .select("vec_id", "row.*")
    )


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The rows' numbers, filled up with zeros to d."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), d), np.int64)
    out[np.arange(d) < size[:, None]] = column.flatten().to_numpy()
    return out


@dataclass
class Coded:
    """Rows with their codes (stages x words of 64 bits), alignments, and the norms of the last residual and of all."""

    ids: np.ndarray
    label: np.ndarray
    v: np.ndarray
    code: np.ndarray
    align: np.ndarray
    rest: np.ndarray
    norm: np.ndarray

    def part(self, at: slice) -> Coded:
        return Coded(*(x[at] for x in (self.ids, self.label, self.v, self.code, self.align, self.rest, self.norm)))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("<u8")


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, alignments, norm of the last residual, norm) of each row."""
    rest = v.astype(np.float64)
    norm, d = np.sqrt((rest**2).sum(axis=1)), v.shape[1]
    codes, align = [], []
    for turn in rotations(d):
        rest = rest @ turn
        signs = np.where(rest >= 0, 1 / np.sqrt(d), -1 / np.sqrt(d))
        align.append((rest * signs).sum(axis=1))
        codes.append(_words(rest >= 0))
        rest = rest - align[-1][:, None] * signs
    return np.stack(codes, axis=1), np.stack(align, axis=1), np.sqrt((rest**2).sum(axis=1)), norm


def _lists(x: np.ndarray) -> pa.ListArray:
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(x.ravel()))


def _code_rows(d: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), d)
            code, align, rest, norm = encode(v)
            raw = pa.array([c.tobytes() for c in code], pa.binary())
            columns = [*(batch.column(c) for c in ("vec_id", "label", "anchor")), _lists(v), raw, _lists(align), pa.array(rest), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in CODED.split(", ")])

    return rows


def coded(table: pa.RecordBatch | pa.Table, d: int) -> Coded:
    ids, label, rest, norm = (np.asarray(table.column(c)) for c in ("vec_id", "label", "rest", "norm"))
    align = table.column("align")
    align = (align.combine_chunks() if isinstance(align, pa.ChunkedArray) else align).flatten().to_numpy(zero_copy_only=False)
    code = np.frombuffer(b"".join(table.column("code").to_pylist()), "<u8").reshape(len(ids), STAGES, -(-d // 64))
    return Coded(ids, label, matrix(table.column("v"), d), code, align.reshape(len(ids), STAGES), rest, norm)


class Queries:
    """A block of anchors, each with slots; a slot asks for the k best rows with a score from least to most."""

    def __init__(self, anchors: Coded, least: np.ndarray, most: np.ndarray, k: int, same_label: bool):
        self.anchors, self.k, self.same_label = anchors, k, same_label
        self.least, self.most = least.astype(np.float64), most.astype(np.float64)
        self.exact_least, self.exact_most = least, most
        turned, self.stages = anchors.v.astype(np.float64), []
        for turn in rotations(anchors.v.shape[1]):
            turned = turned @ turn
            low = turned.min(axis=1, initial=0.0)
            step = (turned.max(axis=1, initial=0.0) - low) / ((1 << PLANES) - 1)
            step[step == 0] = 1.0
            level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
            rounded = low[:, None] + step[:, None] * level
            error = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
            self.stages.append(([_words(level >> b & 1) for b in range(PLANES)], low[:, None], step[:, None], rounded.sum(axis=1)[:, None], error[:, None]))

    def intervals(self, rows: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the scores of anchors (down) and rows (across), from codes alone."""
        norm, shape = self.anchors.norm[:, None], (len(self.anchors.ids), len(rows.ids))
        middle, wide, along, error = np.zeros(shape), np.zeros(shape), np.zeros(shape), 0.0
        for k, (planes, low, step, total, error) in enumerate(self.stages):
            code = rows.code[:, k]
            ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
            weighed = np.zeros(shape)
            for b, plane in enumerate(planes):
                for w in range(plane.shape[1]):
                    weighed += np.bitwise_count(plane[:, w, None] & code[:, w]) * float(1 << b)
            along = (2 * (step * weighed + low * ones) - total) / np.sqrt(max(rows.v.shape[1], 1))  # <q', c>
            middle += along * rows.align[:, k]
            wide += error * np.abs(rows.align[:, k])
        sure = np.maximum(np.abs(along) - error, 0)
        wide += np.sqrt(np.maximum(norm**2 - sure**2, 0)) * rows.rest + 1e-9 * norm * rows.norm + 1e-3
        return middle - wide, middle + wide

    def scores(self, rows: Coded) -> tuple[np.ndarray, bool]:
        """Inner products of all pairs in whole numbers, and whether they are exact as doubles (else Python's own numbers)."""
        size = rows.v.shape[1] * np.abs(self.anchors.v.astype(np.float64)).max(initial=0) * np.abs(rows.v.astype(np.float64)).max(initial=0)
        if size < _EXACT:
            return self.anchors.v.astype(np.float64) @ rows.v.T.astype(np.float64), True
        return np.minimum(np.maximum(self.anchors.v.astype(object) @ rows.v.T.astype(object), -_LONG - 1), _LONG), False


class Best:
    """The k best (score, then smaller id) of each slot of a block of queries, over the rows seen so far."""

    def __init__(self, queries: Queries):
        self.q = queries
        n, s = queries.least.shape
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = queries.least.copy()  # least score that a slot can still take
        self.pairs = self.survivors = 0

    def add(self, rows: Coded) -> None:
        q, a = self.q, self.q.anchors
        lo, hi = q.intervals(rows)
        open_ = (rows.label == a.label[:, None]) == q.same_label
        open_ &= rows.ids != a.ids[:, None]
        self.pairs += int(open_.sum())
        alive = np.zeros_like(open_)
        for s in range(q.least.shape[1]):
            sure = np.where(open_ & (hi <= q.most[:, s, None]), lo, -np.inf)  # its score is no higher than asked, and at least lo
            if sure.shape[1] >= q.k:
                kth = np.partition(sure, sure.shape[1] - q.k, axis=1)[:, sure.shape[1] - q.k]
                self.floor[:, s] = np.maximum(self.floor[:, s], kth)
            alive |= open_ & (hi >= self.floor[:, s, None]) & (lo <= q.most[:, s, None])
        self.survivors += int(alive.sum())
        if not alive.any():
            return
        score, fast = q.scores(rows)
        for s in range(q.least.shape[1]):
            fit = alive & (score >= (q.least if fast else q.exact_least)[:, s, None]) & (score <= (q.most if fast else q.exact_most)[:, s, None])
            fit &= score >= np.ceil(self.floor[:, s, None] - 1e-6)
            at, row = np.nonzero(fit)
            if len(at):
                self._keep(at * q.least.shape[1] + s, score[at, row].astype(np.int64), rows.ids[row])

    def _keep(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.ids, ids)))
        by = np.lexsort((ids, ~score, slot))  # ~x falls as x rises, for every long
        slot = slot[by]
        head = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - head
        kept = by[place < self.q.k]
        self.slot, self.score, self.ids = slot[place < self.q.k], score[kept], ids[kept]
        last = slot[place == self.q.k - 1]
        at, s = np.divmod(last, self.q.least.shape[1])
        self.floor[at, s] = np.maximum(self.floor[at, s], score[by[place == self.q.k - 1]].astype(np.float64))


def _search(shared, d: int):
    """Map task: the best rows of its partition for each slot of the shared queries."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best = Best(queries)
        for batch in batches:
            part = coded(batch, d)
            for k in range(0, len(part.ids), CHUNK_ROWS):
                best.add(part.part(slice(k, k + CHUNK_ROWS)))
        at, slot = np.divmod(best.slot, queries.least.shape[1])
        columns = [queries.anchors.ids[at], slot.astype(np.int32), best.ids, best.score]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "slot", "id", "score"])

    return rows


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best rows of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = package_reachable(vectors.sparkSession)
    context = spark.sparkContext
    named = written(numbers(vectors, id_col, vector_col, label, anchor), "vectors")
    rows, d, anchors = named.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("anchor")).first()
    d = max(d or 0, 1)
    parts = max(-(-rows // ROWS_A_PART), context.defaultParallelism)
    codes = written(named.repartition(parts, "vec_id").mapInArrow(_code_rows(d), CODED), "codes")
    blocks = -(-anchors // BLOCK)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-negatives-{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, positive_score long, id long, score long"
    for block in range(blocks):
        mine = codes.where("anchor").where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        of = coded(mine.select("vec_id", "label", "v", "code", "align", "rest", "norm").toArrow(), d)
        n = len(of.ids)
        shared = context.broadcast(Queries(of, np.full((n, 1), -_LONG - 1), np.full((n, 1), _LONG), positives, True))
        near = written(codes.mapInArrow(_search(shared, d), FOUND), "nearest")
        first = _first(near, positives, "anchor_id").select("anchor_id", "id", "score", "rank").toArrow()
        shared.unpersist()
        slots = np.full((n, positives), -1, np.int64)
        least, most = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)  # nothing, where there is no positive
        place = {i: k for k, i in enumerate(of.ids.tolist())}
        for a, i, score, rank in zip(*(c.to_pylist() for c in first.columns)):
            at = place[a], rank - 1
            slots[at], least[at], most[at] = i, -(-low * score // 100), high * score // 100
        shared = context.broadcast(Queries(of, least, most, negatives, False))
        mined = codes.mapInArrow(_search(shared, d), FOUND)
        best = _first(mined, negatives, "anchor_id", "slot").drop("rank")
        pair = first.rename_columns(["anchor_id", "positive_id", "positive_score", "place"])
        pairs = spark.createDataFrame(pair).withColumn("slot", (F.col("place") - 1).cast("int")).drop("place")
        best.join(F.broadcast(pairs), ["anchor_id", "slot"]).select(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(folder)
        shared.unpersist()
    found = spark.read.schema(schema).parquet(folder) if blocks else spark.createDataFrame([], schema)
    return _first(found, negatives, "anchor_id", "positive_id").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
