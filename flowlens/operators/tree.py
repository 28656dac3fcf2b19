"""A Gini decision tree over binned features, grown by Spark jobs.

The tree is the library's (``DecisionTreeClassifier``): the same candidate thresholds (at most ``max_bins`` - 1 a
feature, from about ``max(max_bins², 10,000)`` sampled rows if there are more), the first best split by
feature and threshold, no child of a pure node, siblings of one prediction merged. The library keeps a full table of features x
bins x classes for every node in every task; its nodes grow with the rows. Here

* rows are binned once and written, one byte a feature;
* a node of more than ``GROUP_ROWS`` rows is split by one Spark aggregate of its non-empty cells, a level at a time;
* the rows of smaller nodes are grouped by node, and each group grows its subtree in its task, from the rows' own bins;
* a scored row is sent to the subtree that it falls into.

The driver holds the nodes over ``GROUP_ROWS`` rows and their children; the other nodes stay in a table. The node of a path
(0 left, 1 right) has its place in the order of paths as id, which is the library's numbering.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.ranking import dense_index
from flowlens.session import bound_batches, written_once

GROUP_ROWS = 4096
EPSILON = 2.0**-52  # a child of less impurity is pure
_NODE = "part string, path string, prediction double, impurity double, gain double, feature int, threshold double, samples double"


def _tools(classes: int, max_depth: int):
    """Functions of the tasks, nested so that they are shipped by value: executors need numpy and pyarrow, not this package."""
    import numpy as np

    def gini(counts, total):
        """Of counts by class (first axis), class by class as the library adds them up."""
        out = np.ones(np.shape(total))
        for c in counts:
            out = out - (c / total) * (c / total)
        return out

    def best(left, ok, total):
        """Place (feature, candidate) and gain of the first best split; left has counts by class, feature and candidate."""
        n, below = total.sum(), left.sum(axis=0)
        above = n - below
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gini(total, n) - below / n * gini(left, below) - above / n * gini(total[:, None, None] - left, above)
            gain = np.where(ok & (below > 0) & (above > 0) & (gain >= 0), gain, -np.inf)
        at = int(gain.argmax()) if gain.size else -1
        return (-1, -1, -np.inf) if at < 0 else (*divmod(at, gain.shape[1]), float(gain.flat[at]))

    def from_cells(cells, total):
        """Best split of a node from its table of counts by class, feature and bin."""
        return best(np.cumsum(cells, axis=2), True, total)

    def from_rows(bins, y, total, n_bins):
        """Best split (feature, bin) of a node from its rows; of few rows only the bins that are there can be cut after."""
        m, d = bins.shape
        if m > n_bins:
            place = (y[:, None] * d + np.arange(d)) * n_bins + bins
            return from_cells(np.bincount(place.ravel(), minlength=classes * d * n_bins).reshape(classes, d, n_bins).astype(float), total)
        order = np.argsort(bins, axis=0, kind="stable")
        cut = np.take_along_axis(bins, order, axis=0).T
        mine = y[order].T
        left = np.cumsum(mine == np.arange(classes)[:, None, None], axis=2, dtype=float)
        f, at, gain = best(left[:, :, :-1], cut[:, :-1] < cut[:, 1:], total)
        return f, int(cut[f, at]) if f >= 0 else -1, gain

    def leaf(path, total, impurity):
        return {"path": path, "prediction": float(total.argmax()), "impurity": impurity, "gain": -1.0, "feature": -1, "threshold": None, "samples": float(total.sum())}

    def decided(path, total, split, thresholds):
        """The tested node as a leaf, or as an inner node."""
        f, at, gain = split
        impurity = float(gini(total, total.sum()))
        if gain == -np.inf:
            return leaf(path, total, -1.0)  # as the library marks a node that has no split
        if gain <= 0 or len(path) >= max_depth:
            return leaf(path, total, impurity)
        return leaf(path, total, impurity) | {"gain": gain, "feature": int(f), "threshold": float(thresholds[f][at])}

    def untested(path, total):
        """A child that is a leaf without a test, or None."""
        impurity = float(gini(total, total.sum()))
        return leaf(path, total, impurity) if len(path) >= max_depth or abs(impurity) < EPSILON else None

    def merged(nodes):
        """Siblings that are leaves of one prediction go, from the deepest on."""
        for path in sorted(nodes, key=len, reverse=True):
            if nodes[path]["feature"] < 0 or path + "0" not in nodes:
                continue
            a, b = nodes[path + "0"], nodes[path + "1"]
            if a["feature"] < 0 and b["feature"] < 0 and a["prediction"] == b["prediction"]:
                del nodes[path + "0"], nodes[path + "1"]
                nodes[path] |= {"gain": -1.0, "feature": -1, "threshold": None}
        return nodes

    def grow(root, bins, y, thresholds, n_bins):
        """The subtree of one node's rows."""
        nodes, todo = {}, [(root, np.arange(len(y)))]
        while todo:
            path, rows = todo.pop()
            total = np.bincount(y[rows], minlength=classes).astype(float)
            node = untested(path, total) if path else None
            if node is None:
                split = from_rows(bins[rows], y[rows], total, n_bins)
                node = decided(path, total, split, thresholds)
                if node["feature"] >= 0:
                    right = bins[rows, split[0]] > split[1]
                    todo += [(path + "0", rows[~right]), (path + "1", rows[right])]
            nodes[path] = node
        return merged(nodes)

    def descend(go_right, top):
        """Path of each row among the top nodes, those that have children given as path -> (feature, cut)."""
        out, todo = np.empty(len(go_right.rows), object), [("", np.arange(len(go_right.rows)))]
        while todo:
            path, rows = todo.pop()
            if path not in top:
                out[rows] = path
            elif len(rows):
                right = go_right(rows, *top[path])
                todo += [(path + "0", rows[~right]), (path + "1", rows[right])]
        return out

    class Above:
        """Whether values of rows lie above a cut."""

        def __init__(self, rows):
            self.rows = rows

        def __call__(self, at, feature, cut):
            return self.rows[at, feature] > cut

    def matrix(column, kind, width):
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)

    return dict(from_cells=from_cells, decided=decided, untested=untested, merged=merged, grow=grow, descend=descend, Above=Above, matrix=matrix)


def _vector(features: str | Sequence[str]) -> Column:
    """The features as an array; as in the library, null, NaN and infinite values are an error."""
    x = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    x = F.transform(x, lambda v: F.coalesce(v, F.lit(0.0)))  # as array_to_vector does
    bad = x.isNull() | F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(bad, F.raise_error(F.lit("vectors must not be null, nor have NaN or infinite values"))).otherwise(x)


def _class(label: str) -> Column:
    y = F.col(label).cast("double")
    good = y.isNotNull() & (y >= 0) & (y == F.floor(y)) & (y < 100)
    return F.when(good, y.cast("int")).otherwise(F.raise_error(F.lit("labels must be whole numbers from 0 to 99")))


def _thresholds(rows: DataFrame, n: int, d: int, max_bins: int, seed: int) -> list[list[float]]:
    """Candidate thresholds of each feature: midpoints between values, at about equal numbers of rows if there are many."""
    need = max(max_bins * max_bins, 10_000)
    sample = rows.select("x") if need >= n else written_once(rows.select("x").sample(False, need / n, seed), "tree-sample")
    most = min(max_bins, n) - 1

    def candidates(t):
        import numpy as np
        import pyarrow as pa

        vals, counts = np.unique(t["v"].to_numpy() + 0.0, return_counts=True)
        mid = (vals[1:] + vals[:-1]) / 2.0
        if len(mid) > most:
            stride = counts.sum() / (most + 1)
            upto, chosen, target = np.cumsum(counts).tolist(), [], stride
            for i in range(1, len(upto)):
                if abs(upto[i - 1] - target) < abs(upto[i] - target):
                    chosen.append(i - 1)
                    target += stride
            mid = mid[chosen]
        return pa.table({"f": t["f"].slice(0, 1), "cuts": pa.array([mid.tolist()], pa.list_(pa.float64()))})

    cells = sample.select(F.posexplode("x").alias("f", "v")).repartition(min(d, 64), "f")
    found = {r["f"]: list(r["cuts"]) for r in cells.groupBy("f").applyInArrow(candidates, "f int, cuts array<double>").collect()}
    return [found.get(f, []) for f in range(d)]


@dataclass
class TreeModel:
    """``top``: path -> (feature, threshold) of the driver's inner nodes; ``ends``: prediction of its leaves; ``table``: all nodes."""

    table: DataFrame
    top: dict[str, tuple[int, float]]
    ends: dict[str, float]
    classes: int
    features: int

    @property
    def numNodes(self) -> int:  # noqa: N802 (the library's name)
        return self.table.count()

    def nodes(self) -> DataFrame:
        """id, children and what a node has; -1 for none."""
        ids = written_once(dense_index(self.table, "path", "id"), "tree-ids")
        right = ids.where("path LIKE '%1'").select(F.expr("substring(path, 1, length(path) - 1)").alias("path"), F.col("id").alias("rightChild"))
        child = lambda c: F.when(F.col("feature") >= 0, c).otherwise(F.lit(-1)).cast("int")
        return ids.join(right, "path", "left").select(
            F.col("id").cast("int").alias("id"), "prediction", "impurity", "gain", child(F.col("id") + 1).alias("leftChild"),
            child(F.col("rightChild")).alias("rightChild"), F.col("feature").alias("feature_index"), "threshold", "samples",
        )

    def predict(self, df: DataFrame, features: str | Sequence[str], label: str) -> DataFrame:
        """label and prediction of every row: by the driver's leaves, or by the subtree that the row is sent to."""
        top, ends, d, tools = self.top, self.ends, self.features, _tools(self.classes, 0)

        def sent(batches):
            import numpy as np
            import pyarrow as pa

            for b in batches:
                x = np.stack([v.values.to_numpy() for v in b.column(0)]).reshape(-1, d) if b.num_rows else np.empty((0, d))
                part = tools["descend"](tools["Above"](x), top)
                done = [ends.get(p) for p in part]
                rows = [b"" if e is not None else r.tobytes() for r, e in zip(x, done)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(rows, pa.binary()), b.column(1), pa.array(done, pa.float64())], ["part", "x", "label", "prediction"])

        def scored(rows, nodes):
            import numpy as np
            import pyarrow as pa

            if not rows.num_rows:
                return pa.table({"label": pa.array([], pa.float64()), "prediction": pa.array([], pa.float64())})
            root = rows["part"][0].as_py()
            own = {p[len(root) :]: (f, t, y) for p, f, t, y in zip(*(nodes[c].to_pylist() for c in ("path", "feature", "threshold", "prediction")))}
            x = tools["matrix"](rows["x"], "<f8", d)
            end = tools["descend"](tools["Above"](x), {p: v[:2] for p, v in own.items() if v[0] >= 0})
            return pa.table({"label": rows["label"], "prediction": pa.array(np.array([own[p][2] for p in end]))})

        data = df.select(_vector(features).alias("x"), F.col(label).cast("double").alias("label"))
        out = data.mapInArrow(sent, "part string, x binary, label double, prediction double")
        k = max(1, min(2 * len(self.top) + 1, 10_000))
        far = out.where("prediction IS NULL").repartition(k, "part").groupBy("part")
        near = self.table.where("part IS NOT NULL").repartition(k, "part").groupBy("part")
        return out.where("prediction IS NOT NULL").select("label", "prediction").unionByName(far.cogroup(near).applyInArrow(scored, "label double, prediction double"))


def fit_tree(train: DataFrame, features: str | Sequence[str], label: str, max_depth: int = 30, max_bins: int = 150, seed: int = 42) -> TreeModel:
    import numpy as np

    spark = bound_batches(train.sparkSession)
    data = train.select(_vector(features).alias("x"), _class(label).alias("y"))
    about = data.agg(F.count(F.lit(1)), F.max("y"), F.max(F.size("x")), F.min(F.size("x"))).first()
    n, classes, d = about[0], (about[1] or 0) + 1, about[2]
    if not n or d != about[3]:
        raise ValueError("a tree needs rows, and vectors of one size")
    cuts = _thresholds(data, n, d, max_bins, seed)
    n_bins = max(map(len, cuts)) + 1
    kind = "u1" if n_bins <= 256 else "<u2"
    tools = _tools(classes, max_depth)

    def binned(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                x = np.stack([v.values.to_numpy() for v in b.column(0)])
                bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(kind)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), b.column(1)], ["bins", "y"])

    rows = written_once(data.mapInArrow(binned, "bins binary, y int"), "tree-rows")

    def placed(top, wanted):
        def place(batches):
            import pyarrow as pa

            for b in batches:
                part = tools["descend"](tools["Above"](tools["matrix"](b.column(0), kind, d)), top)
                keep = pa.array([p in wanted for p in part], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *b.columns], ["part", "bins", "y"]).filter(keep)

        return rows.mapInArrow(place, "part string, bins binary, y int")

    def cells(batches):
        """Counts of a batch's non-empty cells: node, and place by class, feature and bin."""
        import pyarrow as pa

        for b in batches:
            names, node = np.unique(np.array(b.column(0).to_pylist(), object).astype(str), return_inverse=True)
            bins, y = tools["matrix"](b.column(1), kind, d), b.column(2).to_numpy()
            width = classes * d * n_bins
            place, count = np.unique(((node * classes + y)[:, None] * d + np.arange(d)) * n_bins + bins, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names[place // width], pa.string()), pa.array(place % width), pa.array(count)], ["part", "cell", "n"])

    def split(t):
        import pyarrow as pa

        table = np.zeros(classes * d * n_bins)
        table[t["cell"].to_numpy()] = t["n"].to_numpy()
        table = table.reshape(classes, d, n_bins)
        f, at, gain = tools["from_cells"](table, table[:, 0].sum(axis=1))
        left = table[:, f, : at + 1].sum(axis=1)
        return pa.table({"part": t["part"].slice(0, 1), "f": [f], "at": [at], "gain": [gain], "total": [table[:, 0].sum(axis=1).tolist()], "left": [left.tolist()]})

    top, known, parts, big = {}, {}, set(), {""} if n > GROUP_ROWS else set()
    if not big:
        parts.add("")
    while big:
        counted = placed(top, big).mapInArrow(cells, "part string, cell long, n long").groupBy("part", "cell").agg(F.sum("n").alias("n"))
        found = counted.groupBy("part").applyInArrow(split, "part string, f long, at long, gain double, total array<double>, left array<double>").collect()
        big = set()
        for r in found:
            path, total, left = r["part"], np.array(r["total"]), np.array(r["left"])
            known[path] = tools["decided"](path, total, (r["f"], r["at"], r["gain"]), cuts)
            if known[path]["feature"] < 0:
                continue
            top[path] = (r["f"], r["at"])
            for child, counts in ((path + "0", left), (path + "1", total - left)):
                if end := tools["untested"](child, counts):
                    known[child] = end
                elif counts.sum() > GROUP_ROWS:
                    big.add(child)
                else:
                    parts.add(child)

    def subtree(t):
        import pyarrow as pa

        part = t["part"][0].as_py()
        nodes = tools["grow"](part, tools["matrix"](t["bins"], kind, d), t["y"].to_numpy(), cuts, n_bins)
        schema = pa.schema([("part", pa.string()), ("path", pa.string()), *((c, pa.float64()) for c in ("prediction", "impurity", "gain")), ("feature", pa.int32()), ("threshold", pa.float64()), ("samples", pa.float64())])
        return pa.Table.from_pylist([{"part": part, **v} for v in nodes.values()], schema)

    grown = placed(top, parts).repartition(max(1, min(2 * len(parts), 10_000)), "part").groupBy("part").applyInArrow(subtree, _NODE)
    grown = written_once(grown, "tree-parts")
    roots = {r["path"]: r.asDict() for r in grown.where("path = part").collect()}
    whole = tools["merged"](known | {p: {k: v for k, v in r.items() if k != "part"} for p, r in roots.items()})
    gone = [p for p in roots if p not in whole]
    own = {p: v for p, v in whole.items() if p not in roots}
    names = [f.split()[0] for f in _NODE.split(", ")]
    mine = spark.createDataFrame([tuple(v.get(c) for c in names) for v in own.values()], _NODE)
    table = grown.where(~F.col("path").isin(gone)) if gone else grown
    inner = {p: (v["feature"], v["threshold"]) for p, v in own.items() if v["feature"] >= 0}
    return TreeModel(table.unionByName(mine), inner, {p: v["prediction"] for p, v in own.items() if v["feature"] < 0}, classes, d)
