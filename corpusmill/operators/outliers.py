"""Outlier filters over numeric features: isolation forest and local outlier factor.

Defined results: rows with a null feature take no part and are dropped; with fewer than two rows nothing is an outlier; equal
rows get equal scores; results don't depend on partitioning. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import materialize

#: Rows from which the forest draws its trees' samples, trees, and rows of a tree.
FOREST_SAMPLE = 25_600
TREES = 100
TREE_ROWS = 256
#: Distinct vectors of one kNN box, vectors that its tree is built from, and bins of one quantile pass.
BLOCK_ROWS = 1_000
TREE_SAMPLE = 100_000
BINS = 4_096


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = BINS, small: int = 50_000) -> float | None:
    """The linearly interpolated quantile: histograms narrow down both order statistics, so the driver never sees more than
    ``bins`` counts or ``small`` values."""
    values = df.where(F.col(column).isNotNull() & ~F.isnan(column)).select(F.col(column).cast("double").alias("v"))
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    at = q * (n - 1)
    k = int(at)

    def order_statistic(rank: int, lo: float, hi: float) -> float:
        live = values
        while lo < hi:
            width = (hi - lo) / bins
            if width == 0 or lo + width == lo:
                return lo
            inside = live.where((F.col("v") >= lo) & (F.col("v") <= hi))
            slot = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / width).cast("int"))
            counts = sorted(inside.groupBy(slot.alias("s")).agg(F.count("*").alias("c"), F.min("v").alias("a"), F.max("v").alias("b")).collect())
            before = 0
            for _, c, a, b in counts:
                if rank < before + c:
                    if a == b:
                        return a
                    if c <= small:
                        return sorted(r[0] for r in inside.where((F.col("v") >= a) & (F.col("v") <= b)).collect())[rank - before]
                    lo, hi, rank = a, b, rank - before
                    break
                before += c
        return lo

    first = order_statistic(k, low, high)
    if at == k:
        return first
    return first + (at - k) * (order_statistic(k + 1, low, high) - first)


# ------------------------------------------------------------------------------------------------------------ isolation forest
def _average_path(n: np.ndarray | float) -> np.ndarray:
    n = np.asarray(n, float)
    safe = np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe))


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, int]]:
    """Nodes (feature or -1, threshold, left, right, rows) of one tree."""
    nodes: list[tuple[int, float, int, int, int]] = []

    def build(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, -1, -1, len(part)))
        spread = np.flatnonzero(part.max(0) > part.min(0)) if len(part) > 1 and depth < limit else []
        if len(spread):
            f = int(rng.choice(spread))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            left = part[:, f] <= cut
            nodes[at] = (f, cut, build(part[left], depth + 1), build(part[~left], depth + 1), len(part))
        return at

    build(rows, 0)
    return nodes


def _depths(nodes: list[tuple[int, float, int, int, int]], x: np.ndarray) -> np.ndarray:
    feature, cut, left, right, size = (np.array(c) for c in zip(*nodes))
    at = np.zeros(len(x), int)
    depth = np.zeros(len(x))
    live = np.flatnonzero(feature[at] >= 0)
    while len(live):
        f = feature[at[live]]
        goes_left = x[live, f] <= cut[at[live]]
        at[live] = np.where(goes_left, left[at[live]], right[at[live]])
        depth[live] += 1
        live = live[feature[at[live]] >= 0]
    return depth + _average_path(size[at])


def isolation_forest(df: DataFrame, key: str, features: Sequence[str], contamination: float = 0.1, seed: int = 42, trees: int = TREES, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Input columns plus ``iso_score`` (lower is stranger) and ``is_outlier``: below the exact ``contamination`` quantile.

    Trees are grown on draws from the ``FOREST_SAMPLE`` rows with the smallest hash of their key (a bounded sample that doesn't
    depend on partitioning); every row is scored, and the threshold is taken over all scores.
    """
    columns = [F.col(f).cast("double") for f in features]
    rows = df.dropna(subset=list(features))
    sample = np.array(rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(FOREST_SAMPLE).select(*columns).collect(), float)
    if len(sample) < 2:
        return rows.withColumn("iso_score", F.lit(0.0)).withColumn("is_outlier", F.lit(False))
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(sample))
    forest = [_grow(sample[rng.choice(len(sample), size, replace=False)], rng, int(np.ceil(np.log2(size)))) for _ in range(trees)]
    shared = df.sparkSession.sparkContext.broadcast(forest)  # at most trees * 2 * tree_rows nodes
    scale = float(_average_path(size)) or 1.0

    @F.pandas_udf("double")
    def score(*parts: pd.Series) -> pd.Series:
        x = np.column_stack([p.to_numpy(float) for p in parts])
        mean = sum(_depths(nodes, x) for nodes in shared.value) / len(shared.value)
        return pd.Series(-np.power(2.0, -mean / scale))

    scored = materialize(rows.withColumn("iso_score", F.round(score(*columns), 12)), "isoscore")
    threshold = exact_quantile(scored, "iso_score", contamination)
    return scored.withColumn("is_outlier", F.col("iso_score") < F.lit(threshold))


# -------------------------------------------------------------------------------------------------------- local outlier factor
class Boxes:
    """A k-d tree over a bounded sample of the vectors: axis-parallel leaf boxes that cover space, about ``block_rows`` vectors each."""

    def __init__(self, sample: np.ndarray, leaf_rows: float, dims: int) -> None:
        self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._build(sample, leaf_rows, np.full(dims, -np.inf), np.full(dims, np.inf))
        self.lows, self.highs = np.array(self.low), np.array(self.high)

    def _build(self, part: np.ndarray, leaf_rows: float, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.dim)
        for column, value in ((self.dim, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.leaf, -1)):
            column.append(value)
        spread = part.max(0) - part.min(0) if len(part) else np.zeros(len(low))
        if len(part) > max(2, leaf_rows) and spread.max() > 0:
            d = int(spread.argmax())
            cut = float(np.median(part[:, d]))
            if not (part[:, d] < cut).any():  # more than half share the smallest value: cut above it
                cut = float(part[part[:, d] > cut, d].min())
            below = part[:, d] < cut
            self.dim[at], self.cut[at] = d, cut
            upper, lower = high.copy(), low.copy()
            upper[d] = lower[d] = cut
            self.left[at] = self._build(part[below], leaf_rows, low, upper)
            self.right[at] = self._build(part[~below], leaf_rows, lower, high)
        else:
            self.leaf[at] = len(self.low)
            self.low.append(low)
            self.high.append(high)
        return at

    def place(self, x: np.ndarray) -> np.ndarray:
        dim, cut, left, right, leaf = (np.array(c) for c in (self.dim, self.cut, self.left, self.right, self.leaf))
        at = np.zeros(len(x), int)
        live = np.flatnonzero(leaf[at] < 0)
        while len(live):
            n = at[live]
            at[live] = np.where(x[live, dim[n]] < cut[n], left[n], right[n])
            live = live[leaf[at[live]] < 0]
        return leaf[at]

    def touching(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of each leaf that comes as near to a point as its ``radius``: all points go down the tree together, on both sides
        of a cut where their ball reaches across, so no point looks at leaves far away."""
        dim, cut, left, right, leaf = (np.array(c) for c in (self.dim, self.cut, self.left, self.right, self.leaf))
        point, node = np.arange(len(x)), np.zeros(len(x), int)
        points, leaves = [np.array([], int)], [np.array([], int)]
        while len(point):
            at = leaf[node]
            done = at >= 0
            gap = np.maximum(0.0, np.maximum(self.lows[at[done]] - x[point[done]], x[point[done]] - self.highs[at[done]]))
            near = np.sqrt((gap**2).sum(1)) <= radius[point[done]]
            points.append(point[done][near])
            leaves.append(at[done][near])
            point, node = point[~done], node[~done]
            here, r = x[point, dim[node]], radius[point]
            low, high = here - r < cut[node], here + r >= cut[node]
            point, node = np.concatenate([point[low], point[high]]), np.concatenate([left[node[low]], right[node[high]]])
        return np.concatenate(points), np.concatenate(leaves)


#: Distances that a task computes at once.
STEP = 4_000_000


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(sum((x[:, None, d] - y[None, :, d]) ** 2 for d in range(x.shape[1])))


def _candidates(own: np.ndarray, others: np.ndarray, copies: np.ndarray, enough: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each own vector the indexes of those others, ties included, that hold at least ``enough`` rows, and the distance reached
    (infinite where all of them together hold fewer)."""
    found: list[np.ndarray] = []
    reach = np.full(len(own), np.inf)
    m = min(enough, len(others))
    total = copies.sum()
    step = max(1, STEP // max(1, len(others)))
    for start in range(0, len(own), step):
        d = _near(own[start : start + step], others)
        limit = np.partition(d, m - 1, axis=1)[:, m - 1] if m else np.full(len(d), np.inf)
        for row in range(len(d)):
            pick = np.flatnonzero(d[row] <= limit[row])
            near = pick[np.argsort(d[row, pick], kind="stable")]
            if total >= enough:
                last = d[row, near[np.searchsorted(np.cumsum(copies[near]), enough)]]
                near = near[d[row, near] <= last]
                reach[start + row] = last
            found.append(near)
    return found, reach


def _own_leaf(names: list[str], k: int, block_rows: int, bound: Callable[[np.ndarray], np.ndarray]):
    """Neighbours of a leaf's vectors within the leaf, and the radius that they leave to be asked elsewhere. A large leaf is cut into
    boxes of its own: a vector looks at its own box first and then only at those its ball touches."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, copies, vid = pdf[names].to_numpy(float), pdf["copies"].to_numpy(), pdf["vid"].to_numpy()
        boxes = Boxes(x, block_rows, len(names))
        home = boxes.place(x)
        order = np.argsort(home, kind="stable")
        edges = np.searchsorted(home[order], np.arange(len(boxes.lows) + 1))
        members = [order[a:b] for a, b in zip(edges, edges[1:])]
        reach = np.full(len(x), np.inf)
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        for inside in members:
            picks, reach[inside] = _candidates(x[inside], x[inside], copies[inside], k + 1)
            rows.append((np.repeat(inside, [len(p) for p in picks]), inside[np.concatenate(picks)]))
        lone = np.isinf(reach)
        if lone.any():
            reach[lone] = bound(x[lone])
        asking, box = boxes.touching(x, reach)
        other = box != home[asking]
        asking, box = asking[other], box[other]
        by_box = np.argsort(box, kind="stable")
        for part in np.split(by_box, np.flatnonzero(np.diff(box[by_box])) + 1) if len(by_box) else ():
            rows += _asked(x[asking[part]], reach[asking[part]], asking[part], x, members[box[part[0]]], k)
        i, j = (np.concatenate([r[n] for r in rows]) for n in (0, 1))
        distance = np.sqrt(((x[j] - x[i]) ** 2).sum(1))
        return pd.DataFrame({"vid": vid[i], "oid": vid[j], "distance": distance, "copies": copies[j], "radius": reach[i]} | {n: x[j, d] for d, n in enumerate(names)})

    return run


def _asked(q: np.ndarray, radius: np.ndarray, numbers: np.ndarray, x: np.ndarray, inside: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(number of the query, index of a vector) of a box's vectors within each query's radius; of very many only the nearest."""
    out = []
    step = max(1, STEP // max(1, len(inside)))
    for start in range(0, len(q), step):
        d = _near(q[start : start + step], x[inside])
        near = d <= radius[start : start + step, None]
        full = np.flatnonzero(near.sum(1) > 4 * (k + 1))  # a dense box: only its nearest can matter
        if len(full):
            limit = np.partition(d[full], k, axis=1)[:, k]
            near[full] &= d[full] <= limit[:, None]
        i, j = np.nonzero(near)
        out.append((numbers[start + i], inside[j]))
    return out


def _other_leaf(names: list[str], k: int, block_rows: int):
    columns = ["vid", "oid", "distance", "copies", *names]

    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({c: [] for c in columns})
        q, x, copies, oid = queries[names].to_numpy(float), vectors[names].to_numpy(float), vectors["copies"].to_numpy(), vectors["vid"].to_numpy()
        vid, radius = queries["vid"].to_numpy(), queries["radius"].to_numpy()
        boxes = Boxes(x, block_rows, len(names))
        home = boxes.place(x)
        asking, box = boxes.touching(q, radius)
        rows = [(np.array([], int), np.array([], int))]
        by_box = np.argsort(box, kind="stable")
        for part in np.split(by_box, np.flatnonzero(np.diff(box[by_box])) + 1) if len(by_box) else ():
            rows += _asked(q[asking[part]], radius[asking[part]], asking[part], x, np.flatnonzero(home == box[part[0]]), k)
        i, j = (np.concatenate([r[n] for r in rows]) for n in (0, 1))
        return pd.DataFrame({"vid": vid[i], "oid": oid[j], "distance": np.sqrt(((x[j] - q[i]) ** 2).sum(1)), "copies": copies[j]} | {n: x[j, c] for c, n in enumerate(names)})

    return run


def nearest_neighbours(vectors: DataFrame, features: Sequence[str], k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vid, oid, distance, weight): for each distinct vector (vid, features..., copies) its ``k`` nearest rows, exactly.

    Space is cut into the leaf boxes of a k-d tree over a bounded sample, so the tree is bounded and leaves grow with the table; each
    leaf is cut further by the task that has it. A first pass finds each vector's neighbours within its own leaf and so a radius; a
    second one asks only those other leaves that the ball of this radius touches. A vector whose leaf holds too few takes its radius
    from the sample, whose vectors are as real as any. Ties in distance are broken by the coordinates. ``weight`` is how many of a
    vector's copies are among the ``k``, its own copy aside.
    """
    names = list(features)
    spark = vectors.sparkSession
    total = vectors.count()
    drawn = np.array(vectors.orderBy(F.xxhash64(*names), *names).limit(TREE_SAMPLE).select(*names, "copies").collect(), float).reshape(-1, len(names) + 1)
    sample, held = drawn[:, :-1], drawn[:, -1]
    boxes = spark.sparkContext.broadcast(Boxes(sample, max(block_rows * len(sample) / max(total, 1), 2 * (k + 1) if total > len(sample) else 1), len(names)))
    points = spark.sparkContext.broadcast((sample, held))

    def bound(x: np.ndarray) -> np.ndarray:
        return _candidates(x, *points.value, k + 1)[1]

    @F.pandas_udf("int")
    def place(*parts: pd.Series) -> pd.Series:
        return pd.Series(boxes.value.place(np.column_stack([p.to_numpy(float) for p in parts])))

    placed = materialize(vectors.withColumn("leaf", place(*names)), "placed")
    coordinates = ", ".join(f"{f} double" for f in names)
    inner = materialize(placed.groupBy("leaf").applyInPandas(_own_leaf(names, k, block_rows, bound), f"vid bigint, oid bigint, distance double, copies bigint, radius double, {coordinates}"), "inner")
    radius = inner.groupBy("vid").agg(F.max("radius").alias("radius"))

    def touched(batches):
        for pdf in batches:
            x, radius, home = pdf[names].to_numpy(float), pdf["radius"].to_numpy(), pdf["leaf"].to_numpy()
            i, leaf = boxes.value.touching(x, radius)
            i, leaf = i[leaf != home[i]], leaf[leaf != home[i]].astype(np.int32)
            yield pd.DataFrame({"vid": pdf["vid"].to_numpy()[i]} | {n: x[i, d] for d, n in enumerate(names)} | {"radius": radius[i], "leaf": leaf})

    asked = placed.join(radius, "vid").select("vid", *names, "radius", "leaf").mapInPandas(touched, f"vid bigint, {coordinates}, radius double, leaf int")
    outer = asked.groupBy("leaf").cogroup(placed.groupBy("leaf")).applyInPandas(_other_leaf(names, k, block_rows), f"vid bigint, oid bigint, distance double, copies bigint, {coordinates}")
    offers = inner.drop("radius").unionByName(outer).withColumn("rows", F.col("copies") - (F.col("vid") == F.col("oid")).cast("long"))
    order = Window.partitionBy("vid").orderBy("distance", *names).rowsBetween(Window.unboundedPreceding, -1)
    ranked = offers.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))
    return ranked.where((F.col("before") < k) & (F.col("rows") > 0)).select("vid", "oid", "distance", F.least("rows", F.lit(k) - F.col("before")).alias("weight"))


def local_outlier_factor(df: DataFrame, key: str, features: Sequence[str], neighbours: int = 20, contamination: float = 0.1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Input columns plus ``lof`` and ``is_outlier``: above the exact ``1 - contamination`` quantile.

    ``k`` is ``min(neighbours, rows - 1)``. Equal rows are one vector with a count, so copies never multiply work.
    """
    rows = df.dropna(subset=list(features))
    n = rows.count()
    k = min(neighbours, n - 1)
    if k < 1:
        return rows.withColumn("lof", F.lit(1.0)).withColumn("is_outlier", F.lit(False))
    names = list(features)
    exact: list[Column] = [F.col(f).cast("double").alias(f) for f in names]
    counted = rows.select(*exact).groupBy(*names).agg(F.count("*").alias("copies"))
    vectors = materialize(counted.withColumn("vid", F.monotonically_increasing_id()), "distinct")
    near = materialize(nearest_neighbours(vectors, names, k, block_rows), "neighbours")
    reach = near.groupBy("vid").agg(F.max("distance").alias("kdist"))
    reached = near.select("vid", "oid", "distance", "weight").join(reach.select(F.col("vid").alias("oid"), "kdist"), "oid")
    density = reached.groupBy("vid").agg(F.sum(F.greatest("kdist", "distance") * F.col("weight")).alias("s"), F.sum("weight").alias("w"))
    density = materialize(density.select("vid", (1.0 / (F.col("s") / F.col("w") + 1e-10)).alias("lrd")), "density")
    others = near.join(density.select(F.col("vid").alias("oid"), F.col("lrd").alias("other_lrd")), "oid")
    factor = others.groupBy("vid").agg((F.sum(F.col("other_lrd") * F.col("weight")) / F.sum("weight")).alias("mean_lrd")).join(density, "vid")
    factor = factor.select("vid", (F.col("mean_lrd") / F.col("lrd")).alias("lof"))
    told = vectors.join(factor, "vid").select(*(F.col(f).alias(f"__{f}") for f in names), "lof")
    same = [F.col(f).cast("double") == F.col(f"__{f}") for f in names]
    scored = materialize(rows.join(told, same).drop(*(f"__{f}" for f in names)), "lof")
    threshold = exact_quantile(scored, "lof", 1 - contamination)
    return scored.withColumn("is_outlier", F.col("lof") > F.lit(threshold))
