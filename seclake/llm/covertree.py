"""Embedding near-duplicates: exact threshold pairs by cover trees, traversed in pairs.

Vectors are compared if their labels are equal and not null. On the unit
sphere a cosine of at least ``least`` is a distance of at most
``sqrt(2 - 2 least)``, so the cosine join is a distance join.

1. Equal vectors of a label become one *point* with a multiplicity.
2. Upper level. Labels with many points get pivots (a bounded sample, by
   hash, shared out by size); each point lives in the cell of its nearest
   pivot, and a cell's covering radius is its farthest point's distance. A
   point also visits every cell of a higher number that its distance to the
   pivot, the covering radius and the bisector of the two pivots don't rule
   out. Every pair within the distance meets in exactly one cell.
3. Cells are dealt to tasks of at most ``TASK_POINTS`` residents and as
   many others, so that a hot label or cell is spread.
4. In a task each side gets a cover tree: nested nodes whose radii halve level
   by level, each with the true covering radius of what lies below. Pairs of
   nodes are walked down together; a pair farther apart than the two radii and
   the distance allow is dropped with all below it, a pair so close
   that all below must link is counted at once.
5. Tasks send link counts per point and a spanning forest, never the pairs.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows
without label, link with nothing. Vectors of different lengths don't link.
Repeated rows are vectors of their own; a null id is never the smallest
unless the whole component has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import components, local_components, unit_hash
from seclake.session import materialize

TASK_POINTS = 2048
CELL_POINTS = 4096
MAX_PIVOTS = 1024
LEAF = 32
#: Rounding of the distances that prune; what they keep is decided by the cosine itself.
SLACK = 1e-7


class CoverTree:
    """Nested nodes over unit vectors; the radii of a level are half of those above."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))       # the points of a node are order[first:end]
        self.centre, self.radius, self.first, self.end, self.children = [], [], [], [], []
        if len(points):
            self._node(0, 0, len(points), np.sqrt(np.maximum(0, 2 - 2 * points @ points[0])))
            todo = [(0, 2.0)]
            while todo:
                node, reach = todo.pop()
                todo += self._split(node, reach)

    def _node(self, centre: int, first: int, end: int, distances: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(distances.max()))
        self.first.append(first)
        self.end.append(end)
        self.children.append(())
        return len(self.centre) - 1

    def _split(self, node: int, reach: float) -> list[tuple[int, float]]:
        """Children of half the reach, the node's own centre first (nesting), until each point is covered."""
        first, end = self.first[node], self.end[node]
        if end - first <= LEAF or self.radius[node] <= SLACK:  # equal but for rounding
            return []
        reach /= 2
        while reach >= self.radius[node]:
            reach /= 2
        mine = self.order[first:end]
        points = self.points[mine]
        nearest = np.full(len(mine), np.inf)
        owner = np.zeros(len(mine), dtype=np.int64)
        centres: list[int] = []
        new = int(np.nonzero(mine == self.centre[node])[0][0])
        while True:
            away = np.sqrt(np.maximum(0, 2 - 2 * points @ points[new]))
            away[new] = 0
            closer = away < nearest
            owner[closer], nearest[closer] = len(centres), away[closer]
            centres.append(int(mine[new]))
            new = int(nearest.argmax())
            if nearest[new] <= reach:
                break
        by_owner = np.argsort(owner, kind="stable")
        self.order[first:end] = mine[by_owner]
        sizes, at, out = np.bincount(owner, minlength=len(centres)), first, []
        away = nearest[by_owner]
        for centre, n in zip(centres, sizes):
            if n:
                out.append(self._node(centre, at, at + n, away[at - first:at - first + n]))
                at += n
        self.children[node] = tuple(out)
        return [(child, reach) for child in out]


def dual(a: CoverTree, b: CoverTree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool | None]]:
    """What the walk can't rule out, as blocks (rows of a, rows of b, all pairs link for
    certain), or with None pair by pair. With ``b is a`` two nodes meet once."""
    if not len(a.points) or not len(b.points):
        return
    same = a is b
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        kids_x, kids_y = a.children[x] or (x,), b.children[y] or (y,)
        if kids_x == (x,) and kids_y == (y,):
            yield a.order[a.first[x]:a.end[x]], b.order[b.first[y]:b.end[y]], False
            continue
        cx, cy = a.points[[a.centre[k] for k in kids_x]], b.points[[b.centre[k] for k in kids_y]]
        rx, ry = np.array([a.radius[k] for k in kids_x]), np.array([b.radius[k] for k in kids_y])
        nx, ny = np.array([a.end[k] - a.first[k] for k in kids_x]), np.array([b.end[k] - b.first[k] for k in kids_y])
        for low in range(0, len(kids_x), 512):
            part = slice(low, low + 512)
            apart = np.sqrt(np.maximum(0, 2 - 2 * cx[part] @ cy.T))
            both = rx[part][:, None] + ry[None, :]
            near = apart <= both + reach + SLACK
            if same and x == y:
                near &= np.arange(low, low + len(apart))[:, None] <= np.arange(len(kids_y))[None, :]
            sure = near & (apart + both < reach - SLACK)
            single = near & ~sure & (nx[part][:, None] == 1) & (ny[None, :] == 1)
            for i, j in zip(*np.nonzero(sure)):
                u, v = kids_x[low + i], kids_y[j]
                yield a.order[a.first[u]:a.end[u]], b.order[b.first[v]:b.end[v]], True
            for i, j in zip(*np.nonzero(near & ~sure & ~single)):
                todo.append((kids_x[low + i], kids_y[j]))
            i, j = np.nonzero(single)
            for k in range(0, len(i), 65536):
                yield a.order[[a.first[kids_x[low + r]] for r in i[k:k + 65536]]], b.order[[b.first[kids_y[r]] for r in j[k:k + 65536]]], None


def join(points: np.ndarray, norms: np.ndarray, weight: np.ndarray, others: tuple | None, least: float):
    """Links among ``points`` or between them and ``others`` (points, norms, weight):
    linked weight of each, of each of the others, and the two ends of a spanning
    forest's edges, which number the others after the points."""
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    raw_b, norms_b, weight_b = (points, norms, weight) if others is None else others
    unit_a, unit_b = points / norms[:, None], raw_b / norms_b[:, None]
    a = CoverTree(unit_a)
    b = a if others is None else CoverTree(unit_b)
    links_a, links_b = np.zeros(len(points), dtype=np.int64), np.zeros(len(raw_b), dtype=np.int64)
    first = 0 if others is None else len(points)
    label = np.arange(len(points) if others is None else len(points) + len(raw_b))
    for rows, cols, sure in dual(a, b, reach):
        if sure is None:  # single pairs
            keep = rows != cols if others is None else np.ones(len(rows), dtype=bool)
            rows, cols = rows[keep], cols[keep]
            cosine = np.einsum("ij,ij->i", points[rows], raw_b[cols]) / (norms[rows] * norms_b[cols])
            near = cosine >= least
            rows, cols = rows[near], cols[near]
            np.add.at(links_a, rows, weight_b[cols])
            np.add.at(links_b, cols, weight[rows])
        else:
            if sure:
                near = np.ones((len(rows), len(cols)), dtype=bool)
            else:
                cosine = (points[rows] @ raw_b[cols].T) / (norms[rows][:, None] * norms_b[cols][None, :])
                near = cosine >= least
            if others is None and rows[0] == cols[0] and len(rows) == len(cols):  # a node with itself: each pair stands there twice
                near &= ~np.eye(len(rows), dtype=bool)
                links_a[rows] += near @ weight_b[cols]
            else:
                links_a[rows] += near @ weight_b[cols]
                links_b[cols] += weight[rows] @ near
            i, j = np.nonzero(near)
            rows, cols = rows[i], cols[j]
        label = local_components(len(label), rows, cols + first, label)
    member = np.nonzero(label != np.arange(len(label)))[0]
    if others is None:
        links_a = links_a + links_b
    return links_a, links_b, label[member], member


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stack(vectors: pd.Series) -> np.ndarray:
    """Vectors as doubles, scaled by their largest component so that no norm over- or underflows."""
    out = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    return out / np.abs(out).max(axis=1, keepdims=True)


def _norms(points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", points, points))


def _place(pivots: dict, radii: dict | None, reach: float):
    """Deals points to cells: (class, cell, whether it lives there, distance to the pivot).
    Without radii only the homes."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            out = []
            for key, part in frame.groupby("class", sort=False):
                centres = pivots.get(key)
                if centres is None:
                    out.append(part.assign(cell=0, home=True, away=0.0))
                    continue
                points = _stack(part["v"])
                points /= _norms(points)[:, None]
                for low in range(0, len(part), 4096):
                    block = points[low:low + 4096]
                    away = np.sqrt(np.maximum(0, 2 - 2 * block @ centres.T))
                    home = away.argmin(axis=1)
                    near = away[np.arange(len(block)), home]
                    here = part.iloc[low:low + 4096]
                    out.append(here.assign(cell=home, home=True, away=near))
                    if radii is not None:
                        between = np.sqrt(np.maximum(1e-12, 2 - 2 * centres @ centres.T))[home]
                        bisector = (away ** 2 - (near ** 2)[:, None]) / (2 * between)
                        visits = (away <= radii[key][None, :] + reach + SLACK) & (bisector <= reach + 1e-5) & (np.arange(len(centres))[None, :] > home[:, None])
                        i, j = np.nonzero(visits)
                        out.append(here.iloc[i].assign(cell=j, home=False, away=away[i, j]))
            yield pd.concat(out)[["point", "class", "v", "weight", "cell", "home", "away"]] if out else frame.assign(cell=0, home=True, away=0.0)
    return run


PLACED = "point long, class string, v array<double>, weight long, cell int, home boolean, away double"


def links(points: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Of ``points(point, class, v, weight)``: (``point, n`` links by weight, spanning ``a, b`` edges)."""
    spark = points.sparkSession
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    total = points.count()
    sizes = points.groupBy("class").agg(F.count("*").alias("n"))
    # Pivots: a share of MAX_PIVOTS by size for each class that fills more than a cell.
    share = F.floor(F.least(F.lit(float(MAX_PIVOTS)) * F.col("n") / max(total, 1), F.col("n") / CELL_POINTS)).cast("int")
    large = sizes.select("class", "n", share.alias("pivots")).where("pivots > 1")
    drawn = points.join(large, "class").where(unit_hash("point", seed=5) < 2.0 * F.col("pivots") / F.col("n")).select("class", "pivots", "v", F.xxhash64("point").alias("at")).orderBy("at").limit(2 * MAX_PIVOTS).collect()
    pivots: dict[str, list] = {}
    for r in drawn:
        if len(pivots.setdefault(r["class"], [])) < r["pivots"]:
            pivots[r["class"]].append(r["v"])
    pivots = {k: (x := _stack(v)) / _norms(x)[:, None] for k, v in pivots.items()}
    radii = {k: np.zeros(len(v)) for k, v in pivots.items()}
    if pivots:
        homes = points.where(F.col("class").isin(list(pivots))).mapInPandas(_place(pivots, None, reach), PLACED)
        for r in homes.groupBy("class", "cell").agg(F.max("away").alias("away")).collect():  # at most MAX_PIVOTS rows
            radii[r["class"]][r["cell"]] = r["away"]
    placed = materialize(points.mapInPandas(_place(pivots, radii, reach), PLACED).drop("away"), "cells")

    key = ["class", "cell"]
    parts = placed.groupBy(*key).agg(*[F.greatest(F.lit(1), F.ceil(F.count(F.when(side, 1)) / TASK_POINTS)).cast("int").alias(name) for side, name in ((F.col("home"), "residents"), (~F.col("home"), "visitors"))],
                                     F.count(F.when(~F.col("home"), 1)).alias("guests"))
    dealt = placed.join(parts, key)
    part = F.floor(unit_hash("point", seed=6) * F.when(F.col("home"), F.col("residents")).otherwise(F.col("visitors"))).cast("int")
    dealt = dealt.withColumn("part", part)
    struct = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    all_of = lambda n: F.sequence(F.lit(0), n - 1)
    # Tasks (i, j) with i <= j: residents' parts i and j; with j < 0: residents' part i and visitors' part -1 - j.
    among = F.transform(all_of(F.col("residents")), lambda k: F.when(k < F.col("part"), struct(k, F.col("part"), 1)).otherwise(struct(F.col("part"), k, 0)))
    hosting = F.filter(F.transform(all_of(F.col("visitors")), lambda k: struct(F.col("part"), -1 - k, 0)), lambda _: F.col("guests") > 0)
    visiting = F.transform(all_of(F.col("residents")), lambda k: struct(k, -1 - F.col("part"), 1))
    tasks = dealt.withColumn("task", F.explode(F.when(F.col("home"), F.concat(among, hosting)).otherwise(visiting)))
    tasks = tasks.select(*key, "task.i", "task.j", "task.side", "point", "v", "weight")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        here, there = frame[frame["side"] == 0], frame[frame["side"] == 1]
        if not len(here) or frame["i"].iloc[0] != frame["j"].iloc[0] and not len(there):
            return pd.DataFrame({"point": [], "other": [], "n": []})
        points = _stack(here["v"])
        others = None
        if len(there):
            x = _stack(there["v"])
            others = (x, _norms(x), there["weight"].to_numpy(dtype=np.int64))
        mine, theirs, low, high = join(points, _norms(points), here["weight"].to_numpy(dtype=np.int64), others, least)
        ids = np.concatenate([here["point"], there["point"]])
        counts = np.concatenate([mine, theirs]) if len(there) else mine
        some = np.nonzero(counts)[0]
        return pd.DataFrame({"point": np.concatenate([ids[some], ids[low]]), "other": np.concatenate([ids[some], ids[high]]), "n": np.concatenate([counts[some], np.zeros(len(low), dtype=np.int64)])})

    found = materialize(tasks.groupBy(*key, "i", "j").applyInPandas(run, "point long, other long, n long"), "links")
    return found.where("n > 0").groupBy("point").agg(F.sum("n").alias("n")), found.where("n = 0").select(F.col("point").alias("a"), F.col("other").alias("b"))


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``."""
    vector = F.col(vector_col)
    text = F.concat_ws("|", F.size(vector).cast("string"), F.col(label_col).cast("string"))
    rows = vectors.select(F.col(id_col).alias("id"), vector.alias("v"), F.monotonically_increasing_id().alias("row"),
                          F.when(usable(vector) & F.col(label_col).isNotNull(), text).alias("class"))
    rows = materialize(rows.withColumn("same", F.when(F.col("class").isNotNull(), F.sha2(F.concat_ws(" ", "class", F.concat_ws(",", F.col("v").cast("array<string>"))), 256))), "vectors")
    points = rows.where("class is not null").groupBy("same").agg(F.min("id").alias("id"), F.min("row").alias("point"), F.first("class").alias("class"), F.first("v").cast("array<double>").alias("v"), F.count("*").alias("weight"))
    points = materialize(points, "points")
    counts, edges = links(points.select("point", "class", "v", "weight"), least)
    member = components(edges)
    named = points.drop("v", "class").join(member.withColumnRenamed("node", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    least_id = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.drop("id").join(least_id, "root").join(counts, "point", "left").select("same", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("class is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.where("class is not null").join(named, "same").select("id", "n_links", "component_id")
    return linked.unionAll(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
