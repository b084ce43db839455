"""Isolation trees (Liu, Ting & Zhou 2008) fitted for every group at once.

A tree sees about ``sample`` rows of its group, as published. The sample is drawn
before any shuffle, so a group brings at most trees x sample rows to one task
however large it is; its trees then grow there level by level in numpy. Cuts come from md5
hashes, so a fit is the same on any partitioning.

The fitted table has one row per group. Its ``forest`` holds the nodes of all
trees in flat arrays: the feature and cut of a node, the place of its left child
(the right one follows; 0 marks a leaf) and a leaf's depth; ``roots`` are the
places of the tree tops. Scoring a row of several features walks these arrays in one
column expression. With one feature the depth is a step function of it, so the trees
are added up to steps once a group, and a row looks its step up by two small joins.
Either way rows are neither opened nor grouped again, so equal rows stay apart and a
join of rows with forests is free to split a large group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import hash_unit
from ..functions.staging import spread, stage

SAMPLE = 256  # rows per tree, the published default
EULER = 0.5772156649
FOREST = (
    "roots array<int>, feature array<int>, cut array<double>, left array<int>, "
    "value array<double>, psi double"
)
BLOCK = 160  # steps in a row of a step table; 100 trees of 256 rows have up to 25,500
STEPS = "_block int, _at array<double>, _depth array<double>"


def path_bonus(n: Column) -> Column:
    """Mean depth of an unsuccessful search among n rows."""
    n = n.cast("double")
    many = 2.0 * (F.log(n - 1) + EULER) - 2.0 * (n - 1) / n
    return F.when(n > 2, many).when(n == 2, 1.0).otherwise(0.0)


def _draw(
    df: DataFrame, keys: Sequence[str], label: Column, trees: int, seed: int, sizes: str | None, sample: int
) -> DataFrame:
    """The sampled rows, each with the array of trees that see it.

    A row has one hash in [0, 1); tree t takes the hashes in a stretch of length
    sample / n that starts at t / trees, wrapping around. Only the trees whose start
    is near enough are tried.
    """
    if sizes is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        sized = df.join(stage(counts, "sizes"), list(keys))
    else:
        sized = df.withColumn("_n", F.col(sizes))
    unit = hash_unit(F.concat_ws("|", F.lit(str(seed)), *keys, label))

    def seeing(row: Column) -> Column:
        u, share = row["u"], row["share"]
        near = F.least(F.ceil(share * trees) + 3, F.lit(trees)).cast("int")
        first = F.floor((1 - u) * trees).cast("int") - 1
        tried = F.transform(F.sequence(F.lit(0), near - 1), lambda i: F.pmod(first + i, F.lit(trees)))
        return F.filter(
            tried, lambda t: (share >= 1.0) | (F.pmod(u + t / F.lit(float(trees)), F.lit(1.0)) < share)
        )

    # as the variable of a lambda the hash is made once a row, not once a tree
    row = F.struct(unit.alias("u"), (F.lit(sample) / F.col("_n")).alias("share"))
    seen = F.get(F.transform(F.array(row), seeing), F.lit(0))
    return sized.withColumn("_trees", seen).where(F.size("_trees") > 0)


def _units(keys: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in [0, 1) per key, from the first two words of its md5."""
    words = b"".join(hashlib.md5(k.encode()).digest()[:8] for k in keys)
    pairs = np.frombuffer(words, dtype=">u4").reshape(-1, 2) / 2.0**32
    return pairs[:, 0], pairs[:, 1]


def _leaf_bonus(n: np.ndarray) -> np.ndarray:
    many = np.maximum(n, 3.0)
    search = 2.0 * (np.log(many - 1) + EULER) - 2.0 * (many - 1) / many
    return np.where(n > 2, search, np.where(n == 2, 1.0, 0.0))


def levels_of(sample: int) -> int:
    """Depth at which a tree of ``sample`` rows stops."""
    return max(sample - 1, 1).bit_length()


def _grow(keys: Sequence[str], features: Sequence[str], seed: int, levels: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def grow(group: pd.DataFrame) -> pd.DataFrame:
        name = [group[k].iloc[0] for k in keys]
        x, weight = group[list(features)].to_numpy(float), group["_w"].to_numpy(float)
        row = np.repeat(np.arange(len(group)), group["_trees"].map(len))
        tree = np.concatenate(group["_trees"].to_numpy()).astype(np.int64)
        node = np.ones(len(row), np.int64)
        text, made, limit, psi = "|".join(map(str, name)), [], None, None
        for level in range(levels + 1):
            order = np.lexsort((node, tree))
            row, tree, node = row[order], tree[order], node[order]
            new = np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]
            start, at = np.flatnonzero(new), np.cumsum(new) - 1
            t, k = tree[start], node[start]
            low = np.minimum.reduceat(x[row], start)
            high = np.maximum.reduceat(x[row], start)
            size = np.add.reduceat(weight[row], start)
            if level == 0:
                count = np.diff(np.r_[start, len(row)])
                limit = np.zeros(t.max() + 1, int)
                limit[t] = [min(int(max(c, 2) - 1).bit_length(), levels) for c in count]
                psi = size.mean()
            wide = high > low
            inner = (level < limit[t]) & wide.any(axis=1)
            feature, cut = np.zeros(len(t), int), np.zeros(len(t))
            inside = np.flatnonzero(inner)
            if len(inside):
                u, v = _units(f"{seed}|{a}|{text}|{b}" for a, b in zip(t[inside], k[inside]))
                chosen = wide[inside]
                pick = np.floor(v * chosen.sum(axis=1)).astype(int)
                f = np.argmax(np.cumsum(chosen, axis=1) == (pick + 1)[:, None], axis=1)
                a, b = low[inside, f], high[inside, f]
                point = a + u * (b - a)
                # Above the least and not above the greatest value: both sides get a row.
                feature[inside], cut[inside] = f, np.where(point > a, point, b)
            made.append((t, k, inner, feature, cut, np.where(inner, 0.0, level + _leaf_bonus(size))))
            if not len(inside):
                break
            go = inner[at]
            row, tree, node, at = row[go], tree[go], node[go], at[go]
            node = 2 * node + (x[row, feature[at]] >= cut[at])
        t, k, inner, feature, cut, value = (np.concatenate(c) for c in zip(*made))
        order = np.lexsort((k, t))
        t, inner = t[order], inner[order]
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        base = np.repeat(first, np.diff(np.r_[first, len(t)]))
        done = np.cumsum(inner)
        # In level order the i-th inner node of a tree has its children at 2i and 2i + 1.
        rank = done - (done[base] - inner[base])
        left = np.where(inner, base + 2 * rank, 0)
        out = [first + 1, feature[order], cut[order], left, value[order]]
        return pd.DataFrame([name + out + [psi]])

    return grow


def fit_forest(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: Column,
    trees: int = 100,
    seed: int = 42,
    weight: str | None = None,
    sizes: str | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per group: keys, ``forest`` and ``psi`` (mean rows seen by a tree).

    ``label`` identifies a row within its group; ``weight`` counts equal rows;
    ``sizes`` names a column with the group's number of rows, if there is one.
    """
    keys, features = list(keys), list(features)
    weighted = df.withColumn("_w", F.col(weight).cast("double") if weight else F.lit(1.0))
    drawn = _draw(weighted, keys, label, trees, seed, sizes, sample).select(*keys, *features, "_w", "_trees")
    types = ", ".join(f"{k} {dict(df.dtypes)[k]}" for k in keys)
    grow = _grow(keys, features, seed, levels_of(sample))
    grown = spread(drawn, *keys).groupBy(*keys).applyInPandas(grow, f"{types}, {FOREST}")
    return grown.select(*keys, F.struct("roots", "feature", "cut", "left", "value").alias("forest"), "psi")


def isolation(x: Column, forest: Column, psi: Column, sample: int = SAMPLE) -> Column:
    """2^(-depth / c(psi)) of a feature array: near 1 if it is isolated early.

    All trees go down one level per ``transform``; a leaf stays where it is.
    """

    def below(at: Column) -> Column:
        node = lambda name: F.get(forest[name], at - 1)
        right = (F.get(x, node("feature")) >= node("cut")).cast("int")
        return F.coalesce(F.nullif(node("left"), F.lit(0)) + right, at)

    at = forest["roots"]
    for _ in range(levels_of(sample)):
        at = F.transform(at, below)
    depth = F.aggregate(at, F.lit(0.0), lambda total, leaf: total + F.get(forest["value"], leaf - 1))
    return _score(depth, F.size(forest["roots"]), psi)


def _score(depth: Column, trees: Column, psi: Column) -> Column:
    return F.pow(F.lit(2.0), -(depth / trees) / path_bonus(psi))


def _steps(keys: Sequence[str], sample: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The summed depth of a group's trees of one feature, as steps: from ``_at`` on it is ``_depth``.

    Depths are added up in the order of the trees. Block 0 holds the depth of a missing value.
    """

    def stepped(group: pd.DataFrame) -> pd.DataFrame:
        name = [group[k].iloc[0] for k in keys]
        roots, cut, left, value = (np.asarray(group[c].iloc[0]) for c in ("roots", "cut", "left", "value"))
        inner = np.flatnonzero(left)
        # a tree's own steps start at its cuts and below all of them
        tree = np.r_[np.searchsorted(roots, inner + 1, "right") - 1, np.arange(len(roots))]
        x = np.r_[cut[inner], np.full(len(roots), -np.inf)]
        order = np.lexsort((x, tree))
        tree, x = tree[order], x[order]
        at = roots[tree] - 1
        for _ in range(levels_of(sample)):
            at = np.where(left[at] > 0, left[at] - 1 + (x >= cut[at]), at)
        starts, depth = np.unique(x), 0.0
        tops = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        for a, b in zip(tops, np.r_[tops[1:], len(tree)]):
            depth = depth + value[at[a:b]][np.searchsorted(x[a:b], starts, "right") - 1]
        missing = 0.0
        for root in roots:
            missing += value[root - 1]
        out = [(*name, 0, [], [missing])]
        for block, a in enumerate(range(0, len(starts), BLOCK), 1):
            out.append((*name, block, starts[a : a + BLOCK], depth[a : a + BLOCK]))
        return pd.DataFrame(out)

    return stepped


def _add_step_score(
    df: DataFrame, forest: DataFrame, keys: list[str], feature: str, out: str, sample: int
) -> DataFrame:
    """Two look-ups in arrays of about the root of the number of steps: the block, then the step."""
    types = ", ".join(f"{k} {dict(forest.dtypes)[k]}" for k in keys)
    nodes = forest.select(*keys, *[f"forest.{c}" for c in ("roots", "cut", "left", "value")])
    steps = spread(nodes, *keys).groupBy(*keys).applyInPandas(_steps(keys, sample), f"{types}, {STEPS}")
    steps = stage(steps, "steps")
    blocks = steps.where("_block > 0").groupBy(*keys).agg(F.array_sort(F.collect_list(F.get("_at", F.lit(0)))).alias("_blocks"))
    figures = forest.select(*keys, F.size("forest.roots").alias("_roots"), F.col("psi").alias("_psi"))
    tops = stage(blocks.join(figures, keys), "blocks")
    upto = lambda starts: F.size(F.filter(starts, lambda at: at <= F.col(feature)))
    placed = df.join(tops, keys, "left").withColumn("_block", upto("_blocks")).drop("_blocks")
    depth = F.get("_depth", F.greatest(upto("_at") - 1, F.lit(0)))
    found = placed.join(steps, [*keys, "_block"], "left")
    return found.select(*df.columns, _score(depth, F.col("_roots"), F.col("_psi")).alias(out))


def add_isolation_score(
    df: DataFrame, forest: DataFrame, keys: Sequence[str], features: Sequence[str], out: str, sample: int = SAMPLE
) -> DataFrame:
    """Adds the score of every row; rows of a group without a forest get none."""
    if len(features) == 1:
        return _add_step_score(df, forest, list(keys), features[0], out, sample)
    nodes = forest.select(*keys, F.col("forest").alias("_forest"), F.col("psi").alias("_psi"))
    joined = df.join(nodes, list(keys), "left").withColumn("_x", F.array(*features))
    score = isolation(F.col("_x"), F.col("_forest"), F.col("_psi"), sample)
    return joined.select(*df.columns, score.alias(out))
