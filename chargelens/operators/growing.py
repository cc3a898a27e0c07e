"""A forest grown from counts of all rows: a row is a byte a feature, a level of all trees is one job.

Nothing is kept by row and tree. The draws of a tree are made again from the number of a block of rows
wherever they are needed, and a row walks from the root to its node, so disk and memory do not grow with the trees.
"""

import math
from functools import cache

import numpy as np
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..storage import materialize

BLOCK_ROWS = 65_536         # rows of a block at most; a task counts one at a time, which a cache can hold
INPUTS = 2_000_000          # model inputs of a block at most
SUMMARY = 1_024             # values by which a block says how a feature lies in it
TASK_BYTES = 32 << 20       # of blocks that a task holds
MOST_KINDS = 8              # pairs of label and weight that rows are told apart by
LEAST_IMPURITY = 2.0 ** -52

SUMMARY_SCHEMA = "feature int, vals binary, counts binary"
BLOCK_SCHEMA = "block bigint, size int, cells binary"
COUNT_SCHEMA = "tree int, counts binary, wide boolean"
BEST_SCHEMA = "tree int, slot int, feature int, cut int, gain double, whole array<bigint>, low array<bigint>"
NODE_SCHEMA = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
               "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, "
               "numCategories int>>")


def kinds_of(train, label, weight):
    """Sorted [(label, weight, rows)], or None if there are more than MOST_KINDS such pairs or one is null."""
    found = train.groupBy(F.col(label).alias("y"), F.col(weight).alias("w")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_KINDS + 1).collect()
    if len(found) > MOST_KINDS or any(r["y"] is None or r["w"] is None for r in found):
        return None
    return sorted((float(r["y"]), float(r["w"]), r["n"]) for r in found)


def slots_of(train, features="features"):
    """{feature: values} of the features that are categories, as the vector says of itself."""
    attributes = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: 2 for a in attributes.get("binary", [])} | {
        a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in attributes.get("nominal", [])}


def grow(train, label, weight, kinds, width, slots, trees, depth, min_leaf, bins, seed, features="features", bagged=True):
    """Node rows (NODE_SCHEMA) of a forest on all rows of `train`, as the solver saves them.

    As in the solver: a row counts a Poisson number of times in a tree (once if not `bagged`), a node looks at the root of the number of
    features, anew for each, and takes the split that lowers the variance of the label most, by weight; a split
    leaves `min_leaf` counted rows on both sides; a 0/1 slot is split in two. Unlike there the cuts of a feature come from all
    rows, and counts are whole numbers, so the forest depends on the rows of each partition and their order alone.
    """
    spark = train.sparkSession
    same = [(F.col(label) == F.lit(y)) & (F.col(weight) == F.lit(w)) for y, w, _ in kinds]
    kind = F.coalesce(*[F.when(s, F.lit(i)) for i, s in enumerate(same)])
    rows = train.select(vector_to_array(features).alias("x"), kind.cast("int").alias("kind"))
    cuts = _cuts_of(rows, width, slots, bins, [w for _, w, _ in kinds])
    sizes = np.array([len(c) + 1 for c in cuts])
    cell = np.dtype(np.uint8 if sizes.max() * len(kinds) <= 256 else np.uint16)
    blocks = materialize(rows.mapInArrow(_blocker(cuts, len(kinds), cell), BLOCK_SCHEMA))
    total = sum(n for *_, n in kinds) * width * cell.itemsize
    blocks = blocks.coalesce(max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))
    forest = [_Tree(len(kinds)) for _ in range(trees)]
    share = math.ceil(math.sqrt(width))
    for level in range(depth):
        growing = [t for t, tree in enumerate(forest) if len(tree.open)]
        if not growing:
            break
        plans = {t: _Plan(forest[t], sizes, len(kinds), cell, share, (seed, t, level)) for t in growing}
        sent = spark.sparkContext.broadcast((plans, sizes, [k[:2] for k in kinds], cell, width, level, bagged, seed, min_leaf))
        best = (blocks.mapInArrow(_counter(sent), COUNT_SCHEMA).groupBy("tree")
                .applyInPandas(_chooser(sent), BEST_SCHEMA).toArrow().sort_by([("tree", "ascending"), ("slot", "ascending")]))
        ends = np.searchsorted(best["tree"].to_numpy(), np.arange(trees + 1))
        for t in growing:
            forest[t].split(best.slice(ends[t], ends[t + 1] - ends[t]).combine_chunks(), kinds, min_leaf, level + 1 == depth)
        sent.destroy()
    return _node_rows(forest, kinds, cuts, slots)


# ------------------------------------------------------------------ rows to blocks

def _batches(batches, width):
    """(matrix of features by row, kinds), as many rows at a time as a block has; only the last of a task has fewer."""
    most = max(1, min(BLOCK_ROWS, INPUTS // width))
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - rows)
            batch = batch.slice(part.num_rows)
            x = part.column(0).flatten().to_numpy(zero_copy_only=False)
            held.append((x.reshape(part.num_rows, width), part.column(1).to_numpy(zero_copy_only=False)))
            rows += part.num_rows
            if rows == most:
                yield tuple(map(np.concatenate, zip(*held)))
                held, rows = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _cuts_of(rows, width, slots, bins, weights):
    """The cuts between bins of each feature: every place between two values, or `bins` - 1 quantiles of all rows by weight.

    A block gives its values with their numbers by kind, put together to SUMMARY groups of equal weight if there are more.
    Numbers are added up whole, so the cuts do not depend on the order in which blocks arrive.
    """
    weights = np.array(weights)

    def summaries(batches):
        import pyarrow as pa
        for x, kind in _batches(batches, width):
            out = []
            for f in range(width):
                known = ~np.isnan(x[:, f])
                if f in slots or not known.any():
                    continue
                values, counts = _by_value(x[known, f], kind[known], np.ones(known.sum()), len(weights))
                if len(values) > SUMMARY:
                    upto = np.cumsum(counts @ weights)
                    group = np.ceil(upto * (SUMMARY / upto[-1])).astype(int)
                    last = np.flatnonzero(np.diff(group, append=group[-1] + 1))
                    values, counts = values[last], np.diff(counts.cumsum(axis=0)[last], axis=0, prepend=0)
                out.append((f, values.astype(float).tobytes(), counts.tobytes()))
            if out:
                number, values, counts = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(values, pa.binary()), pa.array(counts, pa.binary())],
                                                 names=["feature", "vals", "counts"])

    def merged(feature):
        import pandas as pd
        values = np.frombuffer(b"".join(feature["vals"]), dtype=float)
        counts = np.frombuffer(b"".join(feature["counts"]), dtype=np.int64)
        kinds = np.tile(np.arange(len(weights)), len(values))
        values, counts = _by_value(np.repeat(values, len(weights)), kinds, counts, len(weights))
        return pd.DataFrame({"feature": feature["feature"].iloc[:1], "cuts": [between(values, counts @ weights, bins).tolist()]})

    found = rows.mapInArrow(summaries, SUMMARY_SCHEMA).groupBy("feature").applyInPandas(merged, "feature int, cuts array<double>")
    cuts = {r["feature"]: r["cuts"] for r in found.collect()}
    return [np.array([0.5] if f in slots else cuts.get(f, []), dtype=float) for f in range(width)]


def _by_value(x, kind, often, kinds):
    """Sorted values, and their numbers by kind."""
    values, place = np.unique(x, return_inverse=True)
    return values, np.bincount(place * kinds + kind, often, minlength=len(values) * kinds).reshape(-1, kinds).astype(np.int64)


def between(values, weights, bins):
    """Cuts that divide sorted values into `bins` bins of about the same weight, or one a value if there are no more."""
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    stride = weights.sum() / bins
    cuts, upto, target = [], float(weights[0]), stride
    for i, w in enumerate(weights[1:].tolist(), 1):
        before, upto = upto, upto + w
        if abs(before - target) < abs(upto - target):
            cuts.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(cuts[:bins - 1])


def _blocker(cuts, kinds, cell):
    """Rows to blocks: a cell is the bin of a feature times the number of kinds, plus the kind of the row."""
    def blocks(batches):
        import pyarrow as pa
        part = TaskContext.get().partitionId()
        for number, (x, kind) in enumerate(_batches(batches, len(cuts))):
            cells = np.stack([(np.searchsorted(c, x[:, f]) * kinds + kind).astype(cell) for f, c in enumerate(cuts)])
            yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), pa.array([len(x)], pa.int32()),
                                              pa.array([cells.tobytes()], pa.binary())], names=["block", "size", "cells"])
    return blocks


# ------------------------------------------------------------------------- levels

class _Tree:
    """Nodes in the order of their levels; the two children of a node in a row. A leaf is its own first child."""

    def __init__(self, kinds):
        self.feature, self.cut, self.first = np.zeros(1, dtype=int), np.zeros(1, dtype=int), np.zeros(1, dtype=int)
        self.gain, self.counts = np.full(1, -1.0), np.zeros((1, kinds), dtype=np.int64)
        self.open = np.zeros(1, dtype=int)      # nodes that may be split, by slot

    def split(self, found, kinds, min_leaf, last):
        """Split open nodes as found, a row a slot, and open those of their children that can be split."""
        here, width = self.open[found["slot"].to_numpy()], len(kinds)
        whole, low = (found[c].combine_chunks().flatten().to_numpy().reshape(len(here), width) for c in ("whole", "low"))
        self.counts[here] = whole
        better = found["gain"].to_numpy() > 0
        here, low, high = here[better], low[better], (whole - low)[better]
        first = len(self.first) + 2 * np.arange(len(here))
        self.feature[here], self.cut[here] = found["feature"].to_numpy()[better], found["cut"].to_numpy()[better]
        self.first[here], self.gain[here] = first, found["gain"].to_numpy()[better]
        new = np.stack([low, high], axis=1).reshape(-1, width)
        number = len(self.first) + np.arange(len(new))
        self.feature, self.cut = (np.concatenate([a, np.zeros(len(new), dtype=int)]) for a in (self.feature, self.cut))
        self.first, self.gain = np.concatenate([self.first, number]), np.concatenate([self.gain, np.full(len(new), -1.0)])
        self.counts = np.concatenate([self.counts, new])
        can = (_stats(new, kinds)[3] >= LEAST_IMPURITY) & (new.sum(axis=1) >= 2 * min_leaf)
        self.open = number[can] if not last else number[:0]


class _Plan:
    """What tasks need of a tree on a level: its nodes so far, and which features its open nodes look at, where in the counts."""

    def __init__(self, tree, sizes, kinds, cell, share, seed):
        leaf = tree.first == np.arange(len(tree.first))
        self.first, self.feature = tree.first, tree.feature
        most = np.iinfo(cell).max
        self.limit = np.where(leaf, most, (tree.cut + 1) * kinds - 1).astype(cell)     # the greatest cell that goes to the first child
        self.slot = np.full(len(tree.first), -1)
        self.slot[tree.open] = np.arange(len(tree.open))
        draw = np.random.Generator(np.random.SFC64([*seed, 1])).random((len(tree.open), len(sizes)))
        self.looked = np.sort(np.argsort(draw, axis=1, kind="stable")[:, :share], axis=1).T      # by place and slot
        cells = sizes[self.looked] * kinds
        self.start = np.cumsum(cells, axis=1) - cells       # of a slot in the counts of a place
        self.cells = cells.sum(axis=1)


@cache
def _poisson():
    """The Poisson number of mean 1 for each of 65,536 equally likely draws."""
    upto = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    return np.searchsorted(upto, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def _drawn(seed, tree, block, rows):
    """How often each row of a block counts in a tree: made of these numbers alone."""
    bits = np.random.SFC64([seed, tree, block >> 32, block & 0xFFFFFFFF]).random_raw(-(-rows // 4))
    return _poisson().take(np.asarray(bits).view(np.uint16)[:rows])


def _counter(sent):
    """Blocks to counts of rows by open node, place, bin and kind, one row a tree and task."""
    def counts(batches):
        import pyarrow as pa
        plans, _, _, cell, width, level, bagged, seed, _ = sent.value
        blocks = [(int(block.as_py()), size.as_py(), np.frombuffer(cells.as_buffer(), dtype=cell))
                  for batch in batches for block, size, cells in zip(*batch.columns)]
        for t, plan in plans.items() if blocks else ():
            found = [np.zeros(n) for n in plan.cells]
            for number, rows, cells in blocks:
                often = _drawn(seed, t, number, rows) if bagged else np.ones(rows, dtype=np.uint8)
                _count(found, plan, cells, rows, often, level)
            found = np.concatenate(found)
            wide = bool(found.max(initial=0) >= 1 << 16)
            yield pa.RecordBatch.from_arrays([
                pa.array([t], pa.int32()), pa.array([found.astype(np.int64 if wide else np.uint16).tobytes()], pa.binary()),
                pa.array([wide])], names=["tree", "counts", "wide"])
    return counts


def _count(found, plan, cells, rows, often, level):
    """Add the rows of a block to the counts of a tree."""
    row = np.flatnonzero(often)
    node, start = np.zeros(len(row), dtype=int), plan.feature * rows
    for _ in range(level):
        node = plan.first.take(node) + (cells.take(start.take(node) + row) > plan.limit.take(node))
    slot = plan.slot.take(node)
    if level:
        left = np.flatnonzero(slot >= 0)
        row, slot = row.take(left), slot.take(left)
    often = often.take(row).astype(float)
    for place, (looked, begin) in enumerate(zip(plan.looked, plan.start)):
        at = cells.take((looked * rows).take(slot) + row) + begin.take(slot)
        found[place] += np.bincount(at, often, minlength=len(found[place]))


def _chooser(sent):
    """Counts of a tree from all tasks to the best split of each open node."""
    def choose(counts):
        import pandas as pd
        plans, sizes, kinds, _, _, _, _, _, min_leaf = sent.value
        tree = int(counts["tree"].iloc[0])
        plan = plans[tree]
        total = sum(np.frombuffer(c, dtype=np.int64 if w else np.uint16).astype(np.int64) for c, w in zip(counts["counts"], counts["wide"]))
        return best_splits(tree, plan, total, sizes, kinds, min_leaf)
    return choose


def best_splits(tree, plan, total, sizes, kinds, min_leaf):
    """The best split of each open node by the counts: BEST_SCHEMA, gain 0 where none lowers the variance."""
    import pandas as pd
    slots, offset = plan.looked.shape[1], np.cumsum(plan.cells) - plan.cells
    gain, feature, cut = np.zeros(slots), np.full(slots, -1), np.zeros(slots, dtype=int)
    whole, low = np.zeros((slots, len(kinds)), dtype=np.int64), np.zeros((slots, len(kinds)), dtype=np.int64)
    for f in np.unique(plan.looked):
        place, slot = np.nonzero(plan.looked == f)
        cells = (offset[place] + plan.start[place, slot])[:, None] + np.arange(sizes[f] * len(kinds))
        here = total[cells].reshape(len(slot), sizes[f], len(kinds))
        whole[slot] = here.sum(axis=1)
        if sizes[f] < 2:
            continue
        left = here.cumsum(axis=1)[:, :-1]
        right = whole[slot][:, None] - left
        w, _, _, impure = _stats(whole[slot], kinds)
        with np.errstate(divide="ignore", invalid="ignore"):
            lw, _, _, li = _stats(left, kinds)
            rw, _, _, ri = _stats(right, kinds)
            less = impure[:, None] - lw / w[:, None] * li - rw / w[:, None] * ri
        less = np.where((left.sum(axis=2) >= min_leaf) & (right.sum(axis=2) >= min_leaf), less, -np.inf)
        at = less.argmax(axis=1)
        most = less[np.arange(len(slot)), at]
        better = most > gain[slot]      # of equal ones the first feature
        gain[slot[better]], feature[slot[better]], cut[slot[better]] = most[better], f, at[better]
        low[slot[better]] = left[np.flatnonzero(better), at[better]]
    return pd.DataFrame({"tree": tree, "slot": np.arange(slots), "feature": feature, "cut": cut, "gain": gain,
                         "whole": list(whole), "low": list(low)})


def _stats(counts, kinds):
    """Weight, weighted sum and sum of squares of the label, and its variance, by counts of kinds in the last axis."""
    w = sum(counts[..., i] * k[1] for i, k in enumerate(kinds))
    s = sum(counts[..., i] * (k[1] * k[0]) for i, k in enumerate(kinds))
    q = sum(counts[..., i] * (k[1] * k[0] * k[0]) for i, k in enumerate(kinds))
    return w, s, q, np.divide(q - np.divide(s * s, w, out=np.zeros_like(w), where=w > 0), w, out=np.zeros_like(w), where=w > 0)


# ---------------------------------------------------------------------- node table

def _node_rows(forest, kinds, cuts, slots):
    """Arrow table of NODE_SCHEMA; a node whose children are leaves of one value is a leaf, as in the solver."""
    import pyarrow as pa
    node = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                      ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                      ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                           ("numCategories", pa.int32())]))])
    tables = []
    for t, tree in enumerate(forest):
        w, s, q, impure = _stats(tree.counts, kinds)
        value, first = s / w, tree.first
        leaf = first == np.arange(len(first))
        for i in np.flatnonzero(~leaf)[::-1]:       # children come after their parents
            a = first[i]
            leaf[i] = leaf[a] and leaf[a + 1] and value[a] == value[a + 1]
        kept = np.zeros(len(first), dtype=bool)
        kept[0] = True
        for i in np.flatnonzero(~leaf):
            if kept[i]:
                kept[first[i]:first[i] + 2] = True
        keep = np.flatnonzero(kept)
        end, f = leaf[keep], tree.feature[keep]
        low = np.where(end, -1, (np.cumsum(kept) - 1)[first[keep]])
        slot = np.isin(f, list(slots))
        at = [0.0 if c else cuts[i][j] for c, i, j in zip(slot[~end], f[~end], tree.cut[keep][~end])]     # a slot has 0 to the left
        split = pa.StructArray.from_arrays([
            pa.array(np.where(end, -1, f), pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(~end)), pa.int32()), pa.array(at, pa.float64())),
            pa.array(np.where(end | ~slot, -1, 2), pa.int32())], fields=list(node.field("split").type))
        stats = pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(keep) + 1, 3), pa.int32()), pa.array(np.stack([w, s, q], axis=1)[keep].ravel()))
        rows = pa.StructArray.from_arrays([
            pa.array(np.arange(len(keep)), pa.int32()), pa.array(value[keep]), pa.array(impure[keep]), stats, pa.array(tree.counts[keep].sum(axis=1)),
            pa.array(np.where(end, -1.0, tree.gain[keep])), pa.array(low, pa.int32()), pa.array(np.where(end, -1, low + 1), pa.int32()),
            split], fields=list(node))
        tables.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), t), pa.int32()), rows], names=["treeID", "nodeData"]))
    return pa.Table.from_batches(tables)
