"""Why a forest scored a row as it did: additive contributions per feature."""

import math
from functools import cache

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schemas import BREAKDOWN_ROWS, EXPLAIN_SAMPLE, SEED
from ..storage import materialize, new_path
from .ordered import running_totals

ROWS_PER_TASK = 120_000     # rows explained by one task at most; each task makes all tables of leaves
BLOCK_BYTES = 64 << 20      # of leaf paths that are sent to every task at once
CELLS = 1_000_000           # numbers in a step of batch arithmetic
INPUTS = 4_000_000          # model inputs that a task puts together at most
TABLE = 4_096               # entries of a table of leaves
ROWS_AT_ONCE = 8_192        # rows looked up in a table at a time, so that they stay in the cache
TABLED_ROWS = 2_048         # fewer rows than that are worked out without tables

LEAF_SCHEMA = ("tree int, value double, features array<int>, low array<double>, "
               "high array<double>, share array<double>")


def keep_all_positive(df, size=EXPLAIN_SAMPLE, label="is_fraud", row_id="transaction_id", seed=SEED,
                      order=None):
    """All positives, filled up to `size` with negatives in a fixed pseudo-random order.

    The order is a hash of the row id, so the choice does not depend on partitioning.
    """
    positives = df.filter(F.col(label) == 1)
    wanted = max(0, size - positives.count())
    order = F.xxhash64(F.col(row_id), F.lit(seed)) if order is None else order
    negatives = df.filter(F.col(label) == 0).orderBy(order, row_id).limit(wanted)
    return positives.unionByName(negatives)


# ------------------------------------------------------------------- the forest

def forest_nodes(forest, spark):
    """The fitted trees as a frame with one row per node."""
    path = new_path(spark, "forest")
    forest.write().save(path)
    return node_table(spark, path)


def node_table(spark, path):
    """The nodes of a saved forest."""
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.impurityStats")[0].alias("cover"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("split"),
        F.col("nodeData.split.numCategories").alias("categories"))


def leaf_paths(nodes):
    """One row per leaf: its value and, for each feature tested on the way, the interval
    low < x <= high that leads there and the share of training weight that takes those branches.

    A group is one tree, so its size is bounded by the depth.
    """
    def paths(tree):
        import pandas as pd
        node = {n.id: n for n in tree.itertuples(index=False)}
        out, todo = [], [(0, {})]
        while todo:
            number, path = todo.pop()
            here = node[number]
            if here.left < 0:
                out.append((here.tree, here.value, list(path), [p[0] for p in path.values()],
                            [p[1] for p in path.values()], [p[2] for p in path.values()]))
                continue
            if here.categories == 2:    # a 0/1 slot; `split` lists the values that go left
                cut, left_is_low = 0.5, 0.0 in list(here.split)
            else:
                cut, left_is_low = here.split[0], True
            for child, low_side in ((here.left, left_is_low), (here.right, not left_is_low)):
                low, high, share = path.get(here.feature, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, cut)) if low_side else (max(low, cut), high)
                share = share * node[child].cover / here.cover
                todo.append((child, {**path, here.feature: (low, high, share)}))
        return pd.DataFrame(out, columns=["tree", "value", "features", "low", "high", "share"])

    return nodes.groupBy("tree").applyInPandas(paths, LEAF_SCHEMA)


# --------------------------------------------------------------- contributions

def leaf_blocks(leaves, block_bytes=None):
    """The leaves with `block`: whole trees, in blocks of about `block_bytes` (BLOCK_BYTES unless given) and a tree."""
    size = F.lit(64) + 28 * F.size("features")
    trees = leaves.groupBy("tree").agg(F.sum(size.cast("bigint")).alias("_bytes"))
    upto = running_totals(trees, ["tree"], {"_upto": "_bytes"}, bounded=True)       # one row a tree
    block = F.expr(f"(_upto - _bytes) div {BLOCK_BYTES if block_bytes is None else block_bytes}")
    return leaves.join(F.broadcast(upto.select("tree", block.alias("block"))), "tree")


def contribution_vectors(rows, leaves, names, row_id="transaction_id", features="features", values="values", block_bytes=None):
    """Shapley contributions of all features to the forest score, one row per row.

    Rows are (row_id, features vector, and optionally an array of the values to show, in the order of
    `names`). Returns row_id, values, contributions (arrays) and base_value; base_value + the sum of the
    contributions = score. Without the array `values` are the model inputs. Path-dependent: a feature
    left out follows both branches in proportion to the training weight.

    For a leaf with value v, the weight of a coalition is a Beta integral, so feature i gets
    v * (o_i - z_i) * integral over t in [0, 1] of the product over the path's other features j of
    z_j (1 - t) + o_j t, with o = 1 if the row takes the branches and z the training share. The
    integrand is a polynomial, which Gauss-Legendre nodes integrate exactly.

    Rows are spread over the cluster, ROWS_PER_TASK to a task. The leaf paths stay a table: one block
    of counted bytes at a time goes to every task and adds its part to the vectors, which are
    written between two blocks. A task looks the rows up in tables of neighbouring leaves, see
    `_add_bunch`.
    """
    from pyspark.ml.functions import vector_to_array
    spark, width = rows.sparkSession, len(names)
    blocked = materialize(bunched(leaf_blocks(leaves, block_bytes)))
    trees, blocks = blocked.agg(F.count_distinct("tree"), F.collect_set("block")).first()
    inputs = vector_to_array(features)
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-rows.count() // (cores * ROWS_PER_TASK)))     # as many for each core
    wide = rows.select(
        row_id, inputs.alias("x"), (F.col(values) if values in rows.columns else inputs).alias("values"),
        F.array_repeat(F.lit(0.0), width).alias("contributions"), F.lit(0.0).alias("base_value")).repartition(tasks, row_id)
    for place, block in enumerate(sorted(blocks)):
        if place:
            wide = materialize(wide)
        part = blocked.filter(F.col("block") == block).toArrow().to_pandas()       # BLOCK_BYTES and one tree at most
        wide = wide.mapInArrow(_adder(spark.sparkContext.broadcast(_pack(part)), trees, width), wide.schema)
    return wide.select(row_id, "values", "contributions", "base_value")


def bunched(leaves):
    """The leaves with `bunch`: a number in the tree for neighbours that share a table, -1 for a path too long for one.

    A feature whose intervals in a bunch have k different ends can meet a row in k ways, the outside
    of all being one, so the product over the features is the size of the table.
    """
    def number(tree):
        bunch, ends, numbers = 0, {}, []
        for features, low, high in zip(tree["features"], tree["low"], tree["high"]):
            alone = {f: {a, b} for f, a, b in zip(features, low, high)}
            joint = ends | {f: ends.get(f, set()) | e for f, e in alone.items()}
            if math.prod(map(len, alone.values())) > TABLE:
                numbers.append(-1)
                continue
            if math.prod(map(len, joint.values())) > TABLE:
                bunch, joint = bunch + 1, alone
            ends = joint
            numbers.append(bunch)
        return tree.assign(bunch=numbers)

    return leaves.groupBy("tree").applyInPandas(number, f"{LEAF_SCHEMA}, block bigint, bunch int")


def _adder(packed, trees, width):
    """Adds the contributions of a block of leaves to the rows of a task, many at a time: a table is made once for all of them."""
    rows_at_once, fewest = max(1, min(ROWS_PER_TASK, INPUTS // max(1, width))), TABLED_ROWS

    def add(batches):
        import pyarrow as pa
        for batch in _joined(batches, rows_at_once):
            x, given = _matrix(batch["x"]), _matrix(batch["contributions"])
            total, base = np.zeros((len(x), width)), 0.0
            tabled = len(x) >= fewest
            for bunch, value, feature, low, high, share in packed.value:
                base += float((value * share.prod(axis=1)).sum())
                alone = slice(0, np.searchsorted(bunch, 0) if tabled else None)
                _add_leaves(total, x, value[alone], feature[alone], low[alone], high[alone], share[alone])
            if tabled:
                total += _tabled(x, packed.value, width).T
            total = pa.array((given + total / trees).ravel())
            ends = pa.array(np.arange(0, len(total) + 1, width, dtype=np.int32))
            new = {"contributions": pa.ListArray.from_arrays(ends, total),
                   "base_value": pa.array(batch["base_value"].to_numpy(zero_copy_only=False) + base / trees)}
            yield pa.RecordBatch.from_arrays([new.get(name, batch[name]) for name in batch.schema.names], names=batch.schema.names)

    return add


def _matrix(lists):
    """Lists of one length as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _joined(batches, rows):
    """The batches put together until they have that many rows."""
    import pyarrow as pa
    held = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _tabled(x, packed, width):
    """Contributions by feature and row of all leaves that are in a bunch."""
    cuts, bins = {}, {}
    for f in {f for group in packed for f in np.unique(group[2])}:
        ends = np.concatenate([side[feature == f] for _, _, feature, low, high, _ in packed for side in (low, high)])
        cuts[f] = np.unique(ends[np.isfinite(ends)])
        bins[f] = np.where(np.isnan(x[:, f]), len(cuts[f]) + 1, np.searchsorted(cuts[f], x[:, f]))
    leaves = []
    for bunch, value, feature, low, high, share in packed:
        first, end = np.zeros(feature.shape, dtype=int), np.zeros(feature.shape, dtype=int)     # of the bins in the interval
        for f in np.unique(feature):
            here = feature == f
            first[here] = np.where(low[here] == -np.inf, 0, np.searchsorted(cuts[f], low[here]) + 1)
            end[here] = np.where(high[here] == np.inf, len(cuts[f]), np.searchsorted(cuts[f], high[here])) + 1
        leaves.append((bunch, value, feature, first, end, share))
    total = np.zeros((width, len(x)))
    for number in range(max((group[0][-1] for group in leaves), default=-1) + 1):
        members = []
        for bunch, *columns in leaves:
            part = slice(*np.searchsorted(bunch, (number, number + 1)))
            if part.start < part.stop:
                members.append([c[part] for c in columns])
        _add_bunch(total, bins, {f: len(c) + 2 for f, c in cuts.items()}, members)
    return total


def _add_bunch(total, bins, sizes, members):
    """Add what a bunch of leaves gives each row to `total`, by one look-up a feature.

    `members` are leaves by the number of features on their path. The ends of their intervals divide
    the bins of a feature into ways to meet the bunch, way 0 being outside of all. The table has what
    the leaves give together for each combination of ways.
    """
    ends = {}
    for _, feature, first, end, _ in members:
        for f in set(feature.ravel().tolist()):
            here = feature == f
            ends.setdefault(f, set()).update(first[here].tolist(), end[here].tolist())
    if not ends:        # a bare root
        return
    ends = {f: np.array(sorted(e)) for f, e in sorted(ends.items())}
    shape = tuple(len(e) for e in ends.values())
    axis = {f: [-1 if i == place else 1 for i in range(len(shape))] for place, f in enumerate(ends)}
    begins = {f: np.concatenate([[-1], e[:-1]]) for f, e in ends.items()}     # of each way; none of way 0
    table = {f: np.zeros(shape) for f in ends}
    for value, feature, first, end, share in members:
        depth = feature.shape[1]
        ways = (np.arange(1 << depth)[:, None] >> np.arange(depth) & 1).astype(float)
        given = _leaf_contributions(value, np.broadcast_to(ways[:, None, :], (len(ways), *feature.shape)), share)
        given = np.ascontiguousarray(given.transpose(1, 2, 0))
        for i, path in enumerate(feature.tolist()):
            way = 0
            for j, f in enumerate(path):
                taken = (begins[f] >= first[i, j]) & (begins[f] < end[i, j])
                way = way + (taken.astype(int) << j).reshape(axis[f])
            for j, f in enumerate(path):
                table[f] += given[i, j].take(way)
    steps, step = {}, math.prod(shape)
    for f, e in ends.items():
        step //= len(e)
        steps[f] = np.searchsorted(e, np.arange(sizes[f]), side="right") % len(e) * step
    for start in range(0, total.shape[1], ROWS_AT_ONCE):
        rows = slice(start, start + ROWS_AT_ONCE)
        place = sum(steps[f].take(bins[f][rows], mode="clip") for f in ends)
        for f in ends:
            total[f, rows] += table[f].take(place, mode="clip")


def _add_leaves(total, x, value, feature, low, high, share):
    """Add what leaves with paths of the same number of features give each row of `x` to `total`."""
    rows, depth = len(x), feature.shape[1]
    if not depth:
        return
    patterns = 1 << depth
    tabled = patterns <= rows       # fewer ways to take or miss the branches of a path than rows
    step = max(1, CELLS // ((min(patterns, rows) + rows) * depth))
    for start in range(0, len(value), step):
        part = slice(start, start + step)
        f, z = feature[part], share[part]
        slot = np.zeros((f.size, total.shape[1]))
        slot[np.arange(f.size), f.ravel()] = 1.0
        taken = np.empty((rows, *f.shape), dtype=bool)
        for j in range(depth):
            column = x[:, f[:, j]]
            np.logical_and(column > low[part, j], column <= high[part, j], out=taken[:, :, j])
        if tabled:
            ways = (np.arange(patterns)[:, None] >> np.arange(depth) & 1).astype(float)
            given = _leaf_contributions(value[part], np.broadcast_to(ways[:, None, :], (patterns, *f.shape)), z)
            way = taken @ (1 << np.arange(depth))
            phi = given[way, np.arange(len(f))[None, :]]
        else:
            phi = _leaf_contributions(value[part], taken.astype(float), z)
        total += phi.reshape(rows, -1) @ slot


_gauss = cache(np.polynomial.legendre.leggauss)


def _leaf_contributions(value, o, z):
    """Contributions to leaves of that value, for rows that take the branches of a path where `o` is 1."""
    depth = z.shape[1]
    points, weights = _gauss(depth // 2 + 1)
    rest = np.zeros_like(o)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = z * (1 - t) + o * t
        rest += w * factor.prod(axis=2, keepdims=True) / factor
    return value[None, :, None] * (o - z) * rest


def _pack(leaves):
    """Leaf arrays grouped by the number of features on the path and in order of their bunch, for batch arithmetic.

    The bunches of all trees are numbered from 0.
    """
    groups = []
    numbers = leaves.groupby(["tree", "bunch"], sort=True).ngroup()
    leaves = leaves.assign(bunch=numbers.rank(method="dense").astype(int).where(leaves["bunch"] >= 0, 0) - 1)
    leaves = leaves.sort_values("bunch", kind="stable")
    for _, same in leaves.groupby(leaves["features"].str.len()):
        stack = [np.array(same[c].tolist()).reshape(len(same), -1)
                 for c in ("features", "low", "high", "share")]
        groups.append((same["bunch"].to_numpy(), same["value"].to_numpy(dtype=float), stack[0].astype(int), *stack[1:]))
    return groups


def long_form(vectors, names, row_id="transaction_id", only=None):
    """One row per (row, feature) of contribution vectors: row_id, feature, value, contribution, base_value.

    With `only`, a collection of names, just those features.
    """
    wanted = [(i, n) for i, n in enumerate(names) if only is None or n in only]
    lines = F.array(*[F.struct(F.lit(n).alias("feature"), F.col("values")[i].alias("value"),
                               F.col("contributions")[i].alias("contribution")) for i, n in wanted])
    return (vectors.select(row_id, "base_value", F.explode(lines).alias("p"))
            .select(row_id, "p.feature", "p.value", "p.contribution", "base_value"))


def tree_contributions(rows, leaves, names, row_id="transaction_id", **settings):
    """`contribution_vectors` in long form, one row per (row, feature)."""
    return long_form(contribution_vectors(rows, leaves, names, row_id, **settings), names, row_id)


# ----------------------------------------------------------------- summaries

def mean_abs_contribution(vectors, names):
    """(feature, mean_abs_contribution), largest first: the vectors are averaged as they are, in one aggregate."""
    means = vectors.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"m{i}") for i in range(len(names))])
    lines = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"m{i}").alias("mean_abs_contribution"))
                      for i, n in enumerate(names)])
    return means.select(F.inline(lines)).orderBy(F.desc("mean_abs_contribution"), "feature")


def display_values(numeric, categorical=None, slots=()):
    """Array of the values to show: raw numerics and 0/1 slots, not the standardised inputs."""
    return F.array(*[F.col(c).cast("double") for c in numeric],
                   *[(F.col(categorical) == v).cast("double") for v in slots])


def contribution_points(vectors, names, ranking, k=BREAKDOWN_ROWS, row_id="transaction_id"):
    """(row_id, feature, value, contribution) of the k features with the largest mean effect."""
    best = {r["feature"] for r in ranking.limit(k).collect()}
    return long_form(vectors, names, row_id, best).select(row_id, "feature", "value", "contribution")


def top_drivers(contributions, k=3):
    """The features that pushed one row's score up most."""
    return contributions.orderBy(F.desc("contribution"), "feature").limit(k)


def decision_breakdown(contributions, shown=BREAKDOWN_ROWS):
    """One row's score from base to total: the largest effects, the rest lumped into one line.

    At most `shown` lines: all features if they fit, else the `shown` - 1 largest and "other", which
    has no value of its own.
    """
    size = F.row_number().over(Window.orderBy(F.desc(F.abs("contribution")), "feature"))
    count = F.count(F.lit(1)).over(Window.rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing))
    ranked = contributions.select("feature", "value", "contribution", "base_value", size.alias("_size"),
                                  count.alias("_count"))
    fits = (F.col("_count") <= shown) | (F.col("_size") < shown)
    return (ranked.withColumn("position", F.when(fits, F.col("_size")).otherwise(F.lit(shown)))
            .groupBy("position")
            .agg(F.when(F.count(F.lit(1)) > 1, F.lit("other")).otherwise(F.min("feature")).alias("feature"),
                 F.when(F.count(F.lit(1)) == 1, F.min("value")).alias("value"),
                 F.sum("contribution").alias("contribution"), F.min("base_value").alias("base_value"),
                 F.count(F.lit(1)).alias("features"))
            .orderBy("position"))


def importance_overlap(first, second, k=5):
    """How many features two rankings (feature, ...) share among their first k."""
    return (first.limit(k).select("feature")
            .join(F.broadcast(second.limit(k).select("feature")), "feature")
            .agg(F.count(F.lit(1)).alias("shared"), F.lit(k).alias("of")))
