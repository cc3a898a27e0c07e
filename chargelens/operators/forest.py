"""A forest as columns: nested comparisons in generated code if it is small, else a walk through its node table."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

EXPRESSION_NODES = 1_000    # of a forest that is compiled; the code of more does not fit a generated method


def compiled(nodes, inputs, most=EXPRESSION_NODES):
    """The score of a forest as a column, or None if the forest has more than `most` nodes.

    `nodes` is a node table as of `explain.forest_nodes`, `inputs` the SQL text of each feature. A tree
    becomes nested comparisons, so a row is compared with the splits on its path alone; the score is
    the mean over the trees, added up in their order.
    """
    rows = nodes.select("tree", "id", "value", "left", "right", "feature", "split", "categories").limit(most + 1).collect()
    if len(rows) > most:
        return None
    trees = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["id"]] = r
    total = " + ".join(_branch(trees[t], 0, inputs) for t in sorted(trees))
    return F.expr(f"({total}) / {len(trees)}D")


def _branch(tree, number, inputs):
    node = tree[number]
    if node["left"] < 0:
        return f"{node['value']!r}D"
    value = f"({inputs[node['feature']]})"
    if node["categories"] > 0:      # the split lists the values that go left
        left = f"{value} IN ({', '.join(f'{v!r}D' for v in node['split'])})"
    else:
        left = f"{value} <= {node['split'][0]!r}D"
    return f"IF({left}, {_branch(tree, node['left'], inputs)}, {_branch(tree, node['right'], inputs)})"


def pipeline_inputs(inputs, scaling, categorical=None):
    """SQL text of each feature of fitted model inputs, in the order of the vector.

    `inputs` is the fitted PipelineModel and `scaling` its numeric columns.
    """
    statement = inputs.stages[0].getStatement()
    texts = []
    for c in scaling:
        end = statement.index(f" AS `{c}_z`")
        texts.append(statement[statement.rindex("(`", 0, end):end])
    if categorical:
        texts += ["double(`{}` = '{}')".format(categorical, v.replace("\\", "\\\\").replace("'", "\\'"))
                  for v in inputs.stages[1].labels]
    return texts


# ------------------------------------------------------------- forests of any size

def walked(nodes, features="features"):
    """The score of a forest of any size as a column, or None if a split lists values of more than two.

    `nodes` is a node table as of `explain.forest_nodes`, `features` the vector of model inputs. The rows of
    a batch go down a tree together, one level at a time; the score is the mean over the trees, added up
    in their order, bit for bit that of the solver. The tables (24 bytes a node) go to the tasks once.
    """
    found = nodes.select("tree", "id", "value", "left", "right", "feature", "split", "categories").toArrow().sort_by("tree")
    if (found["categories"].to_numpy() > 2).any():
        return None
    of_tree = found["tree"].to_numpy()
    starts = np.flatnonzero(np.diff(of_tree, prepend=-1))
    trees = [_table(found.slice(start, end - start).to_pandas()) for start, end in zip(starts, [*starts[1:], len(of_tree)])]
    sent = nodes.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def walk(inputs):
        import pandas as pd
        return pd.Series(_walk(inputs.to_numpy(), sent.value) if len(inputs) else [], dtype=float)

    return walk.asNondeterministic()(vector_to_array(features))     # so that a filter on the score does not walk again


def _table(tree):
    """(feature, cut, first child, value, levels) of a tree, its nodes numbered by level and the children of a node in a row.

    The child up to the cut comes first. A leaf is its own child; its feature is -1.
    """
    node = {n.id: n for n in tree.itertuples(index=False)}
    order, first, cuts, level, levels = [0], [], [], [0], 0
    while level:
        below = []
        for number in level:
            here = node[number]
            if here.left < 0:
                cuts.append(np.inf)
                first.append(len(first))
                continue
            pair = [here.left, here.right]
            if here.categories == 2:    # a 0/1 slot; `split` lists the values that go left
                cuts.append(0.5)
                pair = pair if 0.0 in list(here.split) else pair[::-1]
            else:
                cuts.append(here.split[0])
            first.append(len(order))
            order += pair
            below += pair
        levels += bool(below)
        level = below
    feature = [node[n].feature if node[n].left >= 0 else -1 for n in order]
    return (np.array(feature, dtype=np.int32), np.array(cuts), np.array(first, dtype=np.int32),
            np.array([node[n].value for n in order], dtype=float), levels)


def _walk(inputs, trees):
    rows = len(inputs)
    x = np.zeros((len(inputs[0]) + 1, rows))     # the last feature is that of leaves, 0 and so never above their cut
    x[:-1] = np.stack(inputs).T
    row, total = np.arange(rows), np.zeros(rows)
    for feature, cuts, first, value, levels in trees:
        start = np.where(feature < 0, len(x) - 1, feature).astype(np.int64) * rows
        number = np.zeros(rows, dtype=np.int32)
        for _ in range(levels):
            low = x.take(start.take(number) + row) <= cuts.take(number)     # a NaN is not, as in the solver
            number = first.take(number) + ~low
        total += value.take(number)
    return total / len(trees)
