"""SHAP values of boosted trees (M9) and their mean absolute value.

Path-dependent TreeSHAP (Lundberg et al. 2018), leaf by leaf.  For a leaf with value v whose path
splits on the distinct slots U (d = |U|):

* z_j  = product of cover(child) / cover(parent) over the path's splits on slot j
* o_j  = 1 when the row meets every condition of the path on slot j, else 0

and the leaf adds to slot i in U

    v * (o_i - z_i) * sum_{S subset of U - i} |S|! (d - |S| - 1)! / d!
                      * prod_{j in S} o_j * prod_{j in U - S - i} z_j

That number depends on the row only through its pattern of d bits (o_j).  So it is worked out once
per leaf for all 2^d patterns, on the driver.  A row's bins give its pattern by d table look-ups
and additions, and the pattern gives the contributions; a batch of rows costs d look-ups per leaf.
d is at most the depth (``MAX_DEPTH`` bounds the tables).

Values are in log-odds units: per row, sum(phi) + expected_value == margin.  Rows are never moved
to the driver.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tablewise.operators import boosting
from tablewise.operators.boosting import WIDTH, BoostedTrees, Tree, slot_columns
from tablewise.operators.profile import qcol

# Type and metric name of the SHAP rows of the metric table.
SHAP_TYPE = "SHAP"
SHAP_METRIC = "shap_mean_abs"

MAX_DEPTH = 12               # a leaf's table has at most 2^12 patterns


@dataclass
class Leaf:
    """``bits[k][bin]`` is 2^k if a bin of slot ``slots[k]`` meets the path, else 0;
    ``table[pattern, k]`` is what the leaf adds to that slot."""
    slots: list
    bits: np.ndarray
    table: np.ndarray
    expected: float


def pattern_table(value: float, z: np.ndarray) -> np.ndarray:
    """Contributions to each of d slots for all 2^d patterns (2^d x d)."""
    d = len(z)
    o = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
    weight = np.array([factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)])
    out = np.empty((1 << d, d))
    for i in range(d):
        # coefficients by |S| of the product over j <> i of (z_j + o_j t)
        c = np.zeros((1 << d, d))
        c[:, 0] = 1.0
        for j in range(d):
            if j != i:
                more = c * z[j]
                more[:, 1:] += o[:, j:j + 1] * c[:, :-1]
                c = more
        out[:, i] = value * (o[:, i] - z[i]) * (c @ weight)
    return out


def leaves_of(tree: Tree) -> list[Leaf]:
    """Every leaf with its pattern table."""
    out = []

    def walk(node: int, path: dict):
        if tree.slot[node] < 0:
            slots = list(path)
            z = np.array([path[s][0] for s in slots])
            bits = np.array([path[s][1].astype(np.uint16) << k for k, s in enumerate(slots)],
                            np.uint16).reshape(len(slots), WIDTH)
            value = float(tree.value[node])
            out.append(Leaf(slots, bits, pattern_table(value, z), value * float(np.prod(z))))
            return
        slot = int(tree.slot[node])
        share, meets = path.get(slot, (1.0, np.ones(WIDTH, bool)))
        for child, side in ((tree.left[node], tree.goes_left[node]),
                            (tree.right[node], ~tree.goes_left[node])):
            part = float(tree.cover[child] / tree.cover[node]) if tree.cover[node] > 0 else 0.0
            walk(int(child), {**path, slot: (share * part, meets & side)})

    walk(0, {})
    return out


def tree_shap(bins: np.ndarray, leaves: list[Leaf]) -> tuple[np.ndarray, float]:
    """``phi`` (slots x rows) and the expected value, for rows given by their bins."""
    phi = np.zeros(bins.shape)
    expected = 0.0
    for leaf in leaves:
        expected += leaf.expected
        if not leaf.slots:
            continue
        pattern = leaf.bits[0][bins[leaf.slots[0]]]
        for bit, slot in zip(leaf.bits[1:], leaf.slots[1:]):
            pattern = pattern + bit[bins[slot]]
        for k, slot in enumerate(leaf.slots):
            phi[slot] += leaf.table[pattern, k]
    return phi, expected


def shap_values(df: DataFrame, model: BoostedTrees, slot_sources, keep=()) -> DataFrame:
    """M9: per row of ``df`` (slot columns as doubles) the ``keep`` columns, ``shap``: the value of
    every *source* column (slots of one column are summed), ``expected_value``, ``log_odds``."""
    for module in (sys.modules[__name__], boosting):
        cloudpickle.register_pickle_by_value(module)   # workers need not have this package
    leaves = [leaf for t in model.trees for leaf in leaves_of(t)]
    sources = list(dict.fromkeys(slot_sources))
    index = np.array([sources.index(s) for s in slot_sources])
    keep, slots = list(keep), list(model.slots)
    sent = df.sparkSession.sparkContext.broadcast(leaves)    # trees x 2^depth small tables

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            phi, expected = tree_shap(model.bins_of(slot_columns(b, slots)), sent.value)
            per = np.zeros((len(sources), b.num_rows))
            np.add.at(per, index, phi)
            base = expected + model.base
            values = pa.FixedSizeListArray.from_arrays(pa.array(per.T.ravel()), len(sources))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in keep), values.cast(pa.list_(pa.float64())),
                 pa.array(np.full(b.num_rows, base)), pa.array(per.sum(axis=0) + base)],
                [*keep, "shap", "expected_value", "log_odds"])

    schema = StructType([df.schema[k] for k in keep] + [
        StructField("shap", ArrayType(DoubleType()), False),
        StructField("expected_value", DoubleType(), False),
        StructField("log_odds", DoubleType(), False)])
    return df.select(*[qcol(c) for c in dict.fromkeys([*keep, *slots])]).mapInArrow(run, schema)


def mean_abs_shap(shap_df: DataFrame, sources, table: str, ts=None,
                  path: str | None = None) -> DataFrame:
    """M10 + M11: ``mean(|phi|)`` per source column as metric rows (type SHAP)."""
    names = F.array(*[F.lit(s) for s in sources])
    agg = (shap_df.select(F.posexplode("shap").alias("pos", "phi"))
           .groupBy("pos").agg(F.avg(F.abs("phi")).alias("value")))
    front = []
    if ts is not None or path is not None:
        front = [(F.lit(ts).cast("timestamp") if ts is not None
                  else F.current_timestamp()).alias("timestamp"),
                 F.lit(path).cast("string").alias("path")]
    return agg.select(*front, F.lit(table).alias("table"), F.lit(SHAP_TYPE).alias("type"),
                      F.element_at(names, F.col("pos") + 1).alias("column"),
                      F.lit(SHAP_METRIC).alias("metric"), F.col("value").cast("double"))


__all__ = ["Leaf", "pattern_table", "leaves_of", "tree_shap", "shap_values", "mean_abs_shap",
           "SHAP_TYPE", "SHAP_METRIC", "MAX_DEPTH"]
