"""What the trained operators share: the split of rows, a bounded sample, and a step of Adam."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.sources.scratch import materialise

FOLDS, HELD_OUT_FOLD = 4, 2
SURPLUS = 7  # standard deviations


def held_out(id_column: Column) -> Column:
    """Whether a row is kept for testing: crc32 of its id as text, modulo 4, is 2. A null id is not."""
    fold = F.crc32(id_column.cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def sampled_ids(labelled: DataFrame, per_label: int) -> DataFrame:
    """id, label: of each label at most ``per_label`` ids that may be learned from, those with the smallest hashes.

    Every id comes once: one that has several labels is left out. A label's share of hashes that holds ``SURPLUS`` standard deviations
    more than ``per_label`` ids is found from its count, so that only about as many rows are sorted as are picked,
    however frequent a label is.
    """
    known = (
        labelled.where(
            F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))
        )
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("id", "label", F.xxhash64("id").alias("hash"))
    )
    wanted = per_label + SURPLUS * per_label**0.5 + SURPLUS**2
    shares = known.groupBy("label").agg((F.lit(wanted) / F.count(F.lit(1))).alias("share"))
    # hashes lie evenly from -2**63; 53 bits of them fit a double
    low = F.shiftright("hash", 11) < (F.col("share") - 0.5) * F.lit(2.0**53)
    few = known.join(F.broadcast(shares), "label").where((F.col("share") >= 1) | low)
    few = materialise(few.select("id", "label", "hash"), "sample")
    smallest = F.sort_array(F.collect_list("hash"))
    cuts = few.groupBy("label").agg(
        F.element_at(smallest, F.least(F.size(smallest), F.lit(per_label))).alias("cut")
    )
    return few.join(F.broadcast(cuts), "label").where("hash <= cut").select("id", "label")


def one_of_each_id(cut: DataFrame, value: str) -> DataFrame:
    """id, label and one ``value`` (the least) of each id, however many rows bear it."""
    return cut.groupBy("id", "label").agg(F.min(value).alias(value))


class Adam:
    """Gradient steps for a dictionary of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            mean = self.mean[k] / (1 - 0.9**self.step)
            square = self.square[k] / (1 - 0.999**self.step)
            self.weights[k] -= self.rate * mean / (np.sqrt(square) + 1e-8)
