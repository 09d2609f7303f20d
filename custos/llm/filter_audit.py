"""Interaction of document filters over all orders in which they can be applied.

Every document gets a mask of the filters it fails.  Documents are counted per
part and mask first (natively; a part has at most 2^k rows then), so the rest
is independent of the number of documents.  Min-plus product: a mask matrix
(0 where the mask fails the filter, infinite elsewhere) times the matrix of
inverse permutations (the position of every filter in every order), by sum and
minimum, gives the rank at which a mask is removed in an order, or infinity.
The counts of all masks are then scattered by removal rank.

The duplicate filter compares whole texts through their SHA-256, table-wide.
Copies are reduced per text, part and mask where they lie, before rows of one
text meet, so a text that a third of all rows share is a few rows a task.

Null text is the empty text, a null part the empty string.  A row without an id
fails no duplicate filter and makes no other row fail it, and has no labels;
repeated rows share an id, so neither is a copy of a smaller one; repeated or
contradicting labels of an id count as 1 where any is 1; very long texts are
read whole; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"  # the last one is the duplicate filter
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
NEVER = 1 << 20


def content_mask(text: Column) -> Column:
    """Bits 0 to 3: under 50 words, under 65 % distinct words, over 5 % of A-Z, any of #$%&*|."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failures = (n < 50, 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n.cast("long"), 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
                text.rlike(r"[#$%&*|]"))
    mask = F.lit(0)
    for bit, fails in enumerate(failures):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    return mask


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of every part and mask, and those labelled so."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("h"), content_mask(text).alias("mask"))
    rows = rows.withColumns({"key": F.coalesce("id", F.xxhash64("h")), "has_id": F.col("id").isNotNull()})  # rows without an id are spread
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key"), F.lit(True).alias("has_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(marks, ["key", "has_id"], "left").withColumns({"good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))})
    same = rows.groupBy("key", "has_id", "id", "h", "part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    # per text: rows of the least id, and rows without an id, pass the duplicate filter
    text_rows = same.groupBy("h", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"))
    one = text_rows.withColumn("first", F.min("least").over(Window.partitionBy("h")))
    pass_ = F.col("no_id") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    both = F.array(F.struct(F.col("mask").alias("mask"), pass_.alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - pass_).alias("n")))
    split = one.select("part", "good", "toxic", F.explode(both).alias("b")).select("part", "good", "toxic", "b.*").where("n > 0")
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def orders(k: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of k filters (order x step -> filter) and their inverses (order x filter -> step)."""
    perm = np.array(list(itertools.permutations(range(k))), np.int64)
    return perm, np.argsort(perm, axis=1)


def removal_ranks(masks: np.ndarray, position: np.ndarray) -> np.ndarray:
    """(mask, order) -> step at which the mask is removed, by min-plus product; NEVER or more if it is kept."""
    k = position.shape[1]
    fails = np.where((masks[:, None] >> np.arange(k)) & 1, 0, NEVER)
    return (fails[:, :, None] + position.T[None]).min(axis=1)


def interactions(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, k: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Counts (order x step) of one part from its documents per mask."""
    perm, position = orders(k)
    rank = np.minimum(removal_ranks(masks, position), k)
    place = (np.arange(len(perm)) * (k + 1) + rank).ravel()

    def scattered(weight):  # exact: weights are added as integers
        out = np.zeros(len(perm) * (k + 1), np.int64)
        np.add.at(out, place, np.repeat(weight, len(perm)))
        return out.reshape(len(perm), k + 1)[:, :k]

    fails = ((masks[:, None] >> np.arange(k)) & 1).astype(np.int64)
    removed = scattered(n)
    failing = (fails * n[:, None]).sum(axis=0)
    alone = np.array([n[masks == 1 << f].sum() for f in range(k)], np.int64)
    share = np.zeros(k, np.int64)
    np.add.at(share, perm.ravel(), removed.ravel())
    return perm, {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": failing[perm] - removed, "unique_fails": alone[perm],
                  "good_lost": scattered(good), "toxic_lost": scattered(toxic), "shapley": share[perm]}


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, order of the filters and step: the counts named in ``COUNTS``.

    ``counts`` holds (part, mask, n, good, toxic), one row a part and mask; bit
    i of a mask is the filter ``filters[i]``.
    """
    k = len(filters)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct(*(F.col(c).cast("long").alias(c) for c in ("mask", "n", "good", "toxic")))).alias("rows"))

    def run(batches):
        for b in batches:
            for part, rows in zip(b.column(0), b.column(1)):
                perm, found = interactions(*(rows.values.field(i).to_numpy() for i in range(4)), k)
                names = np.repeat(["".join(filters[f] for f in p) for p in perm], k)
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * perm.size, pa.string()), pa.array(names, pa.string()), pa.array(np.tile(np.arange(1, k + 1), len(perm)), pa.int32()),
                                                  *(pa.array(found[c].ravel(), pa.int64()) for c in COUNTS)], ["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
