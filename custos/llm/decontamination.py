"""Benchmark decontamination by MinHash containment search, native to Spark SQL.

Text is lower-cased and cut into words at everything but letters and digits; a
set is the distinct ``width``-word shingles.  An item of the benchmark is inside
a document when at least ``percent`` of the item's shingles are in it.

Items are partitioned by the size of their set.  Each size partition has its
own MinHash length: the ``m`` smallest hashes of an item, with ``m`` one more
than the number of shingles that the largest set of the partition may miss.  A
document that contains the item shares at least one of these hashes, whatever
its own length, so documents need no sketch and none is missed.  Documents that
share a hash with an item are candidates; they are verified by exact
containment of the shingle strings.

Only DataFrame functions are used.  The hashes of the items are broadcast after
a check of their number; beyond it the same join runs as a shuffle.

Null or wordless texts and items match nothing; an item of fewer words than
the width is one shingle of all its words and is looked for at that width.
Repeated rows and items give repeated pairs of ids once; an empty table gives
an empty result; null ids are kept as null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from custos.llm.common import stored

WIDTH = 5
PERCENT = 80
BROADCAST_HASHES = 500_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: str, width: int, form) -> Column:
    """``form`` of the words of every shingle of a word array column (none if it has fewer words)."""
    last = F.size(w) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: form(*(F.get(F.col(w), i + k) for k in range(width)))))


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def size_bound(n: Column) -> Column:
    """Largest set size of the partition of ``n``: partitions double (8, 16, 32, ...)."""
    return F.greatest(F.lit(8), F.pow(F.lit(2), F.ceil(F.log2(n))).cast("long"))


def indexed_items(items: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """item_id, width, shingles (distinct strings) and minhash (the m smallest hashes) of every item with words."""
    base = items.select(items[id_col].alias("item_id"), words(items[text_col]).alias("w")).where(F.size("w") > 0)
    sized = base.withColumn("width", F.least(F.size("w"), F.lit(width)))
    strings = reduce(lambda other, k: F.when(F.col("width") == k, shingles("w", k, _joined)).otherwise(other), range(1, width), shingles("w", width, _joined))
    hashes = reduce(lambda other, k: F.when(F.col("width") == k, shingles("w", k, _hash)).otherwise(other), range(1, width), shingles("w", width, _hash))
    out = sized.select("item_id", "width", F.array_distinct(strings).alias("shingles"), F.array_sort(F.array_distinct(hashes)).alias("hashes"))
    missed = F.floor(size_bound(F.size("hashes")) * (100 - percent) / 100)
    return out.select("item_id", "width", "shingles", F.slice("hashes", F.lit(1), (missed + 1).cast("int")).alias("minhash"))


def contained(docs: DataFrame, items: DataFrame, *columns: str, **how) -> DataFrame:
    """Pairs (doc_id, item_id, shared, item_shingles): the item's shingles found in the document, and all of them.

    Arguments as for ``contained_texts``.
    """
    return contained_texts(docs, items, *columns, **how).groupBy("doc_id", "item_id").agg(
        F.max("shared").cast("long").alias("shared"), F.max("item_shingles").cast("long").alias("item_shingles"))


def contained_texts(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """As ``contained``, per id and hash of the text (rows may share an id)."""
    index = stored(indexed_items(items, item_id_col, item_text_col, width, percent), "items")
    sketch = index.select("item_id", F.explode("minhash").alias("hash"))
    few = sketch.count() <= BROADCAST_HASHES
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())  # at most ``width`` numbers
    if not widths:
        widths = [width]
    probe = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), words(docs[text_col]).alias("w"))
    hashes = F.array_distinct(F.concat(*(F.coalesce(shingles("w", k, _hash), F.array().cast("array<bigint>")) for k in widths)))
    seen = probe.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(hashes).alias("hash"))
    known = sketch.select("hash").distinct()
    hit = stored(seen.join(F.broadcast(known) if few else known, "hash", "left_semi").distinct(), "hits")
    pairs = hit.join(F.broadcast(sketch) if few else sketch, "hash").select("doc_id", "text_hash", "item_id").distinct()
    cut = [shingles("w", k, _joined) for k in widths]
    strings = F.array_distinct(F.concat(*(F.coalesce(c, F.array().cast("array<string>")) for c in cut)))
    hit_ids = stored(hit.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct(), "hit_ids")
    some = hit_ids.count() <= BROADCAST_HASHES
    asked = probe.withColumn("_h", F.xxhash64("text")).join(F.broadcast(hit_ids) if some else hit_ids, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left_semi")
    full = stored(asked.select("doc_id", "_h", strings.alias("all")).dropDuplicates(["doc_id", "_h"]), "asked")
    both = (pairs.join(full, pairs["doc_id"].eqNullSafe(full["doc_id"]) & (F.col("text_hash") == F.col("_h"))).drop(full["doc_id"])
            .join(F.broadcast(index) if few else index, "item_id"))
    shared = both.select("doc_id", "text_hash", "item_id", F.size(F.array_intersect("shingles", "all")).alias("shared"), F.size("shingles").alias("item_shingles"))
    return shared.where(F.col("shared") * 100 >= F.col("item_shingles") * percent)


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that contain no item; all columns stay."""
    found = stored(contained_texts(docs, items, id_col, text_col, **how).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    few = found.count() <= BROADCAST_HASHES
    return docs.join(F.broadcast(found) if few else found, docs[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(docs[text_col]) == F.col("_hash")), "left_anti")
