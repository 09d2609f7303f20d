"""Ranked lexical search by MaxScore with bounds of term pairs.

Items (the queries) are taken in blocks of ``BLOCK_TERMS`` terms.  For a block,
every document is cut into terms once; its length and the counts of the block's
terms are stored, from which the corpus statistics (documents, length, document
frequencies) are summed.  The stored rows are then read shard by shard: a shard
inverts its documents into posting lists with impacts, and for the pairs of
frequent terms that stand together in items it stores the intersection list with
the joint impact of every document in it and their maximum.

At query time an item's terms form units: disjoint stored pairs, and single
terms.  A pair's bound is the greatest of its joint maximum and the two maxima
outside the intersection, which is at most the sum of the independent maxima.
Units are taken by decreasing bound while the bounds of the rest can still lift
a new document to the k-th score; from a pair whose terms cannot do that alone,
new documents come from its intersection list only.  The documents found are
then completed by look-ups, dropping those that the remaining bounds cannot lift
to the k-th score.  A task carries each item's k-th score from shard to shard.
Bounds compare strictly, so equal scores are never lost and results are exact.

Null text has no terms (neither as a document nor as an item); texts without a
term do not count as documents; very long texts are read whole; repeated
documents each take their rank, equal scores by id, rows without an id last;
equal rows of the item table are one item, different texts under one item id (or
without one) are items of their own; an empty table of either kind gives an
empty result; other columns of both tables, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from custos.llm.common import scratch_path, slices, stored, text_bytes

BLOCK_TERMS = 1_000_000
SHARD_DOCS = 1 << 16
SHARD_POSTINGS = 1 << 23
PAIR_SHARE = 64  # a term is frequent if at least one in so many documents holds it
BATCH_BYTES = 8_000_000

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return data.translate(_TERM_BYTES).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms): the distinct terms of every distinct row that has any."""
    def run(batches):
        for b in batches:
            terms = [sorted(set(terms_of(t))) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select(items[id_col].cast("long").alias("item_id"), items[text_col].cast("string").alias("text")).distinct()
    return rows.mapInArrow(run, "item_id long, terms array<binary>").where(F.size("terms") > 0)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a term: doc_id, n (all its terms), and the number and count of each of its terms in ``vocabulary``."""
    width = len(vocabulary)

    def run(batches):
        for b in batches:
            texts = text_bytes(b.column(1))
            for lo, hi in slices([len(t) for t in texts], BATCH_BYTES):
                cut = [terms_of(t) for t in texts[lo:hi]]
                n = np.array([len(c) for c in cut], np.int64)
                number = np.fromiter(map(vocabulary.get, itertools.chain.from_iterable(cut), itertools.repeat(-1)), np.int64, int(n.sum()))
                at = np.repeat(np.arange(len(cut)), n)[number >= 0]
                key, count = np.unique(at * width + number[number >= 0], return_counts=True)
                has = np.flatnonzero(n)
                ends = np.concatenate([[0], np.searchsorted(key, (has + 1) * width)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (key % width, count)]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi].take(pa.array(has)), pa.array(n[has]), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def item_units(terms: list[int], df: np.ndarray, documents: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Disjoint pairs of an item's frequent terms, the most frequent together, and its other terms."""
    frequent = sorted((t for t in terms if df[t] * PAIR_SHARE >= documents), key=lambda t: (-df[t], t))
    pairs = list(zip(frequent[::2], frequent[1::2]))
    return pairs, sorted(set(terms).difference(itertools.chain.from_iterable(pairs)))


class Shard:
    """Posting lists of some documents, and the intersection lists of term pairs."""

    def __init__(self, ids: pa.Array, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, width: int, pairs):
        self.ids, self.no_id = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.edge = np.searchsorted(term[order], np.arange(width + 1))
        self.score = np.zeros(len(ids), np.int64)
        self.pairs = {}
        place = np.full(len(ids), -1, np.int64)
        for a, b in pairs:
            (doc_a, impact_a), (doc_b, impact_b) = self.postings(a), self.postings(b)
            if not len(doc_a) or not len(doc_b):
                continue
            place[doc_a] = np.arange(len(doc_a))
            at = place[doc_b]
            place[doc_a] = -1
            both = at >= 0
            joint = impact_a[at[both]] + impact_b[both]
            only_a = np.ones(len(doc_a), bool)
            only_a[at[both]] = False
            alone = max(impact_a[only_a].max(initial=0), impact_b[~both].max(initial=0))
            self.pairs[a, b] = doc_b[both], joint, max(joint.max(initial=0), alone), alone

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.edge[t], self.edge[t + 1]
        return self.doc[lo:hi], self.impact[lo:hi]

    def units(self, pairs, singles):
        """(bound, bound outside the intersection, pair, terms) of the units held here, the greatest bound first."""
        out = []
        for p in pairs:
            if p in self.pairs:
                out.append((int(self.pairs[p][2]), int(self.pairs[p][3]), p, p))
            else:
                singles = [*singles, *p]
        for t in singles:
            best = int(self.postings(t)[1].max(initial=0))
            if best:
                out.append((best, best, None, (t,)))
        return sorted(out, key=lambda u: (-u[0], u[3]))

    def _complete(self, found: np.ndarray, terms) -> None:
        """Add the impacts of ``terms`` to the documents ``found``."""
        for t in terms:
            doc, impact = self.postings(t)
            if 4 * len(found) > len(doc):  # cheaper to walk the list
                held = np.zeros(len(self.ids), bool)
                held[found] = True
                held = held[doc]
                self.score[doc[held]] += impact[held]
            elif len(doc):
                at = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                hit = doc[at] == found
                self.score[found[hit]] += impact[at[hit]]

    def search(self, pairs, singles, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best documents here of at least ``floor`` (their places and scores), and the k-th score if higher."""
        units = self.units(pairs, singles)
        rest = [*itertools.accumulate((u[0] for u in reversed(units)), initial=0)][::-1]
        score, found, i = self.score, np.empty(0, np.int64), 0
        while i < len(units) and rest[i] >= max(floor, 1):
            _, alone, pair, terms = units[i]
            if pair and alone + rest[i + 1] < floor:  # only documents of both terms can come new
                doc, joint, _, _ = self.pairs[pair]
                found = found[score[found] + rest[i] >= floor]
                new = score[doc] == 0
                self._complete(found, terms)
                score[doc[new]] = joint[new]
                found = np.concatenate([found, doc[new]])
            else:
                for t in terms:
                    doc, impact = self.postings(t)
                    score[doc] += impact
                found = np.flatnonzero(score)
            if len(found) >= k:
                floor = max(floor, int(np.partition(score[found], -k)[-k]))
            i += 1
        for j in range(i, len(units)):
            found = found[score[found] + rest[j] >= floor]
            self._complete(found, units[j][3])
            if len(found) >= k:
                floor = max(floor, int(np.partition(score[found], -k)[-k]))
        found = found[score[found] >= max(floor, 1)]
        total = score[found]
        score[:] = 0
        best = np.lexsort((self.ids[found], self.no_id[found], -total))[:k]
        return found[best], total[best], floor


def shards_from(batches, width: int, stats: tuple[int, int], weight: np.ndarray, pairs):
    """Arrow batches of ``term_counts`` as (ids, Shard) of a bounded number of documents and postings."""
    documents, total = stats

    def shard(parts):
        ids = pa.concat_arrays([p.column(0) for p in parts])
        n, terms, counts = (np.concatenate([f(p) for p in parts]) for f in (
            lambda p: p.column(1).to_numpy(), lambda p: p.column(2).flatten().to_numpy(), lambda p: p.column(3).flatten().to_numpy()))
        doc = np.repeat(np.arange(len(n)), np.concatenate([p.column(2).value_lengths().to_numpy() for p in parts]))
        m = 10 + 90 * n * documents // total
        return ids, Shard(ids, doc, terms, impacts(weight[terms], counts.astype(np.int64), m[doc]), width, pairs)

    held, rows, postings = [], 0, 0
    for b in batches:
        size = len(b.column(2).flatten())
        if held and (rows + b.num_rows > SHARD_DOCS or postings + size > SHARD_POSTINGS):
            yield shard(held)
            held, rows, postings = [], 0, 0
        held.append(b)
        rows, postings = rows + b.num_rows, postings + size
    if held:
        yield shard(held)


def search(counts: DataFrame, items: list[tuple[int | None, list[int]]], df: np.ndarray, stats: tuple[int, int], k: int) -> DataFrame:
    """(item, item_id, doc_id, score): for every item the k best documents of each shard that may be among all its k best."""
    documents, _ = stats
    weight = weights(df, documents)
    asked = [(number, item_id, *item_units(terms, df, documents)) for number, (item_id, terms) in enumerate(items)]
    pairs = sorted({p for _, _, ps, _ in asked for p in ps})

    def run(batches):
        floors = [0] * len(asked)
        for ids, shard in shards_from(batches, len(df), stats, weight, pairs):
            number, item_ids, places, scores = [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for q, item_id, item_pairs, singles in asked:
                place, score, floors[q] = shard.search(item_pairs, singles, k, floors[q])
                number += [q] * len(place)
                item_ids += [item_id] * len(place)
                places.append(place), scores.append(score)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(item_ids, pa.int64()), ids.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))],
                                             ["item", "item_id", "doc_id", "score"])

    return counts.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def top_k(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item with a score above 0, equal ones by id.

    One pass over the texts and one over the stored counts for each block of
    items; only the terms, frequencies and pairs of a block go through the driver.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items), "items")
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    path, schema = scratch_path(spark, "found"), "block int, item int, item_id long, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("item_id", "terms").orderBy("item_id", "terms").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        if not vocabulary:
            continue
        counts = stored(term_counts(docs, vocabulary), "term_counts")
        documents, total = counts.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        found = search(counts, [(r["item_id"], [vocabulary[bytes(t)] for t in r["terms"]]) for r in rows], df, (documents, total), k)
        found.select(F.lit(block).alias("block"), "*").write.mode("append").parquet(path)
    rank = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = spark.read.schema(schema).parquet(path).withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
