"""N-gram Jaccard join by vertical partitioning.

Words are cut at ASCII white space after lower-casing A-Z; a document's set is
its distinct word n-grams as 64-bit hashes, in one global order (that of the
hashes).  Documents with equal sets form a class, and classes are joined.

Vertical partitioning cuts the global order into fragments.  Two linked sets
differ in at most ``D`` n-grams (a bound from their sizes), so of more than
``D`` fragments at least one is equal in both: sets that agree on a fragment of
the same size level are candidates.  No linked pair is missed: the cut has
``D + slack`` fragments, and only sets with so many empty fragments that all
agreement could lie there need to be matched on empty ones.  Any other set
agrees with a linked one on a known number of filled fragments, its ``spare``.
A fragment held by more than ``HOT`` classes (a passage that many documents
share) is left out by the sets with fewer such fragments than ``spare``: they
still agree on another one with whatever they link to.  Candidates are then
verified exactly: both sets are cut into coarser fragments, the overlap of each
fragment is counted on its own, and the counts are summed per pair.

Groups that agree on a fragment can be large.  They are joined as stars around
one member, not as all pairs; connected components of the verified links are
taken, and only groups that still hold several components are compared further:
up to ``TURNS`` times as stars around other members, drawn by hash, then every pair of their members from different components whose size, bitmap and
distance to the star's centre (Jaccard distance is a metric) allow a link.
So every link between different texts is verified or lies inside a component.
The links of a class are then counted exactly: every pair of a component of three
or more classes whose sizes allow a link is intersected.  Components are dealt
into blocks by hash, two blocks meet in one task, and only counts leave it, so the
work grows with the square of a component but no pair is listed.

Null or wordless texts have the empty set and no links; a text of fewer words
than the n-gram is one n-gram; very long texts are cut whole; repeated rows share
a class; of an id with several texts each text has its own class, links and
component; an empty table gives an empty result; other columns, whatever their
names, are not read.  A null id keeps its row, without a component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from custos.llm.common import discard, mix64, release_memory, slices, stored, text_bytes

FIRST_LEVEL = 9
LEVEL_RATIO = 1.5
VERIFY_FRAGMENTS = 16
HOT = 50
TURNS = 3
KEY_ROUNDS = 2
BITS, WIDE_BITS = 4, 16
BROADCAST_IDS = 1_000_000
BLOCK_HASHES = 1 << 19
BATCH_BYTES = 4_000_000
BATCH_ROWS = 1000
WORD_CACHE = 300_000
_known: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    if len(_known) > WORD_CACHE:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def shingle_set(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of one text."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(words) - size + 1 + i] + np.uint64(size))
    return np.unique(total)


def cut_batch(batch, text_column: int):
    """Slices of an Arrow batch of a bounded size of text."""
    sizes = pc.binary_length(batch.column(text_column)).fill_null(0).to_pylist()
    for lo, hi in slices(sizes, BATCH_BYTES):
        yield batch.slice(lo, hi - lo)


def long_lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def set_hash(hashes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


class Cut:
    """Size levels, difference bounds and fragment numbers of one threshold (percent)."""

    def __init__(self, percent: int):
        self.percent = percent

    def differ(self, total):
        """Most n-grams by which two linked sets of ``total`` n-grams together can differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def levels(self, size: int) -> list[tuple[int, int]]:
        """(level, largest size) of the levels at which a set of ``size`` meets others."""
        level, top = 0, FIRST_LEVEL
        while top < size:
            level, top = level + 1, int(top * LEVEL_RATIO)
        out = [(level, top)]
        if 100 * size >= self.percent * (top + 1):
            out.append((level + 1, int(top * LEVEL_RATIO)))
        return out

    def keys(self, hashes: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """Per level: hashes of (level, fragment number, fragment) to be matched, and on how many of
        these the set agrees at least with any set that it links to (0: empty fragments are matched too)."""
        out, spare = [], []
        size = len(hashes)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes), dtype=np.uint64)])
        for level, top in self.levels(size):
            d = self.differ(2 * top)
            if not d:
                continue  # linked only if equal
            slack = 2 + d // 4
            count = d + slack
            fragment = ((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            edge = np.searchsorted(fragment, np.arange(count + 1, dtype=np.uint64))
            filled = np.diff(edge) > 0
            key = mix64(np.diff(total[edge]) + mix64(np.arange(count, dtype=np.uint64) + np.uint64(level << 32)))
            agree = int(filled.sum()) - self.differ(size + min(top, 100 * size // self.percent))
            out.append((key[filled] if agree > 0 else key).view(np.int64))
            spare.append(max(agree, 0))
        return out, spare


def bitmap(hashes: np.ndarray, longs: int) -> np.ndarray:
    """Parity bits as ``longs`` longs; differing bits are at most the differing n-grams."""
    size = 64 * longs
    bits = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def signatures(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: size of its set, a hash of the whole set, fragment keys and two bitmaps."""
    cut = Cut(percent)

    def run(batches):
        for whole in batches:
            for b in cut_batch(whole, 1):
                sets = [shingle_set(t, n) for t in text_bytes(b.column(1))]
                keys, spare = zip(*(cut.keys(s) for s in sets))
                levels = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_hash(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(levels, long_lists([k for row in keys for k in row])), pa.array(spare, pa.list_(pa.int32())),
                    *(long_lists([bitmap(s, k) for s in sets]) for k in (BITS, WIDE_BITS))],
                    ["doc_id", "text_hash", "n_shingles", "set_hash", "keys", "spare", "bits", "wide_bits"])
        _known.clear()
        release_memory()

    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, set_hash binary, keys array<array<long>>, spare array<int>, bits array<long>, wide_bits array<long>")


def texts_of(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, *keep: str) -> DataFrame:
    """(class_id, set_hash, text, *keep): for each class of ``members`` (class_id, least, set_hash) the texts under its least id.

    An id may have several texts; those of another set are told apart by ``set_hash``.
    """
    few = members.count() <= BROADCAST_IDS
    texts = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("text"))
    return texts.join(F.broadcast(members) if few else members, F.col("_id") == F.col("least")).select("class_id", "set_hash", "text", *keep)


def sets_of(batch, n: int):
    """(row, set) of the rows (class_id, set_hash, text) whose text has the set of its class."""
    for row, (wanted, t) in enumerate(zip(batch.column(1).to_pylist(), text_bytes(batch.column(2)))):
        s = shingle_set(t, n)
        if set_hash(s) == wanted:
            yield row, s


def fragments_of(texts: DataFrame, n: int) -> DataFrame:
    """(class_id, hashes): each class once, its set cut into ``VERIFY_FRAGMENTS`` ranges of the global order."""
    def run(batches):
        for whole in batches:
            for b in cut_batch(whole, 2):
                rows, part = [], []
                for row, s in sets_of(b, n):
                    rows.append(row)
                    part += np.split(s.view(np.int64), np.searchsorted(s >> np.uint64(60), np.arange(1, VERIFY_FRAGMENTS, dtype=np.uint64)))
                ends = pa.array(np.arange(len(rows) + 1) * VERIFY_FRAGMENTS, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.ListArray.from_arrays(ends, long_lists(part))], ["class_id", "hashes"])

    return texts.select("class_id", "set_hash", "text").mapInArrow(run, "class_id long, hashes array<array<long>>").dropDuplicates(["class_id"])


def differing(a: str, b: str, longs: int) -> Column:
    """Lower bound of the n-grams in which two sets differ, from their bitmaps."""
    return reduce(lambda x, y: x + y, (F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(longs)))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``pairs`` (a, b, na, nb of classes) with ``inter``, the exact size of the intersection.

    Only the texts of classes in ``pairs`` are cut again.  Sets are dealt by
    class once, for both sides of a pair, and travel in one row: either join
    gives one row per pair.  The overlap of each fragment is counted by itself,
    then summed per pair.
    """
    asked = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    members = stored(classes.select("class_id", "least", "set_hash").join(asked, "class_id", "left_semi"), "members")
    sets = fragments_of(texts_of(members, docs, id_col, text_col), n)
    of = lambda s: sets.select(F.col("class_id").alias(f"_{s}"), F.col("hashes").alias(f"h{s}"))
    left = pairs.select("a", "b", "na", "nb").join(of("a").hint("merge"), F.col("a") == F.col("_a"))
    both = left.join(of("b").hint("merge"), F.col("b") == F.col("_b"))
    part = F.zip_with("ha", "hb", lambda x, y: F.size(F.array_intersect(x, y)).cast("long"))
    return both.select("a", "b", "na", "nb", F.aggregate(part, F.lit(0).cast("long"), lambda x, y: x + y).alias("inter"))


def components(edges: DataFrame) -> DataFrame:
    """(class_id, label): least reachable class of every class in ``edges`` (a, b), by repeated neighbour minima.

    Each round also follows the label's own label, so that chains halve.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("class_id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["class_id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["class_id"] == near["a"]).select("class_id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        step = stored(step, "labels")
        jump = step.select(F.col("class_id").alias("label"), F.col("label").alias("far"))
        jumped = stored(step.join(jump, "label").select("class_id", F.least("label", "far").alias("label"), "was"), "labels")
        if not jumped.where("label < was").limit(1).count():
            return jumped.select("class_id", "label")
        labels = jumped.drop("was")


def _may_link(cut: Cut, size_a: str, size_b: str, bits_a: str, bits_b: str, longs: int = BITS) -> Column:
    p = cut.percent
    fits = (F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * p)
    return fits & (differing(bits_a, bits_b, longs) * (100 + p) <= (F.col(size_a) + F.col(size_b)) * (100 - p))


def without_hot(group: DataFrame, spares: DataFrame) -> DataFrame:
    """(key, class_id, centre = least class) of ``group``, less the hot keys of sets that agree on others with all they link to.

    At most as many shared keys of a pair are hot as either set has hot ones;
    a set with fewer than ``spare`` of them shares a key that is not, so a pair
    needs its hot keys only if neither set can spare them.
    """
    hot = group.where(F.col("n") > HOT)
    counted = hot.groupBy("class_id", "level").agg(F.count("*").alias("_hot")).join(spares, "class_id")
    needed = counted.where(F.col("_hot") >= F.get("spare", "level")).select("class_id", "level")
    kept = hot.join(needed, ["class_id", "level"], "left_semi").select("key", "class_id")
    kept = stored(kept.union(group.where(F.col("n") <= HOT).select("key", "class_id")).distinct(), "kept_keys")
    centre = kept.groupBy("key").agg(F.min("class_id").alias("centre"), F.max("class_id").alias("_last")).where("centre < _last")
    return kept.join(centre.drop("_last"), "key")


def star_around_others(group: DataFrame, label: DataFrame, info: DataFrame, cut: Cut, turn: int) -> DataFrame:
    """Pairs (a, b) of another member of each key that holds several components, drawn by hash, with those of other components."""
    member = group.select("key", "class_id").join(label, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    ends = member.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.min_by("class_id", F.xxhash64("key", "class_id", F.lit(turn))).alias("_c"))
    centre = ends.where("_lo < _hi").select("key", "_c")
    met = member.join(centre, "key").join(info.select(F.col("class_id").alias("_i"), "size", "bits"), F.col("class_id") == F.col("_i")).drop("_i")
    of_centre = info.join(label, "class_id", "left").select(F.col("class_id").alias("_i"), F.coalesce("label", "class_id").alias("_label"), F.col("size").alias("_size"), F.col("bits").alias("_bits"))
    pairs = met.join(of_centre, F.col("_c") == F.col("_i")).where(F.col("label") != F.col("_label")).where(_may_link(cut, "size", "_size", "bits", "_bits"))
    return pairs.select(F.least("class_id", "_c").alias("a"), F.greatest("class_id", "_c").alias("b")).distinct()


def similar_classes(full: DataFrame, sig: DataFrame, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes, links): the classes, and the verified links (a, b, inter) that join them.

    A class is a set, known by the number (``class_id``) of one of the rows with
    the smallest id of that set, ``least``, which other sets may have as well.
    ``full`` (signatures with their fragment keys) is deleted as soon as the
    shared keys are known; ``sig`` has its other columns.
    """
    cut = Cut(percent)
    classes = sig.where("n_shingles > 0 and doc_id is not null").groupBy("set_hash").agg(F.min(F.struct("doc_id", "row")).alias("_first"), F.first("n_shingles").alias("size"))
    classes = stored(classes.select(F.col("_first.row").alias("class_id"), "set_hash", F.col("_first.doc_id").alias("least"), "size"), "classes")
    others = stored(sig.select("row").join(classes.select(F.col("class_id").alias("row")), "row", "left_anti"), "other_rows")
    few = others.count() <= BROADCAST_IDS
    of_class = lambda t: t.join(F.broadcast(others) if few else others, "row", "left_anti").withColumnRenamed("row", "class_id")
    leveled = of_class(full.select("row", "keys")).select("class_id", F.posexplode("keys").alias("level", "_keys"))
    keyed = leveled.select((2 * F.col("class_id") + F.col("level")).alias("member"), F.explode("_keys").alias("key"))  # two levels at most
    pooled = []
    for turn in range(KEY_ROUNDS):  # a share of the keys at a time, so that the shuffle files of one share are on disk
        some = keyed.where(F.pmod("key", F.lit(KEY_ROUNDS)) == turn).repartition("key")  # the counts read the same shuffle files as the join, as they need both columns
        shared = some.groupBy("key").agg(F.count("*").alias("n"), F.min("member").alias("_lo"), F.max("member").alias("_hi")).where("_lo < _hi").drop("_lo", "_hi")
        pooled.append(stored(some.join(shared, "key"), "shared_keys", release=True))
    discard(full)
    met = reduce(DataFrame.union, pooled).select("key", "n", F.shiftright("member", 1).alias("class_id"), F.col("member").bitwiseAND(1).cast("int").alias("level"))
    rep = of_class(sig).withColumnRenamed("n_shingles", "size")
    group = stored(without_hot(met, rep.select("class_id", "spare")), "groups")
    discard(*pooled)
    info = stored(rep.select("class_id", "size", "bits", "wide_bits"), "sets")
    side = lambda s, bits: info.select(F.col("class_id").alias(s), F.col("size").alias(f"n{s}"), F.col(bits).alias(f"bits_{s}"))

    def check(pairs, bits, longs):
        both = pairs.select("a", "b").join(side("a", bits), "a").join(side("b", bits), "b")
        return stored(both.where(_may_link(cut, "na", "nb", "bits_a", "bits_b", longs)).select("a", "b", "na", "nb"), "pairs")

    linked = lambda c: c.where(100 * F.col("inter") >= percent * (F.col("na") + F.col("nb") - F.col("inter")))

    star = group.where("class_id > centre").select(F.col("centre").alias("a"), F.col("class_id").alias("b")).distinct()
    star = check(check(star, "bits", BITS), "wide_bits", WIDE_BITS)
    counted = stored(verified(star, classes, docs, n, id_col, text_col), "counted", release=True, batch_rows=BATCH_ROWS)
    label = components(linked(counted))
    for turn in range(TURNS):
        new = check(star_around_others(group, label, info, cut, turn).join(counted, ["a", "b"], "left_anti"), "wide_bits", WIDE_BITS)
        if new.isEmpty():
            break
        new = stored(verified(new, classes, docs, n, id_col, text_col), "counted", release=True, batch_rows=BATCH_ROWS)
        counted = counted.union(new)
        if linked(new).isEmpty():
            break
        label = components(linked(counted))
    links = linked(counted)
    member = group.join(label, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    open_keys = member.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo < _hi").select("key")
    member = member.where("class_id > centre").join(open_keys, "key").join(info.select(F.col("class_id").alias("_i"), "size", "bits"), F.col("class_id") == F.col("_i")).drop("_i")
    distance = counted.select(F.col("a").alias("centre"), F.col("b").alias("class_id"), (1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("distance"))
    member = stored(member.join(distance, ["centre", "class_id"], "left"), "members")
    x = member.select("key", *(F.col(c).alias(f"{c}_x") for c in ("class_id", "label", "size", "bits", "distance")))
    y = member.select("key", *(F.col(c).alias(f"{c}_y") for c in ("class_id", "label", "size", "bits", "distance")))
    reach = (100 - percent) / 100 + 1e-9
    more = (x.join(y, "key").where("class_id_x < class_id_y and label_x <> label_y")
            .where(_may_link(cut, "size_x", "size_y", "bits_x", "bits_y"))
            .where(F.coalesce(F.abs(F.col("distance_x") - F.col("distance_y")) <= reach, F.lit(True)))
            .select(F.col("class_id_x").alias("a"), F.col("class_id_y").alias("b"), F.col("size_x").alias("na"), F.col("size_y").alias("nb")).distinct())
    more = check(stored(more.join(counted, ["a", "b"], "left_anti"), "pairs"), "wide_bits", WIDE_BITS)
    links = stored(links.union(linked(verified(more, classes, docs, n, id_col, text_col))), "links", batch_rows=BATCH_ROWS)
    return classes, links


def count_between(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set of ``left`` and of ``right``; without ``right``, of ``left`` among themselves (in the first array)."""
    other = left if right is None else right
    order = np.argsort([len(s) for s in other], kind="stable")
    if right is None:
        left = [left[i] for i in order]
    _, number = np.unique(np.concatenate([*left, *(other[i] for i in order)]), return_inverse=True)
    ends = np.cumsum([len(s) for s in left])
    sizes = np.array([len(other[i]) for i in order], np.int64)
    places, starts = number[ends[-1]:], np.concatenate([[0], np.cumsum(sizes)])
    held = np.zeros(len(number), np.int64)
    a, b = np.zeros(len(left), np.int64), np.zeros(len(other), np.int64)
    for i, end in enumerate(ends):
        size = len(left[i])
        lo = i + 1 if right is None else int(np.searchsorted(100 * sizes, percent * size))
        hi = int(np.searchsorted(percent * sizes, 100 * size, "right"))
        if lo >= hi:
            continue
        mine = number[end - size:end]
        held[mine] = 1
        inter = np.add.reduceat(held[places[starts[lo]:starts[hi]]], starts[lo:hi] - starts[lo])
        held[mine] = 0
        linked = 100 * inter >= percent * (size + sizes[lo:hi] - inter)
        a[i] += linked.sum()
        b[lo:hi] += linked
    back = np.empty_like(b)
    back[order] = b
    if right is not None:
        return a, back
    own = np.empty_like(a)
    own[order] = a
    return own + back, np.empty(0, np.int64)


def link_counts(label: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(class_id, n_links) of every class in the components ``label`` (class_id, label)."""
    sized = label.join(classes.select("class_id", "size"), "class_id")
    of_component = sized.groupBy("label").agg(F.count("*").alias("_m"), F.ceil(F.sum("size") / BLOCK_HASHES).alias("blocks"))
    found = stored(label.join(of_component, "label").join(classes.select("class_id", "least", "set_hash"), "class_id"), "component_members")
    members = stored(found.where("_m > 2").drop("_m"), "members")
    wanted = texts_of(members, docs, id_col, text_col, "label", "blocks")

    def cut(batches):
        for whole in batches:
            for b in cut_batch(whole, 2):
                found = list(sets_of(b, n))
                rows = pa.array([row for row, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(rows) for i in (0, 3, 4)), long_lists([s.view(np.int64) for _, s in found])], ["class_id", "label", "blocks", "hashes"])

    def count(table):
        sets = np.split(*(lambda c: (c.flatten().to_numpy(), c.value_lengths().to_numpy().cumsum()[:-1]))(table.column("hashes").combine_chunks()))
        ids, mine = table.column("class_id").to_numpy(), table.column("mine").to_numpy()
        first = mine == table.column("lo")[0].as_py()
        pick = lambda which: [sets[i] for i in np.flatnonzero(which)]
        if first.all() or not first.any():
            within = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
            total, found = (count_between(sets, None, percent)[0], ids) if within else (np.empty(0, np.int64), ids[:0])
        else:
            total, found = np.concatenate(count_between(pick(first), pick(~first), percent)), np.concatenate([ids[first], ids[~first]])
        return pa.table({"class_id": pa.array(found, pa.int64()), "n_links": pa.array(total, pa.int64())})

    own = wanted.mapInArrow(cut, "class_id long, label long, blocks long, hashes array<long>").dropDuplicates(["class_id"]).withColumn("mine", F.pmod(F.xxhash64("class_id"), "blocks"))
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("label", F.least("mine", "_other").alias("lo"), F.greatest("mine", "_other").alias("hi"), "mine", "class_id", "hashes")
    counted = met.groupBy("label", "lo", "hi").applyInArrow(count, "class_id long, n_links long")
    pairs = found.where("_m = 2").select("class_id", F.lit(1).cast("long").alias("n_links"))
    return counted.groupBy("class_id").agg(F.sum("n_links").alias("n_links")).union(pairs)


def linked_rows(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, count_links: bool) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, its class (number), least id and group (number) of linked classes, the group's least id; links of the class."""
    full = stored(signatures(docs, n, percent, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "signatures", batch_rows=BATCH_ROWS)
    sig = stored(full.drop("keys"), "rows")
    classes, links = similar_classes(full, sig, docs, n, percent, id_col, text_col)
    label = components(links)
    least = label.join(classes, "class_id").groupBy("label").agg(F.min("least").alias("component"))
    of_class = classes.select("set_hash", "least", "class_id").join(label, "class_id", "left").join(least, "label", "left")
    of_class = of_class.select("set_hash", "class_id", "least", F.coalesce("label", "class_id").alias("group"), F.coalesce("component", "least").alias("component"))
    if count_links:
        of_class = of_class.join(link_counts(label, classes, docs, n, percent, id_col, text_col), "class_id", "left")
    return sig.select("doc_id", "text_hash", "n_shingles", "set_hash").join(of_class, "set_hash", "left").drop("set_hash")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id, component_id, n_links.

    ``class_id`` is the smallest id with the same set, ``component_id`` the
    smallest id reachable over links (its own without any), ``n_links`` the
    number of all other classes that its class links to (no such column
    without ``count_links``).
    """
    rows = linked_rows(docs, n, percent, id_col, text_col, count_links)
    number = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    own = lambda c: F.when(F.col("n_shingles") > 0, F.col(c)).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", own("least").alias("class_id"), own("component").alias("component_id"), *number)


def without_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (all columns): of each group of linked documents the one of smallest id stays.

    Rows are told apart by id and text, so a text goes only for its own links.
    Rows that repeat id and text become one; rows without an id all stay.
    """
    rows = stored(linked_rows(docs, n, percent, id_col, text_col, False).where("doc_id is not null"), "linked")
    row = F.struct("doc_id", "text_hash")
    some = rows.where("n_shingles > 0").select("doc_id", "text_hash", "group")
    keep = some.groupBy("group").agg(F.min(row).alias("keep"), F.max(row).alias("last")).where("keep < last").drop("last")
    gone = some.join(keep, "group").where(row != F.col("keep")).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    gone = stored(gone, "gone")
    again = stored(rows.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).count().where("count > 1").drop("count"), "again")
    same = (docs[id_col].cast("long") == F.col("_d")) & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(F.col("_t"))
    few = lambda t, number: F.broadcast(t) if number <= BROADCAST_IDS else t
    left, repeats = docs.join(few(gone, gone.count()), same, "left_anti"), again.count()
    if not repeats:
        return left
    once = left.join(few(again, repeats), same, "left_semi").withColumn("_first", F.xxhash64(docs[text_col].cast("string"))).dropDuplicates([id_col, "_first"]).drop("_first")
    return left.join(few(again, repeats), same, "left_anti").union(once)
