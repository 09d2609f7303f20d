"""Whole tiles compared at once: the same matches as pair by pair, Jaro-Winkler on whole matrices."""

import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from custos.functions.text import JaroWinkler, jaro_winkler_py
from custos.operators import linkage as lk, matching
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("threshold", [0.7, 0.9])
def test_tables_and_lists_equal_the_scalar_form(threshold):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdé1.") for _ in range(n))
    strings = [None, "", "a", "a\0b", "a\0b", *(word(rng.randint(1, 12)) for _ in range(120)), *(word(rng.randint(60, 70)) for _ in range(8))]
    want = np.array([[bool(a and b and jaro_winkler_py(a, b) >= threshold) for b in strings] for a in strings])
    jw, every = JaroWinkler(strings, threshold), np.arange(len(strings))
    x, y = (v.ravel() for v in np.indices(want.shape))
    assert (jw.table(every, every) == want).all() and (jw.pairs(x, y) == want.ravel()).all() and 0 < want.sum() < want.size


def records(spark, rng, n, start, ids):
    word = lambda k: rng.choice([None, "", "ann", "anna", "bob", "lee", "leigh"][:k])
    rows = [(start + rng.randint(0, ids), rng.choice([None, "ann1@x.te", "bnn12@x.te", f"ann{i}@x.te"]), word(5), word(7), f"{i % 13} main st{rng.choice(['', 'e'])}",
             word(4), word(5), word(6), f"55{rng.randint(0, 40)}0{i % 10}") for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} string" for c in lk.RECORD_COLS)).persist()


@pytest.mark.parametrize("tile", [37, 512])
@pytest.mark.parametrize("rule", ["effective", "intended"])
def test_matches_of_tiles_equal_those_of_pairs(spark, tile, rule):
    rng = random.Random(tile)
    old, new = records(spark, rng, 300, 0, 270), records(spark, rng, 110, 200, 200)  # ids repeat, nulls in every column
    for left, right, rules in ((old, None, lk.FULL_RULES), (new, old, lk.INCREMENTAL_RULES)):
        features = lk._staged_matches(lk.block_pairs(left, rules, right, carry=lk.RECORD_COLS), rule)
        got = lk.match_blocks(left, rules, right, rule, tile)
        assert got.columns == features.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, features.collect())) and got.count()


def test_no_records_and_an_unknown_rule(spark):
    rng = random.Random(1)
    none = records(spark, rng, 1, 0, 1).where("false")
    assert lk.match_blocks(none, lk.FULL_RULES).count() == 0
    with pytest.raises(ValueError):
        lk.match_blocks(none, lk.FULL_RULES, rule="other")


@pytest.mark.parametrize("query", ["full_matches", "entity_assignment", "incremental_pairs", "incremental_merge"])
def test_matching_makes_no_row_per_candidate_pair(spark, query):
    plan = E.queries()[query](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "_jw_udf" not in plan


@pytest.mark.parametrize("query", ["candidate_pairs_full", "pair_features", "match_strength"])
def test_pairs_are_listed_and_counted_in_tiles(spark, query):
    plan = E.queries()[query](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "_jw_udf" not in plan


@pytest.mark.parametrize("tile", [29, 512])
def test_listed_and_counted_pairs_equal_those_of_the_join(spark, tile):
    rng = random.Random(tile)
    old, new = records(spark, rng, 300, 0, 270), records(spark, rng, 110, 200, 200)  # ids repeat, nulls in every column
    old = old.unionByName(old.limit(3).withColumn("customer_id", lk.F.lit(None).cast("long")))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    for left, right, rules in ((old, None, lk.FULL_RULES), (new, old, lk.INCREMENTAL_RULES)):
        want = rows(lk.block_pairs(left, rules, right).select("customer_id_1", "customer_id_2"))
        assert rows(lk.candidate_pairs(left, rules, right, tile=tile)) == want and want
    want = lk.compare_pairs(lk.block_pairs(old, lk.FULL_RULES).select("customer_id_1", "customer_id_2"), old).persist()
    assert rows(lk.compare_blocks(old, lk.FULL_RULES, tile=tile)) == rows(want)
    assert rows(lk.match_strength(lk.compare_blocks(old, lk.FULL_RULES, counted=True, tile=tile))) == rows(lk.match_strength(want))
    none = old.where("false")
    assert lk.candidate_pairs(none).count() == lk.compare_blocks(none, lk.FULL_RULES).count() == lk.match_strength(lk.compare_blocks(none, lk.FULL_RULES, counted=True)).count() == 0


def test_a_record_of_a_large_block_is_copied_a_few_times(spark):
    """Copies go with block / tile: a block of 6,000 records makes two sub-blocks, three copies a record, not twelve and thirteen."""
    hot = spark.range(6000).select(lk.F.col("id").alias("customer_id"), *(lk.F.lit(v).cast("string").alias(c) for c, v in (
        ("first_name_clean", "ann"), ("last_name_clean", "lee"), ("zip_clean", None), ("state_clean", None))))
    tiles = lk._tile_rows(hot, lk.FULL_RULES, None, ["first_name_clean", "last_name_clean", "state_clean", "zip_clean"], None)
    assert tiles.count() <= 2 * 6000


def test_a_large_tile_is_compared_some_pairs_at_a_time(monkeypatch):
    """Rectangles are cut, so that a tile where every pair may match holds a bounded number of pairs at once."""
    rows = [{"rule": 0, "key": "k", "i": 0, "j": 0, "side": 0, "id": k, "email": f"ann{k}@x.te", "first_name_clean": "ann", "last_name_clean": "lee",
             "state_clean": "tx", "zip_clean": str(k % 9), "address_clean": f"{k % 7} st", "city_clean": "elgin", "phone_clean": f"555{k}"} for k in range(300)]
    schema = pa.schema([*((c, pa.int64()) for c in ("rule", "i", "j", "side", "id")), ("key", pa.string()), *((c, pa.string()) for c in lk.RECORD_COLS),
                        ("_more", pa.list_(pa.struct([(c, pa.string()) for c in lk.RECORD_COLS])))])
    batch = pa.RecordBatch.from_pylist(rows, schema=schema)
    kinds = [matching.TileMatcher(lk.FULL_RULES, lk.COMPARE_SPEC, lk.SCORE_COLS, "effective", False), *(matching.TileLister(lk.FULL_RULES, lk.COMPARE_SPEC, False, out) for out in ("pairs", "features", "counts"))]
    listed = lambda m: [b.to_pylist() for b in m(iter([batch]))]
    every = lambda parts: sorted(tuple(r.values()) for part in parts for r in part)
    want = [every(listed(m)) for m in kinds]
    asked, plain = [], matching._Records._rectangle
    monkeypatch.setattr(matching._Records, "_rectangle", lambda self, a, b: (asked.append(len(a) * len(b)), plain(self, a, b))[1])
    for name, value in (("CELLS", 500), ("POOL", 400)):
        monkeypatch.setattr(matching, name, value)
    for m, rows_of in zip(kinds, want):
        parts = listed(m)
        assert every(parts) == rows_of and rows_of and max(map(len, parts)) <= 400 + matching.LEAF ** 2
    assert asked and max(asked) <= 500
