"""Complete rows and population exclusions."""

from custos.operators import populations


def test_complete_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 1.0), (None, "b", None)], "id long, s string, x double")
    assert [r["id"] for r in populations.complete_rows(df).collect()] == [1]
    assert sorted(r["id"] for r in populations.complete_rows(df, ["x"]).collect()) == [1, 2]
    assert populations.complete_rows(df.limit(0)).count() == 0


def test_exclusions_keep_nulls_and_need_a_match(spark):
    df = spark.createDataFrame([(1, "former"), (2, "active"), (3, None), (None, "active"), (4, "free")], "id long, status string")
    assert sorted(str(r["id"]) for r in populations.exclude_population(df, {"status": ["former", "free"]}).collect()) == ["2", "3", "None"]
    known = spark.createDataFrame([(2,), (2,), (1,), (None,)], "id long")
    assert [r["id"] for r in populations.exclude_population(df, {"status": ["former", "free"]}, known, "id").collect()] == [2]
