"""The test suite reads a model once, and counts by hash without being misled by equal hashes."""

from pyspark.sql import functions as F

from cardmart.operators import quality as Q

CHECKS = [Q.Check("a", "id", "unique"), Q.Check("a", "id", "not_null"), Q.Check("a", "ref", "not_null"), Q.Check("a", "ref", "unique"),
          Q.Check("a", "ref", "relationships", "b", "key"), Q.Check("a", "id", "relationships", "b", "key"), Q.Check("b", "key", "unique"),
          Q.Check("b", "name", "unique")]


def models(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "z"), (None, "z"), (3, "w")], "id long, ref string")
    b = spark.createDataFrame([("x", "n"), ("x", "m"), ("y", "n"), (None, None), (None, None), ("3", "n")], "key string, name string")
    return {"a": a, "b": b}


WANT = [1, 2, 1, 1, 3, 3, 1, 1]  # the value z is repeated; z, z, w and 1, 1, 2 have no parent


def test_failures_of_every_kind(spark):
    got = Q.run_suite(models(spark), CHECKS).collect()
    assert sorted((r["test_name"], r["failures"], r["status"]) for r in got) == sorted((c.name, n, "fail") for c, n in zip(CHECKS, WANT))
    none = {m: df.limit(0) for m, df in models(spark).items()}
    assert {(r["failures"], r["status"]) for r in Q.run_suite(none, CHECKS).collect()} == {(0, "pass")}


def test_a_model_is_computed_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, f"r{i}") for i in range(50)]
    a = spark.createDataFrame(rows, "id long, ref string").mapInArrow(counting, "id long, ref string")
    b = spark.createDataFrame([(r, r) for _, r in rows], "key string, name string")
    got = Q.run_suite({"a": a, "b": b}, [c for c in CHECKS if c.model == "a" and (c.column, c.kind) != ("id", "relationships")]).collect()
    assert all(r["failures"] == 0 for r in got) and read.value == 50


def test_equal_hashes_are_no_repeats(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.length(c[0]).cast("long"))
    df = spark.createDataFrame([(i, "v") for i in range(10, 60)] + [(7, "v"), (7, "v"), (None, "v")], "id long, ref string")
    got = Q.run_suite({"a": df}, [Q.Check("a", "id", "unique"), Q.Check("a", "id", "not_null"), Q.Check("a", "ref", "unique")])
    assert [r["failures"] for r in got.collect()] == [1, 1, 1]
