import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterdeck.operators import keys, ordered, quality, reshape, types


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), i, rnd.choice([None, float(i)])) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, i int, v double").withColumn("h", F.md5(F.col("i").cast("string")))


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, a.select(columns).collect()), key=key) == sorted(map(tuple, b.select(columns).collect()), key=key)


def test_number_rows_equals_window(skewed):
    group = Window.partitionBy("g")
    plain = skewed.withColumn("n", F.row_number().over(group.orderBy("h")).cast("bigint"))
    plain = plain.withColumn("all", F.count(F.lit(1)).over(group))
    same(ordered.number_rows(skewed, ["g"], [F.col("h")], ordered.hash_bucket(F.col("h"), 1), "n", "all"), plain)


def test_fill_down_equals_window(skewed):
    down = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("v", F.last("v", ignorenulls=True).over(down))
    same(ordered.fill_down(skewed, ["g"], [F.col("i")], F.floor(F.col("i") / 100), ["v"]), plain)


def test_keep_first_drops_copies_before_the_shuffle(skewed):
    first = keys.keep_first(skewed, ["g"], ["i"])
    assert {r.g: r.i for r in first.collect()} == {r.g: r.i for r in skewed.groupBy("g").agg(F.min("i").alias("i")).collect()}
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_membership(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r.k for r in keys.not_done(df, done, ["k"]).collect()} == {"b", "c"}
    assert {r.k for r in keys.only_ids(df, "k", ["a", "z"]).collect()} == {"a"}
    assert {r.k for r in keys.only_ids(df, "k", [str(i) for i in range(2000)] + ["b"]).collect()} == {"b"}
    assert keys.only_ids(df, "k", None).count() == 3


def test_nest_groups_keeps_all_rows(skewed):
    nested = reshape.nest_groups(skewed, ["g"], [F.col("h")], ordered.hash_bucket(F.col("h"), 1), ["i"], chunk_rows=50)
    rows = nested.select("g", "Chunk", F.size("Rows").alias("n")).collect()
    assert max(r.n for r in rows) == 50 and sum(r.n for r in rows) == 3000


def test_pivot_other_names(spark):
    df = spark.createDataFrame(
        [("p", "A", "1", 0), ("p", "A", "2", 1), ("p", "X", "3", 2), ("q", "Y", None, 0)], "k string, Name string, Info string, at int"
    )
    rows = {r.k: r for r in reshape.pivot_attributes(df, ["k"], ["A", "B"], F.col("at")).collect()}
    assert (rows["p"].A, rows["p"].B, rows["p"].Other) == ("1", None, {"X": "3"})
    assert rows["q"].Other == {"Y": None}


def test_quality(spark):
    df = spark.createDataFrame(
        [(None, 200, "x"), (None, 404, "x"), ("gone", None, None), (None, None, "x"), (None, 299, " \n\t")],
        "e string, s int, c string",
    )
    reason = F.coalesce(quality.request_reason(F.col("e"), F.col("s")), quality.content_reason(F.col("c")))
    parts = quality.split_valid(df, reason)
    assert parts.valid.count() == 1
    assert {r.Reason for r in parts.quarantine.collect()} == {
        "Status Code (404)", "gone", "Status Code (NA)", "Content is Empty",
    }


def test_types(spark):
    counts = spark.createDataFrame([("A-F", 2), ("N-O", 1), (None, 4)], "Type string, nDocs bigint")
    rules = [types.TypeRule("c1", "^A", "m1", "d1"), types.TypeRule("c2", "F$", "m2", "d2")]
    rows = {r.DocTypeRaw: (r.DocTypeMod, r.nHit) for r in types.classify_types(counts, rules).collect()}
    assert rows == {"A-F": ("m1", 2), "N-O": (None, 0), None: (None, 0)}
    lookup = spark.createDataFrame([("m", "r1"), ("m", "r2")], "DocTypeMod string, DocTypeRaw string")
    wanted = spark.createDataFrame([("m",), ("z",), ("y",)], "DocTypeMod string")
    with pytest.raises(types.UnknownTypes, match="y, z"):
        types.require_doc_types(wanted, lookup)
    assert types.require_doc_types(wanted.filter("DocTypeMod = 'm'"), lookup).count() == 2
