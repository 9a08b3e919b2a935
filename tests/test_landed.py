from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringEndsWith, StringStartsWith

from quarterdeck.plans.documents import dealt_by_size
from quarterdeck.sources import landed
from quarterdeck.sources.landed import LandedReader, landed_files, open_files


def tree(root):
    for place in ("a/1/x.txt", "a/1/y.txt", "a/2/x.htm", "b/1/x.txt", "b/1/deep/er/z.txt", "top.txt", "a/1/_hidden", "a/1/.crc"):
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_text(place)
    return {"a/1/x.txt", "a/1/y.txt", "a/2/x.htm", "b/1/x.txt", "b/1/deep/er/z.txt", "top.txt"}


def test_files_are_listed_by_folder(spark, tmp_path):
    whole, root = tree(tmp_path), str(tmp_path)
    for place in (root, f"file:{root}", f"file://{root}"):
        rows = landed_files(spark, place).collect()
        assert {r.path for r in rows} == {f"{place}/{p}" for p in whole} and len(rows) == len(whole)
        assert all(r.folder == r.path.rsplit("/", 1)[0] and r.length == len(r.path) - len(place) - 1 for r in rows)
    assert {r.doc_id for r in landed_files(spark, [f"{root}/a/1", f"{root}/none"], depth=0).collect()} == {"x", "y"}
    assert landed_files(spark, root, depth=0, below=False).count() == 1
    assert landed_files(spark, f"{root}/none").count() == 0
    # A partition for each folder: the root, a and b, and the folders in these.
    assert landed_files(spark, root).rdd.getNumPartitions() == 6


def test_names_are_filtered_by_the_source(spark, tmp_path):
    tree(tmp_path)
    root = str(tmp_path)
    found = landed_files(spark, root, content=True)
    cases = {
        "doc_id = 'x'": {"a/1/x.txt", "a/2/x.htm", "b/1/x.txt"},
        f"path IN ('{root}/a/1/y.txt', '{root}/b/1/deep/er/z.txt')": {"a/1/y.txt", "b/1/deep/er/z.txt"},
        f"folder = '{root}/b/1/deep/er'": {"b/1/deep/er/z.txt"},
        f"startswith(folder, '{root}/a/') AND doc_id <> 'y'": {"a/1/x.txt", "a/2/x.htm"},
        "endswith(path, '.htm')": {"a/2/x.htm"},
    }
    for condition, wanted in cases.items():
        rows = found.filter(condition).collect()
        assert {r.content.decode() for r in rows} == wanted, condition
    plan = found.filter("doc_id = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "= x" not in plan  # no comparison is left to Spark


def test_folders_that_cannot_hold_a_file_are_not_planned(tmp_path):
    tree(tmp_path)
    root = str(tmp_path)

    def planned(*filters):
        reader = LandedReader([root], 2, True, False)
        left = list(reader.pushFilters(list(filters)))
        return {f.location[len(root) :] for f in reader.partitions()} - {""}, left

    assert planned() == ({"/a", "/b", "/a/1", "/a/2", "/b/1"}, [])
    assert planned(EqualTo(("folder",), f"{root}/a/2"))[0] == {"/a/2"}
    assert planned(EqualTo(("folder",), f"{root}/b/1/deep/er"))[0] == {"/b/1"}
    assert planned(In(("path",), (f"{root}/a/1/x.txt", f"{root}/b/1/deep/z.txt")))[0] == {"/a/1", "/b/1"}
    assert planned(StringStartsWith(("folder",), f"{root}/a"))[0] == {"/a", "/a/1", "/a/2"}
    assert planned(StringEndsWith(("folder",), "/2"), EqualTo(("doc_id",), "x"))[0] == planned()[0]
    other = GreaterThan(("length",), 3)
    assert planned(other) == (planned()[0], [other])


def test_only_wanted_files_are_opened(spark, tmp_path, monkeypatch):
    tree(tmp_path)
    rows = [(f"{tmp_path}/a/1/x.txt", 1), (f"{tmp_path}/gone.txt", 2), (None, 3), (f"{tmp_path}/a", 4), (f"{tmp_path}/top.txt", 5)]
    wanted = spark.createDataFrame(rows, "path string, n int")
    assert {(r.n, bytes(r.content)) for r in open_files(wanted).collect()} == {(1, b"a/1/x.txt"), (5, b"top.txt")}
    monkeypatch.setattr(landed, "_BATCH_BYTES", 3)
    assert open_files(wanted).count() == 2


def test_large_groups_are_dealt_out_by_size(spark):
    files = spark.range(1000).select(
        F.concat(F.lit("p"), "id").alias("path"), F.lit(100).cast("long").alias("length"), F.expr("if(id < 800, 'hot', concat('g', id % 5))").alias("g")
    )
    dealt = dealt_by_size(files, ["g"], task_bytes=5000).withColumn("task", F.spark_partition_id())
    assert dealt.count() == 1000
    sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 250
    assert dealt_by_size(files.filter("false"), ["g"]).count() == 0


def test_a_small_run_of_files_is_parsed_by_every_core(spark):
    """Half a task's size in one group, and in many: no core is left without files."""
    for groups in (1, 40):
        files = spark.range(400).select(
            F.concat(F.lit("p"), "id").alias("path"), F.lit(80_000).cast("long").alias("length"), (F.col("id") % groups).cast("string").alias("g")
        )
        dealt = dealt_by_size(files, ["g"]).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
        assert sum(sizes) == 400 and len(sizes) >= 4 and max(sizes) < 200
