"""How often the queries make what they read, on rows of their own."""

import glob
from datetime import datetime

import pytest

from quarterdeck.checks import views
from quarterdeck.checks.queries import QUERIES
from quarterdeck.plans.documents import group_progress, nest_documents


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime(1997, 5, 6)
    rows = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(k, f"Customer {k}", k % 3, 1.0, "BUILDING") for k in range(60)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(k, k % 60, "FO"[k % 2], 1.0, day, "2-HIGH") for k in range(90)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(k % 90, k, k, 1 + k % 5, 2.0, 3.0, 0.0, 0.0, "AR"[k % 2], "FO"[k % 2], day) for k in range(300)]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["read_links", "docs_by_type", "nest_documents", "group_progress", "pending_documents"])
def test_links_are_made_once(spark, tables, monkeypatch, name):
    made, doc_links = [], views.doc_links
    monkeypatch.setattr(views, "doc_links", lambda *a: made.append(a) or doc_links(*a))
    assert QUERIES[name](spark, tables).count() > 0
    assert len(made) == 1


def test_listed_files_are_written_by_several_tasks(spark, tables):
    assert [r.Listed for r in QUERIES["listed_files"](spark, tables).collect()] == [True] * 3
    newest = max(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/listed-*"), key=lambda p: len(glob.glob(f"{p}/*/part-*")))
    assert len({f.rsplit("/part-", 1)[1][:5] for f in glob.glob(f"{newest}/*/part-*.parquet")}) > 1


@pytest.mark.parametrize("work", [group_progress, nest_documents])
def test_documents_are_found_once_to_be_counted_and_numbered(spark, work):
    rows = [("t", "2001-1", f"c-{k:04x}", f"u{k}") for k in range(50)]
    docs = spark.createDataFrame(rows, "TypeSave string, YQSave string, DocID string, UrlDocument string")
    found = work(docs.withColumn("DocID", docs.DocID).filter("UrlDocument like 'u%'").distinct())
    assert "LIKE" not in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "StartsWith" not in plan
    assert found.count() == (50 if work is group_progress else 1)
