"""Physical-plan properties the library relies on at scale (checked on sf0.001)."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from quillon.plans import recommender as R
from quillon.sources import standins

from conftest import SMALL


def _plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(standins.ratings(spark, SMALL), "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_name_search_limits_before_shuffle(spark):
    plan = _plan(E.queries()["name_search"](spark, SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_split_reads_input_once(spark):
    df = R.split_ratings(spark, SMALL).groupBy("part").count()
    df.collect()
    plan = _plan(df)  # final adaptive plan after execution
    assert "ReusedExchange" in plan


def test_popularity_list_is_take_ordered(spark):
    train = R.split_ratings(spark, SMALL).filter(F.col("part") == "train")
    plan = _plan(R.popularity_list(train))
    assert "TakeOrderedAndProject" in plan


def test_csv_label_filter_pushed(spark):
    plan = _plan(E.queries()["survey_filtered"](spark, SMALL), "formatted")
    assert "PushedFilters: [In(label_yn" in plan


def test_documents_text_is_pruned(spark):
    from quillon.sources.tables import table

    docs = table(spark, SMALL, "documents").select("doc_id", "n_chars", "lang", "source")
    joined = table(spark, SMALL, "labels").select("doc_id", "quality").join(docs, "doc_id")
    plan = _plan(joined, "formatted")
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan
    assert "text:string" not in plan
