"""Physical-plan properties that matter at scale (checked with the executed plan text)."""

from pyspark.sql import functions as F

from tidewater.functions.text import sentiment_score
from tidewater.operators import labels, posts
from tidewater.plans import views

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return sum(1 for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line)


def test_top_labels_is_partial_aggregate_and_top_k(spark):
    p = posts.posts(views.stored_pages(spark, SF001))
    plan = labels.top_labels(p, 14).select("label", "cnt").limit(14)
    text = _plan(labels.label_counts(p).orderBy(F.col("cnt").desc(), "label").limit(14))
    assert "TakeOrderedAndProject" in text  # per-task top-k, no global sort
    assert "partial_count" in text  # map-side combine before the shuffle
    assert plan.count() == 14


def test_page_scan_prunes_nested_fields(spark):
    p = posts.posts(views.stored_pages(spark, SF001))
    q = labels.label_counts(p)
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "context_annotations" in text and "ReadSchema" in text
    schema = q._jdf.queryExecution().sparkPlan().toString()
    assert "text:" not in schema and "public_metrics" not in schema


def test_sentiment_has_no_exchange(spark):
    docs = views.table(spark, SF001, "documents")
    assert _exchanges(_plan(docs.select("doc_id", sentiment_score("text")))) == 0


def test_page_texts_are_not_shuffled(spark):
    plan = _plan(views.pages(spark, SF001))
    # one exchange of the narrow line items by order key and one of orders for
    # the join; part and documents come in by broadcast after the exchange
    assert _exchanges(plan) == 2
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line


def test_filters_reach_the_scan(spark):
    ev = views.table(spark, SF001, "events").filter(F.col("event_type").isin("purchase", "error")).select("event_id")
    text = _plan(ev)
    assert "PushedFilters: [In(event_type" in text or "PushedFilters: [IsNotNull(event_type), In(event_type" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
