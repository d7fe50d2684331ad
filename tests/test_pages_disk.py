"""Pages are built without sorting, shuffling or storing the texts of their posts."""

import os
import re
import sys

import pytest
from pyspark.sql import functions as F

from tidewater.operators import posts
from tidewater.plans import catalog, views


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Orders 1 to 3 (1 twice over, 3 without lines), a line without part, one without document, repeated lines and a repeated part."""
    d = str(tmp_path_factory.mktemp("shop"))
    day = "timestamp'2020-01-02'"
    lines = [(1, 1, 1, 1), (1, 2, 2, 1), (1, 9, 1, 2), (2, 1, 1, 1), (2, 1, 1, 1), (2, 3, 2, 2), (2, 2, 1, 7), (None, 1, 1, 1), (7, 1, 1, 1)]
    li = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").selectExpr(
        "*", "double(l_linenumber) l_quantity", "1000.5 * l_linenumber l_extendedprice", "0.05D l_discount",
        "if(l_linenumber = 2, 0D, 0.03D) l_tax", f"{day} l_shipdate", "if(l_partkey = 1, 'R', 'A') l_returnflag", "'F' l_linestatus")
    part = spark.createDataFrame([(1, "red big box", "STEEL", "B1", 3), (2, "blue box", "TIN", "B2", 4), (3, None, None, "B3", 5), (3, "x y", "TIN", "B3", 8)],
                                 "p_partkey long, p_name string, p_type string, p_brand string, p_size int")
    orders = spark.createDataFrame([(1, 5, 1500.0), (1, 6, 2500.0), (2, 5, 99.0), (3, None, 7.0)], "o_orderkey long, o_custkey long, o_totalprice double")
    orders = orders.selectExpr("*", f"{day} o_orderdate")
    cust = spark.createDataFrame([(5, "ann", 3, 10.5), (6, "bo", None, None)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double")
    docs = spark.createDataFrame([(i, None if i == 9 else f"text {i} " * 40, "en") for i in range(0, 40) if i != 8], "doc_id long, text string, lang string")
    for name, df in {"lineitem": li, "part": part, "orders": orders, "customer": cust, "documents": docs}.items():
        df.coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_only_lines_are_sorted_before_posts_are_gathered(spark, shop):
    plan = _plan(views.pages(spark, shop))
    assert "collect_list" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    # the sorts are of orders and of lines: both lie below the joins that bring in text and part
    depth = [len(re.match(r"[\s:|+\-]*", line).group()) for line in plan.splitlines()]
    rows = plan.splitlines()
    window = next(i for i, line in enumerate(rows) if "Window [collect_list" in line)
    joins = [i for i, line in enumerate(rows) if "BroadcastHashJoin [doc_id" in line]
    sorts = [i for i, line in enumerate(rows) if re.search(r"\bSort \[", line) and i > window]
    assert joins and len(sorts) == 1 and sorts[0] > joins[0] and depth[sorts[0]] > depth[joins[0]]


def test_stored_pages_hold_no_text_and_the_same_posts(spark, shop):
    stored, full = views.stored_pages(spark, shop), views.pages(spark, shop)
    assert "text:" not in stored.schema.simpleString() and "text:" in full.schema.simpleString()
    bare = full.withColumn("data", F.transform("data", lambda p: p.dropFields("text")))
    line = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())
    order = ["page_id", "__twarc", "data", "includes"]
    assert line(stored.select(*order)) == line(bare.select(*order))


def _rows(df):
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).collect())


def test_pages_written_in_slices_are_the_same(spark, shop, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "LINES_PER_SLICE", 3)  # 9 lines: 3 slices
    os.symlink(shop, tmp_path / "again")
    parts, made = [], views.pages

    def counted(*a, **b):
        parts.append(b["part_of"])
        return made(*a, **b)

    monkeypatch.setattr(views, "pages", counted)
    stored = views.stored_pages(spark, str(tmp_path / "again"))
    assert parts == [(0, 3), (1, 3), (2, 3)]
    assert _rows(stored) == _rows(made(spark, shop, text=False)) and stored.count() == 4


def test_an_order_without_key_is_in_one_slice(spark):
    keys = spark.createDataFrame([(None,), (1,), (1,), (2,), (3,)], "k long")
    got = [r["k"] for i in range(4) for r in views._in_slice(keys, "k", (i, 4)).collect()]
    assert sorted(got, key=str) == [1, 1, 2, 3, None]


def test_stored_posts_get_their_texts_without_building_pages_again(spark, shop):
    stored = posts.posts(views.stored_pages(spark, shop), keep=("page_id",))
    found = views.with_texts(stored, shop)
    full = posts.posts(views.pages(spark, shop), keep=("page_id",))
    assert _rows(found) == _rows(full)
    assert "lineitem" not in _plan(found) and "Window" not in _plan(found) and "SortMergeJoin" not in _plan(found)


def test_texts_of_repeated_documents_are_not_guessed(spark, shop, tmp_path):
    docs = spark.read.parquet(f"{shop}/documents.parquet")
    docs.unionByName(docs.filter("doc_id = 10").withColumn("text", F.lit("other"))).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("lineitem", "part", "orders", "customer"):
        os.symlink(f"{shop}/{name}.parquet", tmp_path / f"{name}.parquet")
    d = str(tmp_path)
    assert views.with_texts(posts.posts(views.stored_pages(spark, d), keep=("page_id",)), d) is None
    got, want = catalog._posts_with_text(spark, d), posts.posts(views.pages(spark, d), keep=("page_id",))
    assert _rows(got) == _rows(want)


def test_pages_hold_every_post_once(spark, shop):
    got = {}
    for r in views.pages(spark, shop).collect():
        got.setdefault(r["page_id"], []).append(None if r["data"] is None else [p["id"] for p in r["data"]])
    # line 3 of order 1 has no part; the repeated part gives its line twice
    assert got == {1: [["1-1", "1-1"]] * 2, 2: [["2-1", "2-1", "2-2", "2-2", "2-7"]], 3: [None]}
    texts = posts.posts(views.pages(spark, shop)).select("id", "text").collect()
    places = 42  # floor((39 + 1) * 1.05)
    for r in texts:
        k, n = map(int, r["id"].split("-"))
        doc = (k * 7 + n) % places
        assert r["text"] == (None if doc in (8, 9) or doc >= 40 else f"text {doc} " * 40)


def test_followers_are_broadcast_when_small(spark):
    feats = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", None)], "tweet_id string, user_id string")
    users = spark.createDataFrame([("1", 10, "d"), ("1", 30, "e"), (None, 5, "d")], "user_id string, followers_count long, retrieved_at string")
    joined = posts.attach_followers(feats, posts.dedup_users(users))
    assert "BroadcastHashJoin" in _plan(joined)
    assert [(r["tweet_id"], r["followers_count"]) for r in joined.collect()] == [("x", 30)]


def test_lines_are_shuffled_as_numbers_only(spark, shop):
    rows = views.post_rows(spark, shop, text=False)
    tree = rows._jdf.queryExecution().optimizedPlan()
    while not tree.nodeName().startswith("Repartition"):
        tree = tree.children().apply(0)
    kinds = [tree.output().apply(i).dataType().simpleString() for i in range(tree.output().size())]
    assert len(kinds) <= 10 and "string" not in kinds, kinds


def test_sixty_times_the_lines_are_written_in_six_slices(spark, shop, tmp_path, monkeypatch):
    """36 million lines: the shuffle of a sixth of them is on disk at a time."""
    os.symlink(shop, tmp_path / "many")
    table, parts, made = views.table, [], views.pages

    class Many:
        def count(self):
            return 36_000_000

    monkeypatch.setattr(views, "table", lambda s, d, name: Many() if name == "lineitem" and not parts else table(s, d, name))

    def counted(*a, **b):
        parts.append(b["part_of"])
        return made(*a, **b)

    monkeypatch.setattr(views, "pages", counted)
    stored = views.stored_pages(spark, str(tmp_path / "many"))
    assert parts == [(i, 6) for i in range(6)]
    assert _rows(stored) == _rows(made(spark, shop, text=False))


def test_hash_split_gives_validation_a_fifth_of_the_posts(spark, monkeypatch):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    monkeypatch.setattr(catalog, "_metrics", lambda s, d: ids)
    found = {r["split"]: r["n"] for r in catalog.q_hash_split(spark, "").groupBy("split").agg(F.count("id").alias("n")).collect()}
    assert sum(found.values()) == 5000 and 900 < found["validation"] < 1100, found


def test_json_pages_are_on_disk_slice_by_slice(spark, shop, monkeypatch):
    monkeypatch.setattr(catalog, "JSON_SLICE_BYTES", 2000)
    slices, seen, made, read = [], [], views.pages, catalog.readers.read_pages

    def counted(*a, **b):
        slices.append(b["part_of"])
        return made(*a, **b)

    def back(s, path):
        folder, name = os.path.split(path.removeprefix("file:"))
        seen.append([f for f in os.listdir(folder) if f.startswith("tidewater-pages-json")])
        assert name in seen[-1]
        return read(s, path)

    monkeypatch.setattr(views, "pages", counted)
    monkeypatch.setattr(catalog.readers, "read_pages", back)
    got = catalog.q_json_pages(spark, shop)
    want = posts.posts(made(spark, shop)).select("id", "author_id", "created_at", "lang")
    assert _rows(got) == _rows(want)
    assert len(slices) > 2 and slices == [(i, len(slices)) for i in range(len(slices))]
    assert [len(x) for x in seen] == [1] * len(slices)


@pytest.mark.parametrize("large", [("p_name",), ("has_doc",), ("p_name", "has_doc")])
def test_posts_are_not_shuffled_when_parts_or_documents_are_many(spark, shop, monkeypatch, large):
    want = _rows(views.pages(spark, shop))
    joins = sys.modules["tidewater.operators.joins"]
    monkeypatch.setattr(joins, "fits", lambda small, *a: not set(large) & set(small.columns), raising=False)
    monkeypatch.setattr(joins, "measured", lambda small: (10**9 if set(large) & set(small.columns) else 1, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = views.pages(spark, shop)
        plan = _plan(found)
        assert _rows(found) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(l_orderkey#") == 1, plan


def test_labels_are_assigned_from_one_reading_of_the_pages(spark, shop, monkeypatch):
    """Vocabulary, co-occurrence and label sets read the stored names; the sets are stored too."""
    tags, plans, staged = [], [], catalog.staged

    def seen(df, tag):
        tags.append(tag)
        plans.append(_plan(df))
        return staged(df, tag)

    monkeypatch.setattr(catalog, "staged", seen)
    monkeypatch.setattr(sys.modules["tidewater.session"], "staged", seen)
    monkeypatch.setattr(catalog, "K", 1)
    found = catalog.q_assign_labels(spark, shop)
    assert tags == ["names", "sets"]
    reads = [p.count("struct<data:array<struct") for p in [*plans, _plan(found)]]
    assert reads == [1, 0, 0], reads
    vocab = catalog._vocab(spark, shop)
    eligible = posts.eligible_posts(catalog._posts(spark, shop))
    names = [r["n"] for r in eligible.select(catalog.names_of("context_annotations").alias("n")).collect()]
    want = {"\x01".join(sorted(set(n))) for n in names if not set(n) & set(vocab)}
    assert {r["set_key"]: r["assigned"] for r in found.collect()} == {k: vocab[0] for k in want} and want
