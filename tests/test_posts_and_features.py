"""Hand-made nested pages: the edge cases of the feature path."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.functions.arrays import array_count, external_url_count, media_count, names_of
from tidewater.functions.text import clean_name, clean_name_py, sentiment_score, text_length
from tidewater.functions.time import local_hour, parse_ts
from tidewater.operators import labels, posts
from tidewater.plans.features import build_features
from tidewater.sources.readers import read_pages


def ann(*names):
    return [{"domain": {"name": "D"}, "entity": {"name": n}} for n in names]


def post(pid, author, labels_, text="hello", created="2023-01-05T03:04:05.000Z", urls=None, hashtags=None,
         mentions=None, entities=True, impressions=10):
    p = {
        "id": pid, "author_id": author, "text": text, "created_at": created, "lang": "en",
        "context_annotations": labels_,
        "public_metrics": {"impression_count": impressions, "like_count": 1, "quote_count": 0,
                           "reply_count": 0, "retweet_count": 0},
    }
    if entities:
        p["entities"] = {"hashtags": hashtags, "mentions": mentions, "urls": urls}
    return p


def user(uid, followers):
    return {"id": uid, "public_metrics": {"followers_count": followers, "following_count": 1,
                                          "listed_count": 0, "tweet_count": 5}}


PAGES = [
    {"__twarc": {"retrieved_at": "2023-01-01T00:00:00.000Z"}, "data": None, "includes": {"users": [user("u9", 1)]}},
    {"__twarc": {"retrieved_at": "2023-01-01T00:00:00.000Z"}, "data": [], "includes": {"users": [user("u9", 1)]}},
    {
        "__twarc": {"retrieved_at": "2023-01-02T00:00:00.000Z"},
        "data": [
            post("p1", "u1", ann("Politics", "Politics", "Jean-Luc Mélenchon"), text="not good \U0001F600",
                 urls=[{"url": "a", "media_key": "3_1"}, {"url": "b", "media_key": None}, {"url": "c", "media_key": ""}],
                 hashtags=[{"tag": "x"}], mentions=[{"username": "m"}, {"username": "n"}]),
            post("p2", "u1", ann("Politics", "Sport"), created="2023-01-05T23:30:00.000Z"),
            post("p3", "u1", ann("Zebra"), entities=False),
            post("p4", "u1", None),
        ],
        "includes": {"users": [user("u1", 100), user("u2", 7), user("u3", 8)]},
    },
    {
        "__twarc": {"retrieved_at": "2023-01-03T00:00:00.000Z"},
        "data": [
            post("p5", "u1", ann("Sport", "Hip-Hop")),
            post("p6", "u1", []),
            post("p7", "u1", ann("Unknown", "Sport")),
        ],
        "includes": {"users": [user("u1", 150)]},
    },
    {
        "__twarc": {"retrieved_at": "2023-01-03T00:00:00.000Z"},
        "data": [post("p8", "u4", ann("Other", "Rare"))],
        "includes": {"users": [user("u4", 3)]},
    },
]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pages") / "pages.jsonl"
    path.write_text("\n".join(json.dumps(p) for p in PAGES) + "\n")
    return read_pages(spark, str(path))


def test_null_and_empty_pages_give_no_posts(pages):
    assert posts.posts(pages).count() == 8


def test_label_counts_once_per_post_and_ties_alphabetical(pages):
    counts = {r.label: r.cnt for r in labels.label_counts(posts.posts(pages)).collect()}
    assert counts["Politics"] == 2  # twice in p1, counted once
    assert counts["Sport"] == 3
    top = labels.top_labels(posts.posts(pages), 3).orderBy("idx").collect()
    assert [r.label for r in top] == ["Sport", "Politics", "Hip-Hop"]  # ties (1) broken by label
    assert [r.idx for r in top] == [0, 1, 2]


def test_eligibility(pages):
    ids = {r.id for r in posts.eligible_posts(posts.posts(pages)).collect()}
    assert ids == {"p1", "p2", "p5", "p6", "p7", "p8"}  # no entities (p3), null annotations (p4) dropped


def test_url_counts_and_null_arrays(pages):
    rows = {
        r.id: r
        for r in posts.posts(pages).select(
            "id",
            media_count(F.col("entities.urls")).alias("media"),
            external_url_count(F.col("entities.urls")).alias("ext"),
            array_count(F.col("entities.hashtags")).alias("tags"),
            array_count(F.col("entities.mentions")).alias("ments"),
        ).collect()
    }
    assert (rows["p1"].media, rows["p1"].ext, rows["p1"].tags, rows["p1"].ments) == (1, 2, 1, 2)
    assert (rows["p2"].media, rows["p2"].ext, rows["p2"].tags, rows["p2"].ments) == (0, 0, 0, 0)


def test_hour_wrap(spark):
    df = spark.createDataFrame([("2023-01-05T03:04:05.000Z",), ("2023-01-05T23:30:00.000Z",)], "t string")
    got = [r.h for r in df.select(local_hour(parse_ts("t"), -5).alias("h")).collect()]
    assert got == [22, 18]
    got = [r.h for r in df.select(local_hour(parse_ts("t"), 1).alias("h")).collect()]
    assert got == [4, 0]


def test_length_counts_code_points(spark):
    df = spark.createDataFrame([("not good \U0001F600",)], "t string")
    assert df.select(text_length("t").alias("n")).first().n == 10


def test_name_cleaning_and_collisions(spark):
    assert clean_name_py("Jean-Luc Mélenchon") == "jeanlucmlenchon"
    assert clean_name_py("a__b___c") == "a_b__c"
    df = spark.createDataFrame([("Jean-Luc Mélenchon",), ("a__b___c",)], "s string")
    assert [r.c for r in df.select(clean_name("s").alias("c")).collect()] == ["jeanlucmlenchon", "a_b__c"]
    names = labels.dummy_names(["Hip-Hop", "HipHop", "Sport"])
    assert names == {"dummy_hiphop": ["Hip-Hop", "HipHop"], "dummy_sport": ["Sport"]}


def test_multi_hot_and_dummies(spark):
    df = spark.createDataFrame([(["a", "zz"],), (None,)], "l array<string>")
    rows = df.select(labels.multi_hot("l", ["a", "b"]).alias("m"), *labels.dummy_columns("l", ["a", "b"])).collect()
    assert rows[0].m == [1, 0] and rows[1].m == [0, 0]
    assert (rows[0].dummy_a, rows[0].dummy_b, rows[1].dummy_a) == (1, 0, 0)


def test_sentiment_rules(spark):
    df = spark.createDataFrame(
        [("good",), ("not good",), ("very good",), ("slightly bad",), ("nothing here",), ("",)], "t string"
    )
    got = [r.s for r in df.select(sentiment_score("t").alias("s")).collect()]
    s = 1.9
    assert got[0] == pytest.approx(s / (s * s + 15) ** 0.5)
    s = 1.9 * -0.74
    assert got[1] == pytest.approx(s / (s * s + 15) ** 0.5)
    s = 1.9 + 0.293
    assert got[2] == pytest.approx(s / (s * s + 15) ** 0.5)
    s = -2.5 + 0.293  # a dampener moves a negative valence towards zero
    assert got[3] == pytest.approx(s / (s * s + 15) ** 0.5)
    assert got[4] == 0.0 and got[5] == 0.0


def test_fallback_assignment(spark):
    scores = spark.createDataFrame(
        [("k1", "a", 0.5), ("k1", "b", 0.4), ("k1", "c", 0.1), ("k2", "a", 0.2), ("k2", "b", 0.2), ("k2", "c", 0.6),
         ("k3", "a", 0.25), ("k3", "b", 0.25), ("k3", "c", 0.25), ("k3", "d", 0.25)],
        "set_key string, label string, score double",
    )
    got = {r.set_key: r.assigned for r in labels.assign_labels(scores, 0.3).collect()}
    assert got == {"k1": ["a", "b"], "k2": ["c"], "k3": ["a"]}  # none above: best, ties by label


def test_group_labels_known_and_fallback(pages):
    vocab = ["Sport", "Politics"]
    eligible = posts.eligible_posts(posts.posts(pages))
    got = {r.id: r.labels for r in labels.group_labels(eligible, vocab).collect()}
    assert got["p1"] == ["Politics"]
    assert got["p5"] == ["Sport"]
    # empty annotations and unknown-only labels take the fallback labeller
    assert got["p6"] is not None and len(got["p6"]) >= 1
    assert got["p8"] is not None and set(got["p8"]) <= set(vocab)


def test_followers_first_user_latest_page(pages):
    f = {r.user_id: r.followers_count for r in posts.dedup_users(posts.page_users(pages)).collect()}
    assert f == {"u1": 150, "u4": 3}  # u9's pages hold no posts; u2/u3 are not first users
    f_all = {r.user_id for r in posts.page_users(pages, "all").collect()}
    assert {"u2", "u3"} <= f_all


def test_fanout_without_dedup(pages):
    fan = posts.posts_with_authors(pages, dedup=False).filter(F.col("id") == "p1").count()
    one = posts.posts_with_authors(pages, dedup=True).filter(F.col("id") == "p1").count()
    assert (fan, one) == (2, 1)


def test_build_features_layout(pages):
    f = build_features(pages, k=2)
    cols = f.columns
    assert cols[-1] == "followers_count"
    assert cols[:-1] == sorted(cols[:-1])
    assert {"dummy_sport", "dummy_politics", "tweet_sentiment", "tweet_length", "tweet_period"} <= set(cols)
    rows = {r.tweet_text: r for r in f.collect()}
    assert f.count() == 6
    # hand check of p1 against the same computation by the by_text path
    g = build_features(pages, k=2, by_text=True)
    assert sorted(map(tuple, g.select(*cols).collect())) == sorted(map(tuple, f.collect()))
    assert rows["not good \U0001F600"].tweet_medias_count == 1


def test_invariants_multi_hot_sum_and_urls(pages):
    vocab = ["Sport", "Politics", "Hip-Hop"]
    p = posts.posts(pages).select(names_of("context_annotations").alias("l"), F.col("entities.urls").alias("u"))
    rows = p.select(
        F.aggregate(labels.multi_hot("l", vocab), F.lit(0), lambda a, x: a + x).alias("s"),
        F.size(labels.known_labels("l", vocab)).alias("k"),
        (media_count("u") + external_url_count("u")).alias("mu"),
        array_count("u").alias("n"),
    ).collect()
    for r in rows:
        assert r.mu == r.n
        assert r.s == (r.k if r.k is not None and r.k >= 0 else 0)


def test_pluggable_scorer_runs_in_pandas(pages):
    import pandas as pd

    def last_label_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for key, cands in zip(pdf["set_key"], pdf["candidates"]):
            best = sorted(cands)[-1]
            rows += [(key, c, 1.0 if c == best else 0.0) for c in cands]
        return pd.DataFrame(rows, columns=["set_key", "label", "score"])

    vocab = ["Sport", "Politics"]
    eligible = posts.eligible_posts(posts.posts(pages))
    got = {r.id: r.labels for r in labels.group_labels(eligible, vocab, scorer=last_label_scorer).collect()}
    assert got["p6"] == ["Sport"] and got["p8"] == ["Sport"]
    assert got["p1"] == ["Politics"]


def test_single_post_lines(spark, tmp_path):
    line = {"data": post("s1", "u7", ann("X"), text="hi"), "includes": {"users": [user("u7", 42)]}}
    line_fr = {"data": dict(post("s2", "u8", ann("X")), lang="fr"), "includes": {"users": [user("u8", 1)]}}
    path = tmp_path / "sample.jsonl"
    path.write_text(json.dumps(line) + "\n" + json.dumps(line_fr) + "\n")
    lines = read_pages(spark, str(path), single=True)
    rows = posts.sample_posts(lines, "en").collect()
    assert [(r.id, r.followers_count, r.impression_count) for r in rows] == [("s1", 42, 10)]


def test_lexicon_table_scores_like_the_fold(spark):
    """A table of 10,000 words gives the fold's scores, broadcast or salted, with the same plan size."""
    import random

    from tidewater.functions.text import DEFAULT_LEXICON, sentiment_score
    from tidewater.operators.sentiment import lexicon_scores

    rng = random.Random(1)
    words = ["not", "never", "very", "slightly", "so", "table", "the"] + rng.sample(sorted(DEFAULT_LEXICON), 25)
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(80)] + [(90, None), (91, ""), (92, "GOOD!! not good")]
    docs = spark.createDataFrame(texts, "id long, text string")
    rows = list(DEFAULT_LEXICON.items())
    small = spark.createDataFrame(rows, "word string, valence double")
    large = spark.createDataFrame(rows + [(f"w{i}", 1.0) for i in range(10_000)], "word string, valence double")
    want = {r.id: r.s or 0.0 for r in docs.select("id", sentiment_score("text").alias("s")).collect()}
    sizes = []
    for lexicon, limit in ((small, 10**6), (large, 10**6), (large, 10)):
        scored = lexicon_scores(docs, lexicon, max_rows=limit)
        got = {r.id: r.sentiment for r in scored.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
        sizes.append(len(scored._jdf.queryExecution().optimizedPlan().toString()))
    assert max(sizes) - min(sizes) < 200


def test_variant_leaves_of_nested_and_odd_schemas(spark, tmp_path):
    from tidewater.sources.readers import captured_drift, captured_schema, variant_leaves

    lines = ['{"a": 1, "b": {"c": [1.5, 2.5], "d e": "x"}}', '{"a": "s", "b": {}}', "not json", '{"l": [{"m": true}, {"n": null}]}', "[]", "3", None]
    docs = spark.createDataFrame([("f1", lines[0]), ("f1", lines[2]), ("f2", lines[1]), ("f2", lines[3]), ("f3", lines[6])], "source_file string, value string")
    captured = captured_schema(docs)
    found = {(r.source_file, r.leaf): r.type for r in captured.collect()}
    assert found["f1", "a"] == "BIGINT" and found["f2", "a"] == "STRING" and found["f1", "b.d e"] == "STRING"
    assert found["f1", "b.c[]"].startswith("DECIMAL") and found["f2", "l[].m"] == "BOOLEAN" and found["f2", "l[].n"] == "VOID"
    drift = {(r.leaf, r.type): (r.n_groups, r.everywhere) for r in captured_drift(captured).collect()}
    assert drift["a", "BIGINT"] == (1, False)
    assert variant_leaves("ARRAY<OBJECT<`x, y`: DECIMAL(3,1), z: ARRAY<STRING>>>") == [("[].x, y", "DECIMAL(3,1)"), ("[].z[]", "STRING")]


def test_text_scorer_prefers_shared_rare_words(spark):
    from tidewater.operators import labels

    sets = spark.createDataFrame([("1", ["red car", "fast"]), ("2", ["blue"]), ("3", ["red"]), ("4", [])], "set_key string, labels array<string>")
    vocab = ["Red wine", "car", "tree"]
    scores = {(r.set_key, r.label): r.score for r in labels.score_labels(sets, vocab, scorer=labels.text_scorer(sets, vocab)).collect()}
    assert abs(sum(scores["1", v] for v in vocab) - 1) < 1e-12 and scores["1", "car"] > scores["1", "Red wine"] > scores["1", "tree"] == 0
    assert scores["2", "car"] == scores["4", "tree"] == 1 / 3 and scores["3", "Red wine"] == 1


def test_dummies_and_sorted_labels_make_no_set_and_call_no_comparator(spark):
    from tidewater.operators import labels as L

    vocab = ["Big Box", "big box", "red"]
    rows = [(["red", "x"],), (["big box"],), ([],), (None,), (["x", None],), (["red", None, "Big Box"],)]
    df = spark.createDataFrame(rows, "v array<string>")
    out = df.select(*L.dummy_columns("v", vocab), L.known_labels("v", vocab).alias("known"), L.set_key(F.col("v")).alias("key"))
    old = df.select(
        *[F.arrays_overlap(F.coalesce("v", F.array().cast("array<string>")), F.array(*map(F.lit, m))).cast("int").alias(n) for n, m in L.dummy_names(vocab).items()],
        F.array_sort(F.array_intersect("v", F.array(*map(F.lit, vocab)))).alias("known"),
        F.array_join(F.array_sort(F.array_distinct("v")), "\u0001").alias("key"),
    )
    assert out.collect() == old.collect() and len(out.columns) == len(old.columns)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" not in plan and "array_sort" not in plan and "lambda" not in plan
