"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Each reads the driver tables (through the shaped views of ``views``) over
their whole extent.  Float outputs are rounded so that an independent SQL
engine can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import array_count, external_url_count, first_element, media_count, media_keys, names_of
from ..functions.text import clean_name, sentiment_score, star_label, text_length, tokens
from ..functions.time import between_time, local_hour, micros_of_day, parse_ts, serial_to_ts, to_zone
from ..operators import explore, labels, posts, regression, sentiment, ticks
from ..session import drop_files, drop_finished_shuffles, ensure_checkpoint_dir, staged
from ..sources import readers, sinks
from . import views
from .features import build_features
from .staged import log1p_all, staged_regression

K = 14
ROUND = 6
ALL_METRICS = ["following_count", "tweet_count", "retweet_count", "reply_count", "like_count", "quote_count", "impression_count"]
METRICS = ["retweet_count", "reply_count", "like_count", "quote_count", "impression_count"]


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.stored_pages(spark, sf_dir)


def _pages_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pages(spark, sf_dir)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.posts(_pages(spark, sf_dir), keep=("page_id",))


def _posts_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.with_texts(_posts(spark, sf_dir), sf_dir)
    return posts.posts(_pages_with_text(spark, sf_dir), keep=("page_id",)) if found is None else found


def _vocab(spark: SparkSession, sf_dir: str) -> list[str]:
    return labels.vocabulary(_posts(spark, sf_dir), K)


def _scratch(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidewater-{name}-{spark.sparkContext.applicationId}"


# ---------------------------------------------------------------- labels
def q_label_counts(spark, sf_dir):
    return labels.label_counts(_posts(spark, sf_dir))


def q_top_labels(spark, sf_dir):
    return labels.top_labels(_posts(spark, sf_dir), K)


def q_label_index(spark, sf_dir):
    return labels.top_labels(_posts(spark, sf_dir), K).select("label", "idx")


# ---------------------------------------------------------------- posts
def q_explode_posts(spark, sf_dir):
    return _posts(spark, sf_dir).select("page_id", "id", "author_id", "created_at", "lang")


def q_project_posts(spark, sf_dir):
    """All nine fields, the nested ones as text."""
    p = posts.project_posts(_posts_with_text(spark, sf_dir))
    return p.select(
        "tweet_id", "user_id", "tweet_date", "impression_count", "tweet_text",
        F.coalesce(F.array_join("tweet_hashtags.tag", ","), F.lit("")).alias("hashtags"),
        F.coalesce(F.array_join("tweet_mentions.username", ","), F.lit("")).alias("mentions"),
        F.coalesce(F.array_size("tweet_urls"), F.lit(0)).cast("long").alias("n_urls"),
        F.array_join(F.array_sort(names_of("context_annotations")), ",").alias("annotations"),
    )


def q_project_metrics(spark, sf_dir):
    return posts.project_metrics(_posts(spark, sf_dir))


def q_eligible_posts(spark, sf_dir):
    return posts.eligible_posts(_posts(spark, sf_dir)).select("id", "author_id")


def q_by_language(spark, sf_dir):
    return posts.by_language(_posts(spark, sf_dir), "fr").select("id", "author_id", "lang")


def q_first_user(spark, sf_dir):
    pg = _pages(spark, sf_dir)
    return pg.select("page_id", first_element(F.col("includes.users")).alias("user")).filter(F.col("user").isNotNull()).select(
        "page_id", F.col("user.id").alias("user_id"), F.col("user.public_metrics.followers_count").alias("followers_count")
    )


def q_sample_posts(spark, sf_dir):
    lines = _pages(spark, sf_dir).select(F.explode("data").alias("data"), "includes")
    return posts.sample_posts(lines, "en")


def q_project_authors(spark, sf_dir):
    return posts.project_authors(posts.first_user(_pages(spark, sf_dir)))


# ---------------------------------------------------------------- joins / dedup
def q_dedup_users(spark, sf_dir):
    return posts.dedup_users(posts.page_users(_pages(spark, sf_dir)))


def q_attach_followers(spark, sf_dir):
    pg = _pages(spark, sf_dir)
    feats = posts.project_posts(posts.posts(pg), text=False).select("tweet_id", "user_id", "impression_count")
    return posts.attach_followers(feats, posts.dedup_users(posts.page_users(pg)))


def q_posts_with_authors(spark, sf_dir):
    return posts.posts_with_authors(_pages(spark, sf_dir), dedup=True)


def q_posts_with_authors_fanout(spark, sf_dir):
    return posts.posts_with_authors(_pages(spark, sf_dir), dedup=False)


def q_known_labels(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    p = _posts(spark, sf_dir)
    known = labels.known_labels(names_of("context_annotations"), vocab)
    return p.select("id", F.array_join(known, ",").alias("known"), F.coalesce(F.size(known), F.lit(0)).alias("n_known"))


# ---------------------------------------------------------------- scalar features
def q_array_counts(spark, sf_dir):
    p = _posts(spark, sf_dir)
    return p.select(
        "id",
        array_count(F.col("entities.hashtags")).alias("hashtags_count"),
        array_count(F.col("entities.mentions")).alias("mentions_count"),
        array_count(F.col("entities.urls")).alias("urls_count"),
    )


def q_media_counts(spark, sf_dir):
    p = _posts(spark, sf_dir)
    urls = F.col("entities.urls")
    return p.select(
        "id",
        array_count(media_keys(urls)).alias("n_media_keys"),
        media_count(urls).alias("tweet_medias_count"),
        external_url_count(urls).alias("tweet_external_urls_count"),
    )


def q_text_length(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", text_length("text").alias("tweet_length"))


def q_local_hour(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    parsed = parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return ev.select("event_id", local_hour(parsed, -5).alias("hour_us"), local_hour(parsed, 1).alias("hour_eu"))


def q_day_part_dummies(spark, sf_dir):
    from ..functions.time import day_part_dummies

    ev = views.table(spark, sf_dir, "events")
    hour = local_hour(F.col("ts").cast("timestamp"), -5)
    return ev.select("event_id", *day_part_dummies(hour))


def q_dataset_name(spark, sf_dir):
    from ..functions.text import dataset_name

    li = views.table(spark, sf_dir, "lineitem").select(dataset_name(F.col("_metadata.file_path")).alias("dataset"))
    return li.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def q_scan_glob(spark, sf_dir):
    """Line items in monthly files, read back as one table by a pattern, with the month of each row's file."""
    base = _scratch(spark, "lineitem-months")
    src = views.table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    src.repartition("month").write.mode("overwrite").partitionBy("month").parquet(base)
    found = readers.scan_glob(spark, f"{base}/month=*/part-*.parquet")
    return found.withColumn("month", F.regexp_extract("source_file", r"month=([0-9-]+)/", 1)).drop("source_file")


def q_parse_ts(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    parsed = parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return ev.select("event_id", F.unix_micros(parsed).alias("ts_micros"))


# ---------------------------------------------------------------- encodings and label grouping
def q_multi_hot(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    p = _posts(spark, sf_dir)
    mh = labels.multi_hot(names_of("context_annotations"), vocab)
    return p.select("id", F.array_join(F.transform(mh, lambda x: x.cast("string")), "").alias("multi_hot"))


def q_dummy_columns(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    p = _posts(spark, sf_dir)
    wide = p.select("id", *labels.dummy_columns(names_of("context_annotations"), vocab))
    names = wide.columns[1:]
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("int").alias("x")) for n in names]))
    return wide.select("id", cells.alias("c")).select("id", "c.name", "c.x")


def q_clean_name(spark, sf_dir):
    p = _posts(spark, sf_dir)
    names = p.select(F.explode(F.array_union(names_of("context_annotations"), names_of("context_annotations", "domain"))).alias("label"))
    return names.distinct().select("label", clean_name("label").alias("clean"))


def _fallback_sets(spark, sf_dir):
    """Vocabulary, eligible posts (their label names) and the label sets without a known label.

    The names of all posts are written once; each step reads those and not the nested pages.
    """
    p = _posts(spark, sf_dir)
    eligible = F.col("entities").isNotNull() & F.col("context_annotations").isNotNull()
    names = staged(p.select(names_of("context_annotations").alias("names"), eligible.alias("eligible")), "names")
    vocab = labels.vocabulary(names, K, names_col="names")
    p = names.filter("eligible")
    sets = p.select(F.col("names").alias("labels")).filter(F.size(labels.known_labels(F.col("labels"), vocab)) == 0)
    return vocab, p, sets.select(labels.set_key(F.col("labels")).alias("set_key"), "labels")


def q_score_labels(spark, sf_dir):
    vocab, p, sets = _fallback_sets(spark, sf_dir)
    scores = labels.score_labels(sets, vocab, labels.cooccurrence(p, vocab, names_col="names"))
    return scores.select("set_key", "label", F.round("score", ROUND).alias("score"))


def q_score_labels_by_text(spark, sf_dir):
    """The pluggable scorer: words of a label set against words of each label."""
    vocab, _, sets = _fallback_sets(spark, sf_dir)
    scores = labels.score_labels(sets, vocab, scorer=labels.text_scorer(sets, vocab))
    return scores.select("set_key", "label", F.round("score", ROUND).alias("score"))


def q_assign_labels(spark, sf_dir):
    vocab, p, sets = _fallback_sets(spark, sf_dir)
    assigned = labels.assign_labels(labels.score_labels(sets, vocab, labels.cooccurrence(p, vocab, names_col="names")))
    return assigned.select("set_key", F.array_join("assigned", ",").alias("assigned"))


def q_group_labels(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    p = posts.eligible_posts(_posts(spark, sf_dir)).select("id", "context_annotations")
    return labels.group_labels(p, vocab, checkpoint=True).select("id", F.array_join("labels", ",").alias("labels"))


# ---------------------------------------------------------------- sentiment and features
def q_lexicon_sentiment(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.round(sentiment_score(F.col("text")), ROUND).alias("sentiment"))


def q_lexicon_table(spark, sf_dir):
    """Sentiment of all documents with a lexicon made from their own words (about a third of them)."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    place = F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("int")
    words = docs.select(F.explode(tokens("text")).alias("word")).distinct().select("word", place.alias("place"))
    lexicon = words.where(F.col("place") % 3 == 0).select("word", ((F.col("place") % 41 - 20) / 5).alias("valence"))
    scores = sentiment.lexicon_scores(docs, staged(lexicon, "lexicon"), "doc_id", "text")
    return scores.select("doc_id", (F.round("sentiment", ROUND) + 0.0).alias("sentiment"))


def q_schema_capture(spark, sf_dir):
    """Schemas found in JSON lines of three layouts, one for each order status, and where they differ."""
    o = views.table(spark, sf_dir, "orders")
    status, key, price = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)")
    line = (
        F.when(status == "F", F.to_json(F.struct(key.alias("key"), F.struct(price.alias("price"), F.col("o_custkey").alias("cust")).alias("sum"))))
        .when(status == "O", F.to_json(F.struct(key.alias("key"), F.array(F.struct(F.col("o_orderpriority").alias("name"))).alias("tags"))))
        .otherwise(F.to_json(F.struct(key.cast("string").alias("key"), F.struct(F.col("o_custkey").alias("cust")).alias("sum"))))
    )
    path = _scratch(spark, f"orders-lines-{uuid.uuid4().hex}")
    o.select(status.alias("layout"), line.alias("value")).write.partitionBy("layout").text(path)
    lines = spark.read.text(path)
    found = readers.captured_schema(lines, "layout")
    return readers.captured_drift(found.withColumn("type", F.regexp_replace("type", r"\(.*", "")), "layout")


def _features(spark, sf_dir):
    # Post texts repeat in this data (several lines share a document), so each
    # distinct text is scored once and joined back.
    return build_features(
        _pages(spark, sf_dir), k=K, vocab=_vocab(spark, sf_dir), by_text=True, keep_text=False,
        post_df=_posts_with_text(spark, sf_dir),
    )


def q_build_features(spark, sf_dir):
    f = _features(spark, sf_dir).withColumn("tweet_sentiment", F.round("tweet_sentiment", ROUND))
    dummies = sorted(c for c in f.columns if c.startswith("dummy_"))
    text = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in dummies])
    return f.select(text.alias("dummies"), *[c for c in f.columns if c not in dummies])


# ---------------------------------------------------------------- transforms and summaries
def _metrics(spark, sf_dir):
    return posts.project_metrics(_posts(spark, sf_dir))


def q_log1p_all(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    logged = log1p_all(m.select("id", *METRICS), METRICS)
    return logged.select("id", *[F.round(c, ROUND).alias(c) for c in METRICS])


def q_expm1_col(spark, sf_dir):
    m = log1p_all(_metrics(spark, sf_dir).select("id", "impression_count"), ["impression_count"])
    return m.select("id", F.round(F.expm1("impression_count"), 3).alias("impression_count"))


def q_threshold(spark, sf_dir):
    return posts.threshold(_metrics(spark, sf_dir), "impression_count", lo=100).select("id", "impression_count")


def q_threshold_range(spark, sf_dir):
    m = posts.threshold(_metrics(spark, sf_dir), "impression_count", lo=5_000, hi=20_000)
    return m.select("id", "impression_count")


def q_rename_cast_select(spark, sf_dir):
    """Positional rename, casts that give NULL where a value does not convert, a subset of columns."""
    m = _metrics(spark, sf_dir).select("id", "author_id", "like_count")
    m = posts.cast_columns(posts.rename(m, ["post", "author", "likes"]), ["author", "likes"], "int")
    m = posts.cast_columns(m.withColumn("number", F.col("post")), ["number"], "int")
    return posts.select_terms(m, ["author", "number"], "likes")


#: Bytes of JSON text that are on disk at once, before their compression.
JSON_SLICE_BYTES = 2 << 30
MAX_JSON_SLICES = 64


def _json_slices(spark, sf_dir) -> int:
    """Into how many slices of the orders pages with texts are cut (600 bytes of a post besides its text)."""
    length = views.table(spark, sf_dir, "documents").agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    size = views.table(spark, sf_dir, "lineitem").count() * (length + 600)
    return min(MAX_JSON_SLICES, max(1, -(-int(size) // JSON_SLICE_BYTES)))


def q_json_pages(spark, sf_dir):
    """Pages written as JSON lines and scanned with the fixed schema: posts per page.

    A text is on many posts, so the lines of all pages are far more than the tables.  They are
    written in slices of the orders; a slice is read back and goes before the next.
    """
    n = _json_slices(spark, sf_dir)
    found = None
    for i in range(n):
        path = _scratch(spark, f"pages-json-{uuid.uuid4().hex}")
        views.pages(spark, sf_dir, part_of=(i, n) if n > 1 else None).drop("page_id").write.option("compression", "lz4").json(path)
        drop_finished_shuffles(spark)
        back = readers.read_pages(spark, path)
        some = staged(posts.posts(back).select("id", "author_id", "created_at", "lang"), "json-posts")
        drop_files(spark, path)
        found = some if found is None else found.unionByName(some)
    return found


def q_hash_split(spark, sf_dir):
    """Place and part of every post, a fifth of the places for validation."""
    m = _metrics(spark, sf_dir)
    place = regression.split_place(F.col("id"))
    part = F.when(place < regression.split_cut(0.2), F.lit("validation")).otherwise(F.lit("train"))
    return m.select("id", place.alias("place"), part.alias("split"))


def q_summary_stats(spark, sf_dir):
    s = explore.summary_stats(_metrics(spark, sf_dir), "impression_count")
    return s.select("n", "min_value", "max_value", F.round("stddev_pop", 4).alias("stddev_pop"))


def _authored(spark, sf_dir):
    return posts.posts_with_authors(_pages(spark, sf_dir), dedup=True)


def q_metric_series(spark, sf_dir):
    return explore.metric_series(_authored(spark, sf_dir), "followers_count", ALL_METRICS)


def q_metric_regressions(spark, sf_dir):
    r = explore.metric_regressions(_authored(spark, sf_dir), "followers_count", ALL_METRICS)
    return r.select("metric", "n", *[(F.round(c, ROUND) + 0.0).alias(c) for c in ("slope", "intercept", "r2")])


def q_metric_regressions_few_views(spark, sf_dir):
    """The same for posts below the first decile of impressions."""
    few = posts.threshold(_authored(spark, sf_dir), "impression_count", hi=10_000)
    r = explore.metric_regressions(few, "followers_count", ALL_METRICS)
    return r.select("metric", "n", *[(F.round(c, ROUND) + 0.0).alias(c) for c in ("slope", "intercept", "r2")])


def q_metric_regressions_log(spark, sf_dir):
    r = explore.metric_regressions(_authored(spark, sf_dir), "followers_count", ALL_METRICS, log=True)
    return r.select("metric", "n", *[(F.round(c, ROUND) + 0.0).alias(c) for c in ("slope", "intercept", "r2")])


def q_log_histogram(spark, sf_dir):
    return explore.log_histogram(_authored(spark, sf_dir), ALL_METRICS + ["followers_count"])


# ---------------------------------------------------------------- regression
def _two_regressor_fit(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    return m, regression.ols(m, "impression_count", ["like_count", "reply_count"])


def q_ols_coef(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    c = fit.coef_df(spark)
    return c.select("term", *[F.round(x, 4).alias(x) for x in ("coef", "std_err", "t")])


def q_ols_fit(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    keep = ["nobs", "df_model", "df_resid", "r_squared", "adj_r_squared", "f_statistic", "log_likelihood", "aic", "bic"]
    return fit.fit_df(spark).filter(F.col("stat").isin(keep)).select("stat", F.round("value", 4).alias("value"))


def q_ols_inference(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    c = fit.coef_df(spark)
    return c.select("term", *[F.round(x, 4).alias(x) for x in c.columns if x != "term"])


def q_significant_terms(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    return spark.createDataFrame([(t,) for t in regression.significant_terms(fit)], "term string")


def q_discarded_terms(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    return spark.createDataFrame([(regression.discarded(fit, regression.significant_terms(fit)),)], "n int")


def q_holdout_score(spark, sf_dir):
    """Fit on the train part of the split, errors on its validation part."""
    train, valid = regression.hash_split(_metrics(spark, sf_dir), "id", 0.2)
    found = regression.score(valid, regression.ols(train, "impression_count", ["like_count", "reply_count"]))
    rows = [(k, float(found[k])) for k in ("n", "mse", "rmse")]
    return spark.createDataFrame(rows, "stat string, value double").withColumn("value", F.round("value", 3))


def q_durbin_watson(spark, sf_dir):
    """In the order of the post id; posts that share one in the order of their residuals."""
    m, fit = _two_regressor_fit(spark, sf_dir)
    value = regression.durbin_watson(m, fit, ["id"])
    return spark.createDataFrame([(value,)], "durbin_watson double").withColumn("durbin_watson", F.round("durbin_watson", 4))


def q_predict_score(spark, sf_dir):
    m, fit = _two_regressor_fit(spark, sf_dir)
    return regression.predict(m.select("id", "impression_count", "like_count", "reply_count"), fit).select(
        "id", F.round("prediction", 4).alias("prediction")
    )


def q_actual_vs_predicted(spark, sf_dir):
    m, fit = _two_regressor_fit(spark, sf_dir)
    return explore.actual_vs_predicted(m, "impression_count", F.round(fit.prediction(), 4))


def q_staged_coefficients(spark, sf_dir):
    res = staged_regression(_features(spark, sf_dir))
    return res.coef_df(spark)


def q_staged_fit(spark, sf_dir):
    res = staged_regression(_features(spark, sf_dir))
    return res.fit_df(spark)


def _staged_small(spark, sf_dir):
    """All four stages on two regressors, split by the post id and in its order."""
    m = _metrics(spark, sf_dir).select("id", "like_count", "reply_count", "impression_count")
    return staged_regression(m, split_key="id", order_by="id")


def q_staged_small_fit(spark, sf_dir):
    """Every statistic of every stage but the p-values, as seven significant digits and an exponent."""
    rows = _staged_small(spark, sf_dir).fit_df(spark).where(~F.col("stat").endswith("pvalue") & ~F.isnan("value"))
    exponent = F.when(F.col("value") == 0, 0).otherwise(F.floor(F.log10(F.abs("value")))).cast("int")
    rows = rows.withColumn("exponent", exponent)
    return rows.select("stage", "stat", "exponent", F.round(F.col("value") / F.pow(F.lit(10.0), "exponent"), 6).alias("digits"))


def q_staged_small_coefficients(spark, sf_dir):
    c = _staged_small(spark, sf_dir).coef_df(spark)
    return c.select("stage", "term", F.round("coef", 5).alias("coef"), F.round("std_err", 5).alias("std_err"), F.round("t", 4).alias("t"))


def q_staged_small_holdout(spark, sf_dir):
    return _staged_small(spark, sf_dir).holdout_df(spark).withColumn("value", F.round("value", 4))


def q_model_summaries(spark, sf_dir):
    """All results of the stages stored under one version and read back; sums of the final table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/summaries-{uuid.uuid4().hex}"
    sinks.write_summaries(spark, _staged_small(spark, sf_dir), path)
    final = sinks.read_summaries(spark, path)["final"]
    total = lambda c: F.sum(c) if c in final.columns else F.lit(0.0)
    return final.agg(
        F.count(F.lit(1)).alias("n"),
        total("like_count").alias("sum_likes"),
        total("reply_count").alias("sum_replies"),
        F.sum("impression_count").alias("sum_impressions"),
    )


def q_coef_table(spark, sf_dir):
    _, fit = _two_regressor_fit(spark, sf_dir)
    c = regression.coef_table(fit, spark)
    return c.select(*[F.round(x, 4).alias(x) if x not in ("term", "label") else F.col(x) for x in c.columns])


def q_star_labels(spark, sf_dir):
    c = _two_regressor_fit(spark, sf_dir)[1].coef_df(spark)
    return c.select("term", star_label("term", "p_value").alias("label"))


# ---------------------------------------------------------------- ticks
def q_serial_to_ts(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    serial = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86400e6) + F.lit(25569)
    return ev.select("event_id", F.unix_micros(serial_to_ts(serial)).alias("ts_micros"))


def q_to_zone(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    local = to_zone(F.col("ts").cast("timestamp"), "America/New_York")
    return ev.select("event_id", F.unix_micros(local).alias("local_micros"))


def q_between_time(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    local = to_zone(F.col("ts").cast("timestamp"), "America/New_York")
    return ev.filter(between_time(local, "09:30:00", "16:00:00")).select("event_id", micros_of_day(local).alias("micros_of_day"))


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.unix_micros(F.col("ts")))


def q_clean_trades(spark, sf_dir):
    t = ticks.clean_trades(views.trades(spark, sf_dir))
    return _micros(t).select("ticker", "ts", F.round("trade_price", ROUND).alias("trade_price"), "trade_volume")


def q_clean_quotes(spark, sf_dir):
    return _micros(ticks.clean_quotes(views.quotes(spark, sf_dir)))


def q_build_events(spark, sf_dir):
    ev = ticks.build_events(views.trades(spark, sf_dir), views.quotes(spark, sf_dir))
    return _micros(ev).withColumn("trade_price", F.round("trade_price", ROUND)).withColumn("date", F.col("date").cast("string"))


def q_merge_events(spark, sf_dir):
    t = ticks.clean_trades(views.trades(spark, sf_dir))
    q = ticks.clean_quotes(views.quotes(spark, sf_dir))
    return _micros(ticks.merge_events(t, q)).withColumn("trade_price", F.round("trade_price", ROUND))


def q_concat_tables(spark, sf_dir):
    t = views.trades(spark, sf_dir)
    q = views.quotes(spark, sf_dir)
    return ticks.concat_tables([t, q]).select("ticker", "seq", "trade-price", "bid-price", "ask-price")


# ---------------------------------------------------------------- sources and sinks (round trips)
def q_csv_roundtrip(spark, sf_dir):
    from ..sources.readers import read_table
    from ..sources.sinks import write_table

    src = views.table(spark, sf_dir, "customer")
    path = _scratch(spark, "customer-csv")
    write_table(src, path, "csv", compression="gzip")
    return read_table(spark, path, "csv", schema=src.schema)


def q_json_checkpoint(spark, sf_dir):
    from ..sources.sinks import checkpoint_json

    src = _metrics(spark, sf_dir)
    return checkpoint_json(src, _scratch(spark, "metrics-json"))


def q_parquet_roundtrip(spark, sf_dir):
    path = _scratch(spark, "lineitem-parquet")
    sinks.write_table(views.table(spark, sf_dir, "lineitem"), path, "parquet", compression="zstd")
    return readers.read_table(spark, path, "parquet")


def q_arrow_roundtrip(spark, sf_dir):
    """Line items over many Arrow files and back, with whether each row names its file."""
    path = _scratch(spark, "lineitem-arrow")
    sinks.write_table(views.table(spark, sf_dir, "lineitem").repartition(32, "l_orderkey"), path, "arrow", compression="zstd")
    back = readers.read_table(spark, path, "arrow", with_file=True)
    return back.withColumn("named", F.col("source_file").endswith(".arrow")).drop("source_file")


def q_partitioned_events(spark, sf_dir):
    from ..sources.sinks import write_events

    ev = ticks.build_events(views.trades(spark, sf_dir), views.quotes(spark, sf_dir))
    path = _scratch(spark, "events-partitioned")
    write_events(ev, path)
    back = spark.read.parquet(path)
    return back.groupBy("ticker", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


def q_first_column(spark, sf_dir):
    from ..sources.readers import first_column, read_table
    from ..sources.sinks import write_table

    src = views.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_id"), "quality", "toxic")
    path = _scratch(spark, "labels-tsv")
    src.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    return first_column(read_table(spark, path, "tsv", schema="doc_id string, quality int, toxic int"))


def _mixed_files(spark, sf_dir):
    """Line items written as Parquet, CSV and Arrow files by order, and a table of all their paths and some that fail."""
    src = views.table(spark, sf_dir, "lineitem")
    base = _scratch(spark, f"lineitem-mixed-{uuid.uuid4().hex}")
    for i, fmt in enumerate(("parquet", "csv", "arrow")):
        sinks.write_table(src.where(F.col("l_orderkey") % 3 == i).repartition(12, "l_orderkey"), f"{base}/{fmt}", fmt)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(base)
    wrong = spark.createDataFrame([(f"{base}/none.parquet",), (f"{base}/notes.txt",)], "path string")
    return src.schema, files.select("path").union(wrong)


def q_scan_any(spark, sf_dir):
    """All files of three formats as one table; the missing and the unknown one are left out."""
    schema, paths = _mixed_files(spark, sf_dir)
    found = readers.scan_any(spark, paths, schema)
    return found.withColumn("format", F.regexp_extract("source_file", "[a-z]+$", 0)).drop("source_file")


def q_probe_files(spark, sf_dir):
    """What the probe says of the files, by format."""
    _, paths = _mixed_files(spark, sf_dir)
    found = readers.probe(spark, paths)
    return found.groupBy(F.coalesce("format", F.lit("none")).alias("format"), F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        (F.count(F.lit(1)) > 0).alias("found"), (F.sum("size") > 0).alias("sized")
    )


def q_expand_paths(spark, sf_dir):
    from ..sources.readers import expand_paths

    ev = views.table(spark, sf_dir, "events")
    bounds = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    tickers = views.trades(spark, sf_dir).select("ticker")
    out = expand_paths(spark, tickers, bounds["lo"].date().isoformat(), bounds["hi"].date().isoformat(), base="data/raw/trade")
    return out.withColumn("date", F.col("date").cast("string"))


def q_paired_paths(spark, sf_dir):
    from ..sources.readers import paired_paths

    ev = views.table(spark, sf_dir, "events")
    bounds = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    tickers = views.trades(spark, sf_dir).select("ticker")
    out = paired_paths(spark, tickers, bounds["lo"].date().isoformat(), bounds["hi"].date().isoformat())
    return out.withColumn("date", F.col("date").cast("string"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
