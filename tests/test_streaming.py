"""Structured Streaming over page files."""

import json

from tidewater.streaming.pages import post_metrics_stream, read_page_stream, running_label_counts, write_post_metrics

from .test_posts_and_features import PAGES


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(json.dumps(p) for p in PAGES[:3]) + "\n")
    (src / "b.jsonl").write_text("\n".join(json.dumps(p) for p in PAGES[3:]) + "\n")
    stream = read_page_stream(spark, str(src), max_files_per_trigger=1)
    q = write_post_metrics(post_metrics_stream(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 8
    counts = (
        running_label_counts(read_page_stream(spark, str(src)))
        .writeStream.format("memory").queryName("label_counts_test").outputMode("complete").start()
    )
    counts.processAllAvailable()
    got = {r.label: r.cnt for r in spark.sql("SELECT * FROM label_counts_test").collect()}
    counts.stop()
    assert got["Sport"] == 3 and got["Politics"] == 2
