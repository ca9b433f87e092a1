"""The streaming top-tags query reaches the batch result, also across several batches."""

from __future__ import annotations

import os
import shutil

from feedlens.plans import analytics as A
from feedlens.schema import all_string_schema
from feedlens.sources import read_dictionary, read_feed
from feedlens.streaming import read_feed_stream, start_top_tags

from . import golden


def test_stream_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    paths = golden.write_feeds(src)
    dictionary = read_dictionary(spark, golden.write_dictionary(tmp_dir))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    schema = all_string_schema(["category", "top10_tags", "epoch"])
    # two files first, then the third: two runs of the same checkpointed query
    for p in paths[:2]:
        shutil.copy(p, inbox)
    q = start_top_tags(read_feed_stream(spark, inbox, max_files_per_trigger=1), dictionary, out,
                       checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    partial = {r.category: r.top10_tags for r in read_feed(spark, out, schema=schema).collect()}
    want_partial = {r.category: r.top10_tags
                    for r in A.top_tags_by_category_name([read_feed(spark, p) for p in paths[:2]], dictionary).collect()}
    assert partial == want_partial
    shutil.copy(paths[2], inbox)
    q = start_top_tags(read_feed_stream(spark, inbox), dictionary, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    final = {r.category: r.top10_tags for r in read_feed(spark, out, schema=schema).collect()}
    want = {r.category: r.top10_tags
            for r in A.top_tags_by_category_name([read_feed(spark, p) for p in paths], dictionary).collect()}
    assert final == want


def test_classification_stream(spark, tmp_dir):
    from feedlens.schema import CLASSIFICATION_SCHEMA
    from feedlens.streaming import start_classification

    paths = golden.write_feeds(os.path.join(tmp_dir, "src"))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    for p in paths:
        shutil.copy(p, inbox)
    out = os.path.join(tmp_dir, "out")
    q = start_classification(read_feed_stream(spark, inbox, max_files_per_trigger=1), out,
                             checkpoint=os.path.join(tmp_dir, "ckpt"), available_now=True)
    q.awaitTermination()
    rows = [tuple(r) for r in read_feed(spark, out, schema=CLASSIFICATION_SCHEMA).collect()]
    assert rows == [("neutral", 3, 4.0), ("good", 2, 5.5), ("bad", 2, 1.0)]
