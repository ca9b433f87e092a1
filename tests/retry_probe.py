"""Run by test_retry.py in its own process: a session whose tasks may be retried.

A test-only Python filter fails the first attempt of one task of the scan
stage (as a lost executor would); the analytics must still give exactly the
rows of an undisturbed run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from feedlens.plans import analytics as A  # noqa: E402
from feedlens.sources import testbed  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="feedlens-retry-")


def fails_once(_):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKS, uuid.uuid4().hex), "w").close()  # count the injected failures
        raise RuntimeError("simulated loss of an executor")
    return True


def main(sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")  # up to 4 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    feed = testbed.feed(spark, sf_dir)
    flaky = feed.filter(F.udf(fails_once, "boolean")(F.col("video_id")))
    dictionary = testbed.dictionary(spark, sf_dir)
    out = {}
    for name, build in {
        "top_tags": lambda f: A.top_tags_by_category_name(f, dictionary),
        "first_per_key": lambda f: A.trending_union_first(f),
        "classification": lambda f: A.avg_comments_classification(f),
    }.items():
        clean = sorted(map(repr, build(feed).collect()))
        disturbed = sorted(map(repr, build(flaky).collect()))
        out[name] = [len(clean), clean == disturbed]
    out["injected_failures"] = len(os.listdir(MARKS))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
