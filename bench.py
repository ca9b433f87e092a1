"""Benchmark the headline analytics.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` (default 8): one warm-up pass over all queries,
then ``$BENCH_REPEATS`` (default 5) interleaved rounds; the median per query
is reported. A timed run covers building the plan and executing it. A run executes the whole plan and
discards the rows through the ``noop`` sink, so no time goes into moving
rows to the driver. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlens import jobs  # noqa: E402
from feedlens.plans import catalog  # noqa: E402
from feedlens.session import get_session  # noqa: E402

HEADLINE = (
    "avg_comments_classification",
    "classification_nonempty",
    "top_tags_by_category_name",
    "top_tags_by_category_id",
    "top_tags_count_first",
    "trending_union",
    "trending_union_first",
    "top_tags_sql",
    "top_words_by_lang",
    "classification_from_files",
    "top_tags_from_files",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    conf = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    spark = get_session(f"local[{cpus}]", app="feedlens-bench", shuffle_partitions=cpus * 2, conf=conf)

    registry = catalog.queries()
    plans = {name: registry[name] for name in HEADLINE}
    # The files of these two are made once: a timed run is the job, not its input.
    feeds, dictionary = catalog.write_region_feeds(spark, sf_dir), catalog.write_dictionary_json(spark, sf_dir)
    plans["classification_from_files"] = lambda spark, _: jobs.classify(spark, feeds)
    plans["top_tags_from_files"] = lambda spark, _: jobs.top_tags(spark, feeds, dictionary)
    plans["top_tags_by_category_name_preagg"] = registry["top_tags_preaggregated"]

    def run(build) -> float:
        t0 = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for build in plans.values():  # warm-up pass over every query (JIT, file listing)
        run(build)
    samples: dict[str, list[float]] = {name: [] for name in plans}
    for _ in range(repeats):  # interleaved rounds, so no query always runs first
        for name, build in plans.items():
            samples[name].append(run(build))
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}

    sf = os.path.basename(sf_dir).removeprefix("sf")
    total = round(sum(times[n] for n in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_median_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
