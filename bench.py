"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local threads. Every query
runs once to warm up and then `BENCH_RUNS` times; the smallest time counts, as
it has the least of other programs' work in it. Row results go to the `noop`
sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from pointflow import get_session
from pointflow.operators import assign, fair, kmeans, metrics, partials, words
from pointflow.plans import bindings as b
from pointflow.plans.catalog import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def grid(k, dims):
    """K fixed centers spread over the value range of the points."""
    return [[(7 * i + 3 * j) % 50 + i / k for j in range(dims)] for i in range(k)]


def points3(spark, folder):
    from pointflow.sources.points import points_from_columns

    rows = b.table(spark, folder, "lineitem")
    return points_from_columns(rows, ["l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100], "l_returnflag")


def plans(spark, folder):
    p2, p3, p64 = b.points2(spark, folder), points3(spark, folder), b.points64(spark, folder)
    lines = b.doc_lines(spark, folder)
    c64 = b.centers64(spark, folder)
    total = lambda df: df.agg(F.sum("dist2"), F.sum("k")).collect()
    return {
        "assign_k4_d3": lambda: total(assign.assign_nearest(p3, grid(4, 3))),
        "assign_k100_d3": lambda: total(assign.assign_nearest(p3, grid(100, 3))),
        "assign_k10_d64": lambda: total(assign.assign_nearest(p64, c64)),
        "centers64": lambda: b.centers64(spark, folder),
        "group_sums_k100_d3": lambda: partials.cluster_group_sums(p3, grid(100, 3)).collect(),
        "cluster_report": lambda: metrics.cluster_report(p2, b.CENTERS).collect(),
        "lloyd_3_rounds": lambda: kmeans.lloyd(p2, b.CENTERS, 3),
        "fair_lloyd_3_rounds": lambda: fair.fair_lloyd(p2, b.CENTERS, 3),
        "fair_lloyd_population_3_rounds": lambda: fair.fair_lloyd(p2, b.CENTERS, 3, "population"),
        "fair_line_search_per_supplier": lambda: drain(QUERIES["fair_line_search"](spark, folder)),
        "lloyd_by_segment_3_rounds": lambda: drain(QUERIES["lloyd_by_segment"](spark, folder)),
        "kmeans_fit_k4_20_rounds": lambda: kmeans.kmeans_fit(p2, 4, 20),
        "word_count": lambda: drain(words.word_count(lines)),
        "word_count_salted": lambda: drain(words.word_count_salted(lines, b.LINE_KEYS)),
        "word_count_salted_groupby": lambda: drain(words.word_count_salted(lines, b.LINE_KEYS, salt_from="word_doc")),
        "word_count_salted_hot": lambda: drain(words.word_count_salted_hot(lines)),
        "word_count_by_partition": lambda: drain(words.word_count_by_partition(lines)),
        "doc_word_count": lambda: drain(words.doc_word_count(lines, b.LINE_KEYS)),
        "wordcount_summary": lambda: words.wordcount_summary(lines).collect(),
        "stream_threshold_replay": lambda: QUERIES["stream_threshold_replay"](spark, folder).collect(),
        "stream_distinct": lambda: drain(QUERIES["stream_distinct"](spark, folder)),
        "gen_blobs": lambda: drain(QUERIES["gen_blobs"](spark, folder)),
    }


def jobs_of(spark, run):
    """Spark jobs that one call starts."""
    spark.sparkContext.setJobGroup("bench", "bench")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup("bench"))
    run()
    after = len(tracker.getJobIdsForGroup("bench"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return after - before


def main():
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, jobs = {}, {}
    for name, run in plans(spark, FOLDER).items():
        jobs[name] = jobs_of(spark, run)
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "jobs": jobs,
                "sf": os.path.basename(FOLDER.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
