"""The same work in row-at-a-time RDD style, as a yardstick for ``bench.py``.

Prints one JSON line of seconds per task on BENCH_SF_DIR. Each task reads the parquet table, turns rows into
Python tuples, and uses RDD operators only, which is how programs of the Spark 1 and 2 era were written.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.mllib.linalg import Vectors
from pyspark.mllib.recommendation import ALS
from pyspark.mllib.regression import LabeledPoint
from pyspark.mllib.tree import DecisionTree
from pyspark.sql import SparkSession


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("loamwork-bench-rdd")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def rows(name, *columns):
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).rdd.map(tuple)

    def rated():
        lines = rows("lineitem", "l_orderkey", "l_partkey", "l_quantity").map(lambda r: (r[0], (r[1], r[2])))
        bought = lines.join(rows("orders", "o_orderkey", "o_custkey"))
        pairs = bought.map(lambda r: ((r[1][1], r[1][0][0]), (1 + r[1][0][1] % 5, 1)))
        return pairs.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).map(lambda r: (*r[0], r[1][0] / r[1][1]))

    def tree():
        points = rows("lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag").map(
            lambda r: LabeledPoint(float(r[4] == "R"), Vectors.dense(r[:4]))
        )
        DecisionTree.trainClassifier(points.cache(), 2, {}, impurity="entropy", maxDepth=10, maxBins=200)

    tasks = {
        "a05_word_count": lambda: rows("documents", "text").flatMap(lambda r: r[0].split(" "))
        .map(lambda w: (w, 1)).reduceByKey(lambda a, b: a + b).count(),
        "a03_one_pass_summary": lambda: rows("lineitem", "l_quantity").map(lambda r: r[0]).stats(),
        "a04_sum_by_key": lambda: rows("lineitem", "l_suppkey", "l_quantity").reduceByKey(lambda a, b: a + b).count(),
        "f08_column_expression": lambda: rows("orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
        .filter(lambda r: r[1] == "F" and r[2] == "1-URGENT" and r[3] > 100000).count(),
        "j01_inner": lambda: rows("lineitem", "l_suppkey", "l_quantity").join(rows("supplier", "s_suppkey", "s_acctbal")).count(),
        "o01_sort_asc": lambda: rows("lineitem", "l_suppkey", "l_quantity").sortByKey().count(),
        "o02_largest": lambda: rows("lineitem", "l_quantity").map(lambda r: r[0]).takeOrdered(3, key=lambda q: -q),
        "a17_ratings_profile": lambda: (lambda r: (r.count(), r.map(lambda x: x[0]).distinct().count(), r.map(lambda x: x[1]).distinct().count()))(rated()),
        "t01_binary_tree": tree,
        "t12_factors": lambda: ALS.train(rated().map(lambda r: (int(r[0]), int(r[1]), r[2])).cache(), 5, 20, 0.1).userFeatures().count(),
    }
    timings = {}
    for name, task in tasks.items():
        times = []
        for _ in range(1 if name[0] == "t" else runs):
            began = time.perf_counter()
            task()
            times.append(time.perf_counter() - began)
        timings[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "rdd_style_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings}))
    spark.stop()


if __name__ == "__main__":
    main()
