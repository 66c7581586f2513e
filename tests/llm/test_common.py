import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from phenoscope.llm import common
from phenoscope.llm.common import components, runs, shared_dir, star_edges


def test_components_match_brute_force(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(5, 5), (7, None)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2060)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if x is not None}
    while True:
        before = dict(label)
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert got == {n: c for n, c in label.items() if n != c}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_star_edges():
    a, b = star_edges(np.array([5, 4, 9, 9]), np.array([4, 3, 8, 9]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(3, 4), (3, 5), (8, 9)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_runs_keep_groups_whole(size):
    keys = sorted(random.Random(size).choices(range(9), k=40))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + size]), pa.array(range(i, i + len(keys[i:i + size])))], names=["k", "v"])
               for i in range(0, len(keys), size)]
    tables = list(runs(iter(batches), ["k"]))
    assert [v for t in tables for v in t["v"].to_pylist()] == list(range(40))
    seen = [set(t["k"].to_pylist()) for t in tables]
    assert sum(map(len, seen)) == len(set(keys))


def test_shared_dir_is_read_from_the_session(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_cluster_without_a_shared_folder_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_discard_deletes_only_the_table_given(spark):
    kept, gone = (common.written(spark.range(20), "numbers") for _ in range(2))
    folder = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    common.discard(gone)
    assert not os.path.exists(folder) and kept.count() == 20
    common.discard(spark.range(3))


def test_settled_keeps_its_result_and_deletes_what_led_to_it(spark):
    made = []

    def make():
        made.append(common.written(spark.range(50), "step"))
        made.append(common.settled(lambda: made[0].filter("id < 30"), "inner"))
        return made[1].filter("id < 20")

    table = common.settled(make, "result")
    folders = [x.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") for x in (*made, table)]
    assert [os.path.exists(f) for f in folders] == [False, False, True] and table.count() == 20


def test_settled_that_fails_leaves_later_tables_alone(spark):
    with pytest.raises(ZeroDivisionError):
        common.settled(lambda: 1 / 0, "broken")
    assert common.written(spark.range(3), "numbers").count() == 3


def test_written_leaves_no_shuffle_files_and_no_setting(spark):
    before = spark.conf.get(common.SHUFFLE_CLEANUP, None)
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}

    old = shuffles()
    common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not shuffles() - old and spark.conf.get(common.SHUFFLE_CLEANUP, None) == before


def test_flagged_misses_no_wanted_key(spark):
    rows = spark.range(1000).withColumn("_bit", F.col("id") * 2)
    got = common.flagged(rows, rows.filter("id % 3 = 0"), F.xxhash64("id"), "near")
    assert got.columns == ["id", "_bit", "near"] and got.count() == 1000
    assert got.filter("id % 3 = 0 and not near").count() == 0 and got.filter("near").count() < 400
    assert common.flagged(rows, rows.filter("false"), F.xxhash64("id"), "near").filter("near").count() == 0
