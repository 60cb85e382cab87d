import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import topk


def brute(rows, asked, k):
    out = []
    for qid, q in asked:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qid)
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, asked, k=5, **more):
    frames = [spark.createDataFrame(x, "vec_id long, vector array<long>").withColumn("part", F.lit("x")) for x in (rows, asked)]
    return sorted(map(tuple, topk.top_k(*frames, k=k, **more).collect()))


@pytest.mark.parametrize("blocks", [(8192, 1024), (20, 3), (7, 2)])
def test_same_as_all_scores(spark, blocks):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-50, 50) for _ in range(6)]) for i in range(150)] + [(200 + i, [9, 9, 0, 0, 0, 1]) for i in range(40)]
    asked = rows[::25] + [(999, [0, 0, 0, 0, 0, 0])]
    assert run(spark, rows, asked, block_rows=blocks[0], block_queries=blocks[1]) == brute(rows, asked, 5)


def test_few_rows_ragged_large_and_repeated(spark):
    rows = [(1, [2**30, 3]), (2, [2**30 - 1]), (3, []), (4, [-5, 7, 2**33])]
    assert run(spark, rows + rows, rows[:1] + [(None, [1])], k=9) == brute(rows, rows[:1], 9)
    # beyond 64 bits a score is the nearest that a long holds
    got = run(spark, [(1, [2**40]), (2, [2**40]), (3, [-(2**40)])], [(1, [2**40])])
    assert got == [(1, 1, 2, 2**63 - 1), (1, 2, 3, -(2**63))]


def test_nothing(spark):
    assert run(spark, [], []) == [] and run(spark, [(1, [1])], []) == [] and run(spark, [], [(1, [1])]) == []
    assert run(spark, [(1, [1])], [(1, [1])]) == []


def test_scaling_and_vectors_that_take_no_part(spark):
    data = [(1, [0.1, -0.1, 0.0039]), (2, None), (3, [0.5, None]), (4, [math.nan]), (5, [math.inf]), (6, [-math.inf, 1.0]), (7, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    want = [math.floor(256 * float(np.float32(x))) for x in data[0][1]]
    assert {r[0]: r[1] for r in df.collect()} == {1: want, 2: None, 3: None, 4: None, 5: None, 6: None, 7: []}
    assert topk.top_k(df, df).where("query_id not in (1, 7) or vec_id not in (1, 7)").count() == 0


def test_reading_stops_at_the_bound():
    """Where few rows stand out, the lists are read only near their ends."""
    rng = np.random.default_rng(1)
    rows = rng.integers(-3, 4, (4000, 8)).astype(float)
    rows[[5, 77, 1234]] = 100
    lists = np.argsort(rows, axis=0, kind="stable").T.copy()

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            got = super().__getitem__(at)
            if isinstance(at, np.ndarray) and at.dtype.kind == "i":
                Counted.read += len(got)
            return got

    got = topk.threshold_top_k(np.arange(4000), rows.view(Counted), lists, np.ones(8), -1, 3)
    assert [i for i, _ in got] == [5, 77, 1234] and Counted.read < 400
