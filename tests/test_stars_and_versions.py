"""The greedy star dissolve against going through the features one by one; publications without a gap."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from terraloom.operators import stars
from terraloom.sinks import publish


def one_by_one(ids, pairs):
    near = {i: set() for i in ids}
    for a, b in pairs:
        if a in near and b in near and a != b:
            near[a].add(b)
            near[b].add(a)
    centre = {}
    for i in sorted(ids):
        if i not in centre:
            centre[i] = i
            for j in near[i]:
                centre.setdefault(j, i)
    number = {c: k + 1 for k, c in enumerate(sorted(set(centre.values())))}
    return sorted((i, c, number[c]) for i, c in centre.items())


@pytest.mark.parametrize(("seed", "kind"), [(1, "random"), (2, "path"), (3, "lattice")])
def test_stars_equal_a_sequential_pass(spark, seed, kind):
    rng = random.Random(seed)
    if kind == "random":
        ids = rng.sample(range(10**6), 400)
        pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(700)] + [(5, ids[0]), (ids[1], ids[1]), (ids[2], None)]
    elif kind == "path":  # the longest chain of decisions that there can be
        ids, pairs = list(range(300)), [(i + 1, i) for i in range(299)]
    else:
        ids = [i for i in range(900) if rng.random() < 0.8]
        pairs = [(i, j) for i in ids for j in (i + 1, i + 30) if j != i + 1 or j % 30]
    features = spark.createDataFrame([(i,) for i in [*ids, ids[0], None]], "id long")
    links = spark.createDataFrame(pairs * 2, "src long, dst long")
    assert sorted(map(tuple, stars.greedy_stars(features, links).collect())) == one_by_one(ids, pairs)


def test_no_features(spark):
    assert stars.greedy_stars(spark.createDataFrame([], "id long"), spark.createDataFrame([], "src long, dst long")).count() == 0


def test_a_reader_always_finds_a_whole_version(spark, tmp_path):
    root, done, failed, seen = str(tmp_path), threading.Event(), [], set()
    assert publish.publish_version(spark.range(10).withColumn("v", F.lit(0)), root, "d") == 10

    def read():
        while not done.is_set():
            try:
                rows = publish.read_current(spark, root, "d").collect()
                seen.add((len(rows), len({r.v for r in rows})))
            except Exception as e:  # noqa: BLE001
                failed.append(repr(e))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 50):
        assert publish.publish_version(spark.range(10).withColumn("v", F.lit(v)), root, "d") == 10
    done.set()
    reader.join()
    assert not failed and seen == {(10, 1)}
    assert publish.publish_version(spark.range(0).withColumn("v", F.lit(1)), root, "d") == 0
    assert {r.v for r in publish.read_current(spark, root, "d").collect()} == {49}
    assert publish.run_log(spark, root, "d").agg(F.count("*"), F.sum("rows"), F.max("version")).head() == (50, 500, 50)
    assert len(list((tmp_path / "raw/d/versions").iterdir())) == 3


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.read_current(spark, str(tmp_path), "none")


def test_counts_come_from_the_write(spark, tmp_path):
    assert publish.write_counted(spark.range(7), str(tmp_path / "x")) == 7
    assert publish.write_counted(spark.range(0), str(tmp_path / "y")) == 0
    assert publish.publish(spark.range(0), str(tmp_path), "e") is False and publish.publish(spark.range(3), str(tmp_path), "e") is True
