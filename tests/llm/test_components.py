"""Components settled by one task, and by rounds between several."""

import random
import uuid

import pytest

from helpers import rows
from loomgraph.llm import components as module
from loomgraph.llm.components import components


def brute(edges):
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("rows_a_task", [10, 60, 10**6])
def test_one_task_and_rounds_agree(spark, monkeypatch, rows_a_task):
    monkeypatch.setattr(module, "ROWS", rows_a_task)
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(-30, 30)]
    star = [(rng.choice([500, 100 + i]), 100 + i) for i in range(40)] + [(500, 100 + i) for i in range(40)]
    loose = [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(40)]
    edges = [e for e in chain + star + loose + loose[:5] if e[0] != e[1]]
    rng.shuffle(edges)
    got = rows(components(spark.createDataFrame(edges + [(7777, 7777), (None, 3)], "a long, b long").repartition(3)))
    assert sorted(got) == sorted(brute(edges).items())


@pytest.mark.parametrize("rows_a_task, most", [(10**6, 8), (40, 100)])
def test_jobs_of_a_table(spark, monkeypatch, rows_a_task, most):
    """The driver keeps accounts of every task, of which a job has as many as there are shuffle partitions: so a long chain in five tasks has to take few jobs too."""
    monkeypatch.setattr(module, "ROWS", rows_a_task)
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    group = f"components-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "components")
    try:
        assert {x[1] for x in rows(components(edges))} == {0}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= most
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_task_settles_without_a_shuffle(spark):
    """Where one task holds all edges, repeated ones too, no job has as many tasks as there are shuffle partitions."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] * 2, "a long, b long").coalesce(2)
    group, kept = f"components-{uuid.uuid4().hex}", spark.conf.get("spark.sql.shuffle.partitions")
    spark.sparkContext.setJobGroup(group, "components")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(rows(components(edges))) == [(i, 0) for i in range(201)]
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        assert sum(s.numTasks for s in stages if s) <= 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
