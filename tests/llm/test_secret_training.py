"""op1's networks and threshold come from all windows, whatever their number and however they lie in tasks."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import secrets


@pytest.fixture
def short(monkeypatch):
    monkeypatch.setattr(secrets, "PASSES", 3)
    monkeypatch.setattr(secrets, "LEAST_STEPS", 1)


def alike(findings: int, others: int) -> list[tuple[int, str]]:
    """Keys that a keyword shows, and keys that are the same without their surroundings."""
    draw = random.Random(5)
    key = lambda: "".join(draw.choices("0123456789ABCDEF", k=40))
    return [(i, f"set token = {key()} here") for i in range(findings)] + [
        (10000 + i, f"seen {key()} here") for i in range(others)]


def test_precision_counts_every_held_out_window(spark, short):
    docs = spark.createDataFrame(alike(50, 3500), "doc_id long, text string")
    (row,) = secrets.scan_secrets(docs).select("precision").distinct().collect()
    assert 0 < row.precision < 0.018  # 49 of about 3,400 that pass; 49 of 1,992 when 2,000 others were read


def test_examples_hold_every_window_of_the_other_folds(spark, monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 64)
    docs = spark.createDataFrame(alike(20, 300) * 2, "doc_id long, text string")
    windows = secrets.labelled(secrets.found(docs))
    every = windows.collect()
    assert len(every) == 320
    plan = secrets.courses(windows)
    taken = secrets.examples(windows, plan).select("net", "block", F.inline("windows")).collect()
    for net, course in enumerate(plan):
        own = [r for r in taken if r.net == net]
        assert {(r.seen, r.known) for r in own} == {(r.seen, r.known) for r in every if r.fold != net}
        assert {r.block for r in own} == set(range(course.blocks)) and course.blocks > 4
        times: dict = {}
        for r in own:
            times[r.seen, r.known] = times.get((r.seen, r.known), 0) + r.times
        assert all(n == (course.copies if known else 1) for (_, known), n in times.items())
        shares = [sum(r.times for r in own if r.known and r.block == b) for b in range(course.blocks)]
        assert course.copies > course.blocks and min(shares) > 0


def test_networks_do_not_depend_on_partitions_and_the_threshold_is_that_of_all_scores(spark, short, monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 64)
    docs = spark.createDataFrame(
        alike(60, 40) + [(20000 + i, f"number {zlib.crc32(b'%d' % i):012d} here") for i in range(200)],
        "doc_id long, text string")
    one, two = (secrets.train(secrets.labelled(secrets.found(d))) for d in (docs.repartition(2), docs.repartition(7)))
    assert all(np.array_equal(a.vector(), b.vector()) for a, b in zip(one.nets, two.nets))
    assert one.precision == two.precision and one.threshold == pytest.approx(two.threshold)
    rows = secrets.labelled(secrets.found(docs)).collect()
    labels, folds = (np.array([r[c] for r in rows]) for c in ("known", "fold"))
    logit = one.logits(secrets._blanked(secrets.codes_of([r.seen for r in rows])), folds)
    last = np.quantile(logit[labels], 1 - secrets.RECALL, method="lower")
    middle = (last + logit[~labels & (logit < last)].max()) / 2
    assert one.threshold == pytest.approx(secrets._logistic(one.scale * middle + one.shift))
    assert one.precision == labels[logit >= middle].mean()
    error = secrets._logistic(one.scale * logit + one.shift) - labels
    assert abs((error * logit).mean() + 0.01 * (one.scale - 1)) < 1e-4 and abs(error.mean() + 0.01 * one.shift) < 1e-4


def test_one_fold_with_all_findings_is_learned_by_its_own_network(spark, short):
    docs = spark.createDataFrame(alike(1, 30), "doc_id long, text string")
    windows = secrets.labelled(secrets.found(docs))
    fold = windows.filter("known").first()["fold"]
    plan = secrets.courses(windows)
    assert [c.whole[1] for c in plan] == [k == fold for k in range(secrets.FOLDS)] and not any(c.whole[0] for c in plan)
    nets = {r["net"] for r in secrets.examples(windows, plan).select("net", F.inline("windows")).filter("known").collect()}
    assert nets == set(range(secrets.FOLDS))
    assert secrets.courses(windows.filter("known")) is None and secrets.train(windows.filter("not known")) is None
