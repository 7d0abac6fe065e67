"""Restart of an ended job, publication all at once, and removal of scratch."""

import os
from dataclasses import replace

import pytest

from pitwise.plans.job import FeatureJob
from pitwise.plans.manifest import published
from pitwise.plans.registry import FIXTURE_PARAMS
from pitwise.sources.fixture import ADAPTERS, fixture_inputs
from pitwise.sources.inputs import Inputs

SF = "/root/testdata/sf0.001"


class Ended(Exception):
    pass


def ending(spark, *names):
    """The fixture's inputs, of which some end the job when they are read."""

    def end():
        raise Ended

    loaders = {n: (lambda a=a: a.spark(spark, SF)) for n, a in ADAPTERS.items()}
    return Inputs(loaders | {n: end for n in names})


def job(spark, inputs, run_id, **params):
    return FeatureJob(inputs, replace(FIXTURE_PARAMS, **params), materialize=True, run_id=run_id)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_job_goes_on_after_its_last_finished_stage(spark, tmp_path):
    run = f"restart-{tmp_path.name}"
    first = job(spark, ending(spark, "order_lines"), run)
    assert first.accounts.count() > 0
    with pytest.raises(Ended):
        first.payments
    assert list(job(spark, fixture_inputs(spark, SF), run).manifest.finished) == ["cohort", "accounts"]

    class Untouched(Inputs):
        def __getitem__(self, name):
            assert name not in ("members",), f"{name} is read again"
            return super().__getitem__(name)

    inputs = fixture_inputs(spark, SF)
    inputs.__class__ = Untouched
    again = job(spark, inputs, run)
    want = FeatureJob(fixture_inputs(spark, SF), FIXTURE_PARAMS).payments
    assert rows(again.payments) == rows(want)
    assert set(job(spark, fixture_inputs(spark, SF), run).manifest.finished) == {"cohort", "accounts", "payments"}
    with pytest.raises(ValueError, match="other parameters"):
        job(spark, fixture_inputs(spark, SF), run, amount_cap=1.0).accounts
    folder = again.scratch.removeprefix("file:")
    assert os.path.isdir(folder)
    again.cleanup()
    assert not os.path.exists(folder)


def test_an_unfinished_stage_is_written_anew(spark, tmp_path):
    run = f"half-{tmp_path.name}"
    one = job(spark, fixture_inputs(spark, SF), run)
    # What a job leaves that is ended while it writes: files, but no record.
    spark.range(3).write.parquet(f"{one.scratch}/cohort")
    assert one.cohort.columns == ["cust_ids", "time_censor"] and one.cohort.count() > 3
    one.cleanup()


def test_publication_is_all_or_nothing_and_goes_on(spark, tmp_path):
    target, stages = str(tmp_path / "tables"), ("cohort", "accounts", "payments", "spend")
    with pytest.raises(ValueError, match="no published run"):
        published(spark, target)
    one = job(spark, fixture_inputs(spark, SF), "one")
    out = one.publish(target, stages=stages)
    want = {n: rows(df) for n, df in published(spark, target).items()}
    assert list(want) == list(stages) and want["spend"] and set(out) == set(stages)
    assert not os.path.exists(one.scratch.removeprefix("file:"))

    with pytest.raises(Ended):
        job(spark, ending(spark, "orders"), "two", censor="1998-01-01 00:00:00").publish(target, stages=stages)
    assert {n: rows(df) for n, df in published(spark, target).items()} == want  # the last whole run
    with pytest.raises(ValueError, match="no published run two"):
        published(spark, target, "two")

    two = job(spark, ending(spark, "credits_alt"), "two", censor="1998-01-01 00:00:00")
    two.publish(target, stages=stages)
    now = {n: rows(df) for n, df in published(spark, target).items()}
    assert now != want and {n: rows(df) for n, df in published(spark, target, "one").items()} == want
    fresh = FeatureJob(fixture_inputs(spark, SF), replace(FIXTURE_PARAMS, censor="1998-01-01 00:00:00"))
    assert now["spend"] == rows(fresh.spend)
