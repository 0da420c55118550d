"""A run is one unit: committed last, taken up again, never seen half done."""

import pytest
from pyspark.sql import functions as F

from tierwell.plans import pipeline
from tierwell.sources import fixtures as fx
from tierwell.sources.store import Run, RunView, SnapshotStore, scratch_dir

from conftest import SF_TINY, rows

STAGES = ["a", "b", "c"]


def step(spark, run, calls, stop=None):
    """Three tables that hold the run's number and what they were before."""
    for name in STAGES:
        if name == stop:
            raise OSError("stopped")

        def build(name=name):
            calls.append(name)
            before = run.before(name)
            return spark.range(1).select(F.lit(run.run_id).alias("run"),
                                         F.lit(0 if before is None else before.head()["n"] + 1).alias("n"))
        run.write(name, build)
    run.commit()


def state(store):
    view = RunView(store)
    return {n: tuple(view.read(n).head()) for n in STAGES if view.read(n) is not None}


@pytest.mark.parametrize("stop", [*STAGES, "commit"])
def test_stopped_after_each_stage(spark, stop, monkeypatch):
    store = SnapshotStore(spark, scratch_dir(spark, "runs"))
    step(spark, Run(store, "one"), [])
    assert state(store) == {n: ("one", 0) for n in STAGES}
    calls = []
    with monkeypatch.context() as patch:
        if stop == "commit":
            patch.setattr(SnapshotStore, "commit", lambda self, table, v, plain=SnapshotStore.commit:
                          plain(self, table, v) if table != "_runs" else (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            step(spark, Run(store, "two"), calls, stop)
    # readers see the first run only, though tables of the second are stored
    assert state(store) == {n: ("one", 0) for n in STAGES}
    again = []
    step(spark, Run(store, "two"), again)
    assert state(store) == {n: ("two", 1) for n in STAGES}
    assert sorted(calls + again) == STAGES                  # no stage twice
    step(spark, Run(store, "two"), again)                    # a committed run changes nothing
    assert len(again) + len(calls) == 3 and state(store) == {n: ("two", 1) for n in STAGES}


def test_rival_and_abandoned_runs(spark):
    store = SnapshotStore(spark, scratch_dir(spark, "runs"))
    a, b = Run(store, "a/1"), Run(store, "a:1")
    step(spark, a, [])
    with pytest.raises(RuntimeError, match="another run"):
        step(spark, b, [])
    assert state(store) == {n: ("a/1", 0) for n in STAGES}
    # the next run starts from the committed one, not from what b left behind
    step(spark, Run(store, "c"), [])
    assert state(store) == {n: ("c", 1) for n in STAGES}
    assert tuple(RunView(store, 1).read("a").head()) == ("a/1", 0)


def test_a_load_that_stops_is_taken_up(spark, monkeypatch):
    store = SnapshotStore(spark, scratch_dir(spark, "pipeline"))
    req = fx.stg_request(spark, SF_TINY)
    batch = {"case": fx.stg_case(spark, SF_TINY), "request": req.where("batch = 1").drop("batch"),
             "address": fx.stg_address(spark, SF_TINY)}
    run = lambda: pipeline.run_batch(spark, store, batch, fx.BATCH_TS[1],
                                     stg_currency=fx.listed_currencies(spark), batch_id="first")
    with monkeypatch.context() as patch:
        patch.setattr(pipeline.facts, "build_case_fact", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            run()
    assert RunView(store).read("fct_request") is None and store.version("fct_request") == 1
    with pytest.raises(Exception):
        pipeline.reports_from_store(store, fx.stg_rso_plan(spark, SF_TINY), fx.SPINE_START, fx.AS_OF, fx.WINDOW)
    built = []
    with monkeypatch.context() as patch:
        patch.setattr(pipeline.history, "load_history", lambda *a, **k: built.append(a))
        out = run()
    assert not built and store.version("ods_case") == store.version("fct_case") == 1
    assert rows(RunView(store).read("fct_case"), "case_number") == rows(out["fct_case"], "case_number") != []
