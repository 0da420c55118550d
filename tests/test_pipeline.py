"""Pipeline run (S14) over the snapshot store, sources and sinks, streaming load."""

import os

import pytest
from pyspark.sql import functions as F

from tierwell import specs
from tierwell.operators import history
from tierwell.plans.pipeline import reports_from_store, run_batch
from tierwell.sources import fixtures as fx
from tierwell.sources.ingest import read_files, write_xlsx_bytes
from tierwell.sources.store import SnapshotStore, load_layer, scratch_dir

from conftest import SF_TINY, rows


def _batch(spark, n):
    req = fx.stg_request(spark, SF_TINY)
    return {"case": fx.stg_case(spark, SF_TINY, 2 if n == 2 else 1),
            "request": req.filter(F.col("batch") == n).drop("batch"),
            "address": fx.stg_address(spark, SF_TINY, 2 if n == 2 else 1)}


def test_pipeline_two_runs_keep_ids_and_versions(spark):
    store = SnapshotStore(spark, scratch_dir(spark, "pipeline"))
    first = run_batch(spark, store, _batch(spark, 1), fx.BATCH_TS[1],
                      stg_currency=fx.listed_currencies(spark))
    agents1 = rows(first["spr_agent"], "id", "username")
    enums1 = rows(store.read("spr_enums"))
    store.write("stg_currency", fx.listed_currencies(spark))     # read from the store from now on
    second = run_batch(spark, store, _batch(spark, 2), fx.BATCH_TS[2])
    assert store.version("ods_request") == 2
    # ids of existing members never change
    assert set(agents1) <= set(rows(second["spr_agent"], "id", "username"))
    assert set(enums1) <= set(rows(store.read("spr_enums")))
    # one active version per key after the incremental load
    ods = second["ods_case"]
    assert ods.groupBy("global_case_number").agg(F.sum("is_active").alias("n")) \
        .filter("n <> 1").count() == 0
    # request facts: natural key unique
    fr = second["fct_request"]
    assert fr.count() == fr.select("request_number").distinct().count()
    rep = reports_from_store(store, fx.stg_rso_plan(spark, SF_TINY), fx.SPINE_START, fx.AS_OF,
                             fx.WINDOW)
    assert rep["daily_stats"].count() > 0
    rejects = spark.read.parquet(f"{store.base}/rejected_stg_case")
    assert rejects.select("batch").distinct().count() == 2


def test_pipeline_needs_a_currency_list(spark):
    store = SnapshotStore(spark, scratch_dir(spark, "pipeline"))
    with pytest.raises(ValueError, match="currency"):
        run_batch(spark, store, {}, fx.BATCH_TS[1])


def test_store_never_loses_a_version(spark):
    store = SnapshotStore(spark, scratch_dir(spark, "store"))
    assert store.version("t") is None and store.read("t") is None
    store.write("t", spark.range(5))
    store.write("t", spark.range(200))
    # a run that died before its commit: a folder without the marker
    spark.range(7).write.parquet(f"{store.base}/t/v=3")
    assert store.version("t") == 2 and store.read("t").count() == 200
    store.write("t", store.read("t").limit(3))             # rebuilt from itself
    assert store.version("t") == 4 and store.read("t").count() == 3
    assert spark.read.parquet(f"{store.base}/t/v=2").count() == 200
    # a commit that cannot happen twice, and a listing that fails, raise
    with pytest.raises(Exception, match="exist"):
        store.commit("t", 4)
    with pytest.raises(Exception):
        SnapshotStore(spark, "nosuchstore://x").version("t")


def test_replayed_epoch_changes_nothing(spark):
    from tierwell.streaming.batches import load_epoch
    store = SnapshotStore(spark, scratch_dir(spark, "epoch"))
    stg = fx.stg_case(spark, SF_TINY)
    clock = lambda epoch: fx.BATCH_TS[epoch + 1]
    load_epoch(stg, 0, specs.CASE, store, clock)
    once = rows(store.read("ods_case"), "global_case_number", "effective_from", "is_active")
    rejects = spark.read.parquet(f"{store.base}/rejected_stg_case").count()
    load_epoch(stg, 0, specs.CASE, store, clock)
    assert rows(store.read("ods_case"), "global_case_number", "effective_from", "is_active") == once
    assert spark.read.parquet(f"{store.base}/rejected_stg_case").count() == rejects > 0


def test_usecols(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Nation Key,Nation/Name,Region Key\n1,A,9\n")
    (tmp_path / "b.csv").write_text("Nation Key,Nation/Name,nation/name\n2,B,b\n")
    path = os.path.join(str(tmp_path), "*.csv")
    assert read_files(spark, path, "csv", usecols="A:B").columns == ["nation_key", "nation_name"]
    assert read_files(spark, path, "csv", usecols=[0]).columns == ["nation_key"]
    both = read_files(spark, path, "csv", usecols=["Nation Key", "Region Key"])
    assert rows(both, "nation_key", "region_key") == [("1", "9"), ("2", None)]
    assert "nation_name_2" in read_files(spark, path, "csv").columns
    for bad in (["Nation Key", "Missing"], "Z:ZZ", "1-2"):
        with pytest.raises(ValueError, match="usecols"):
            read_files(spark, path, "csv", usecols=bad)


def test_html_tables_as_written_in_the_wild():
    from tierwell.sources.html_tables import parse_tables
    assert parse_tables("<table><tr><td>A<td>b<tr><td>c</table>") == [[(False, ["A", "b"]), (False, ["c"])]]
    assert parse_tables("<table><tr><td>A<table><tr><td>in</table>more<td>b</table>") == [
        [(False, ["A more", "b"])], [(False, ["in"])]]
    assert parse_tables("<table><tr><th>x<th>y<tr><th scope=row>USD<td>dollar<script>no</script></table>") == [
        [(True, ["x", "y"]), (False, ["USD", "dollar"])]]
    assert parse_tables("<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c<td>d<tr><td>e") == [
        [(False, ["a", "b", "b"]), (False, ["a", "c", "d"]), (False, ["e"])]]
    assert parse_tables("") == [] and parse_tables("<td>stray</td>") == []


def test_layer_overwrite_reconciles_counts(spark):
    base = scratch_dir(spark, "layer")
    df = spark.read.parquet(f"{SF_TINY}/nation.parquet")
    out = load_layer(df, "nation", base).first()
    assert (out["table_name"], out["rows_written"], out["rows_read"]) == ("stg_nation", 25, 25)
    out = load_layer(df.limit(3), "nation", base).first()   # replaced, not appended
    assert out["rows_read"] == 3


def test_xlsx_ingest_stacks_by_header(spark, tmp_path):
    a = write_xlsx_bytes(["Nation Key", "Nation/Name"], [["1", "A"], ["2", "B"]])
    b = write_xlsx_bytes(["Nation Key", "Nation/Name", "Region Key"], [["3", "C", "9"]])
    (tmp_path / "a.xlsx").write_bytes(a)
    (tmp_path / "b.xlsx").write_bytes(b)
    df = read_files(spark, os.path.join(str(tmp_path), "*.xlsx"), "xlsx")
    assert rows(df, "nation_key", "nation_name", "region_key") == [
        ("1", "A", None), ("2", "B", None), ("3", "C", "9")]
    picked = read_files(spark, os.path.join(str(tmp_path), "*.xlsx"), "xlsx",
                        usecols=["Nation Key"])
    assert picked.columns == ["nation_key"]


def test_streaming_load_equals_batch_load(spark):
    base = scratch_dir(spark, "stream")
    stg = fx.stg_case(spark, SF_TINY)
    stg.write.parquet(f"{base}/incoming")
    store = SnapshotStore(spark, f"{base}/store")
    from tierwell.streaming.batches import load_stream
    q = load_stream(spark, f"{base}/incoming", specs.CASE, store,
                    clock=lambda epoch: fx.BATCH_TS[1], checkpoint_location=f"{base}/ckpt")
    q.awaitTermination(300)
    got = store.read("ods_case")
    want = history.load_history(history.empty_ods(spark, specs.CASE), stg, specs.CASE,
                                fx.BATCH_TS[1])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
