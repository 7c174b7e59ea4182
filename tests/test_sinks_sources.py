"""Sinks (round trips, overwrite/append) and sources (scans, readers)."""

import json
import os

import pytest
from pyspark.errors import PySparkException

from conftest import SF0001, make_inputs, rows
from usagelens.plans import activity_snapshot, network_activity
from usagelens.plans.run_all import run_all
from usagelens.schemas import (
    ACTIVITY_SNAPSHOT, NETWORK_DOCUMENT_FIELDS, RATE_PLAN_TRENDS, REJECTS,
)
from usagelens.session import checkpoint_dir, output_root, scratch_checkpoint_dir
from usagelens.sinks import conform, read_documents, read_table, to_documents, write_documents, write_table
from usagelens.sources import plan_catalogue, scan
from usagelens.sources.files import conform_input, load_inputs_from_paths, read_document_collection
from usagelens.sources.jdbc import jdbc_options
from usagelens.sources.testdata import load_inputs


def _small(spark):
    return make_inputs(spark, voice=[("1", 4, "L1"), ("2", 9, "L2")], sms=[("1", "n", "L1")],
                       volume=[("1", " ", "3", 1, 1)], locations=[("L1", "EU")])


def test_overwrite_twice_gives_same_table(spark, scratch_dir):
    path = os.path.join(scratch_dir, "activity")
    df = activity_snapshot(_small(spark))
    write_table(df, ACTIVITY_SNAPSHOT, path=path)
    write_table(df, ACTIVITY_SNAPSHOT, path=path)
    back = read_table(spark, ACTIVITY_SNAPSHOT, path=path)
    assert rows(back) == rows(df) and back.count() == 2


def test_catalog_table_write(spark):
    df = activity_snapshot(_small(spark))
    write_table(df, ACTIVITY_SNAPSHOT, table="activity_snapshot_test")
    assert rows(read_table(spark, table="activity_snapshot_test")) == rows(df)


def test_documents_append_by_default_and_overwrite_is_idempotent(spark, scratch_dir):
    path = os.path.join(scratch_dir, "docs")
    docs = to_documents(network_activity(_small(spark)))
    assert docs.columns == ["_id", "Rank"] + NETWORK_DOCUMENT_FIELDS
    write_documents(docs, path)
    write_documents(docs, path)
    assert read_documents(spark, path).count() == 2 * docs.count()
    write_documents(docs, path, mode="overwrite")
    assert rows(read_documents(spark, path)) == rows(docs)
    first = json.loads(open([os.path.join(path, f) for f in os.listdir(path)
                             if f.endswith(".json")][0]).readline())
    assert set(first) == {"_id", "Rank", *NETWORK_DOCUMENT_FIELDS}


def test_document_ids_name_the_run_and_the_rank(spark, scratch_dir):
    path, net = os.path.join(scratch_dir, "docs"), network_activity(_small(spark))
    for run in ("monday", "tuesday"):
        write_documents(to_documents(net, run), path)
    ids = [r._id for r in read_documents(spark, path).collect()]
    assert len(ids) == len(set(ids)) == 2 * net.count() and {i.split("-")[0] for i in ids} == {"monday", "tuesday"}
    assert rows(to_documents(net, "monday")) == rows(to_documents(net, "monday"))


def test_schema_contract_rejects_missing_column(spark):
    df = activity_snapshot(_small(spark)).drop("longest_call")
    with pytest.raises(ValueError):
        conform(df, ACTIVITY_SNAPSHOT)
    with pytest.raises(ValueError):
        conform(activity_snapshot(_small(spark)), RATE_PLAN_TRENDS)


@pytest.mark.parametrize("materialize", [False, True])
def test_run_all_writes_every_output(spark, scratch_dir, materialize):
    from usagelens.plans import rate_plan_trends
    inp = load_inputs(spark, SF0001)
    out = {k: os.path.join(scratch_dir, k) for k in ("activity", "trends", "network", "network_docs")}
    run_all(inp, out, materialize_inputs=materialize)
    assert read_table(spark, ACTIVITY_SNAPSHOT, path=out["activity"]).count() == 150
    assert rows(read_table(spark, RATE_PLAN_TRENDS, path=out["trends"])) == rows(rate_plan_trends(inp))
    assert read_documents(spark, out["network_docs"]).count() == 5


def test_scan_projection_truncation_and_ordered_limit(spark):
    inp = make_inputs(spark, sms=[("1234567890123456", "n", "LOCATION-CODE-XYZ")],
                      volume=[("b", "1", "1", 2, 2), ("a", "1", "1", 1, 1), ("c", "1", "1", 3, 3)])
    assert rows(scan(inp, "sms_location", truncate_ids=True)) == [("123456789012345", "LOCATION-CODE-X")]
    assert rows(scan(inp, "sms_location")) == [("1234567890123456", "LOCATION-CODE-XYZ")]
    assert scan(inp, "sub_rec", limit=2).collect() == [(1, "a", 1), (2, "b", 2)]
    with pytest.raises(KeyError):
        scan(inp, "nope")


def test_file_readers(spark, scratch_dir):
    plans = os.path.join(scratch_dir, "plans.json")
    with open(plans, "w") as fh:
        fh.write('{"rate_plan_product_id": "7", "rate_plan_name": "Gold"}\n')
        fh.write('{"rate_plan_product_id": 8}\n')
    assert rows(read_document_collection(spark, "rate_plan_product", plans)) == [("7", "Gold"), ("8", None)]
    subs = os.path.join(scratch_dir, "subscriber.csv")
    with open(subs, "w") as fh:
        fh.write("id,a,b,c,d,age\n1,a,b,c,d,40\n")
    facts = {}
    for name, df in (("voice_call_record", [("1", 3, "L1")]), ("sms_record", [("1", "n", "L1")])):
        facts[name] = os.path.join(scratch_dir, name)
        spark.createDataFrame(df, ["subscription_id", "x", "y"]).toDF(
            *({"voice_call_record": ["subscription_id", "actual_duration", "called_location_cd"],
               "sms_record": ["subscription_id", "network_id", "called_location_cd"]}[name])
        ).write.parquet(facts[name])
    facts["mobile_data_activity"] = os.path.join(scratch_dir, "mda")
    spark.createDataFrame([("1", " ", "2", 5)], "subscription_id string, uplink_volume string, "
                          "downlink_volume string, rate_plan_product_id int").write.parquet(
        facts["mobile_data_activity"])
    locs = os.path.join(scratch_dir, "loc.json")
    with open(locs, "w") as fh:
        fh.write('{"location_cd": "L1", "country": "EU"}\n')
    inp = load_inputs_from_paths(spark, {**facts, "subscriber": subs, "rate_plan_product": plans,
                                         "location": locs})
    assert inp.subscriber.count() == 2  # no header skipping
    assert inp.mobile_data_activity.columns[-1] == "activity_seq"
    assert rows(plan_catalogue(inp)) == [(7, "Gold"), (8, None)]
    assert rows(activity_snapshot(inp)) == [(1, 3, 3, 1, 0, 2)]


def test_conform_input_requires_columns(spark):
    with pytest.raises(ValueError):
        conform_input(spark.createDataFrame([("1",)], "subscription_id string"), "sms_record")


def test_jdbc_options():
    opts = jdbc_options("jdbc:postgresql://db/x", "voice_call_record", partition_column="id",
                        lower_bound=0, upper_bound=1000, num_partitions=16, user="u")
    assert opts == {"url": "jdbc:postgresql://db/x", "dbtable": "voice_call_record",
                    "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "0",
                    "upperBound": "1000", "numPartitions": "16", "user": "u"}
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="id")


class _Session:
    """What session.py asks of a session."""

    def __init__(self, master, configured=None, given=None):
        self.conf, self.sparkContext, self.master = self, self, master
        self.configured, self.given = configured, given

    def get(self, key, default=None):
        return self.configured if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.given

    def setCheckpointDir(self, path):
        self.given = path


def test_output_root_uses_checkpoint_dir_and_invents_none(spark):
    assert output_root(spark).startswith(checkpoint_dir(spark))
    for master in ("local[4]", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError):
            output_root(_Session(master))
    cluster, local, named = _Session("yarn"), _Session("local[*]"), _Session("local[*]", configured="/shared")
    for session in (cluster, local, named):
        scratch_checkpoint_dir(session)  # local sessions may ask for one
    assert cluster.given is None and os.path.isdir(checkpoint_dir(local)) and named.given is None
    assert checkpoint_dir(named) == "/shared"


def test_materialised_inputs_and_command_line_job(spark, scratch_dir):
    from usagelens.plans.run_all import main
    from usagelens.plans import rate_plan_trends
    from usagelens.sources.files import write_inputs
    inp = load_inputs(spark, SF0001)
    paths = write_inputs(inp, os.path.join(scratch_dir, "inputs"))
    back = load_inputs_from_paths(spark, paths)
    assert rows(activity_snapshot(back)) == rows(activity_snapshot(inp))
    out = os.path.join(scratch_dir, "out")
    main(["--voice", paths["voice_call_record"], "--sms", paths["sms_record"],
          "--volume", paths["mobile_data_activity"], "--subscriber", paths["subscriber"],
          "--rate-plans", paths["rate_plan_product"], "--locations", paths["location"],
          "--out", out])
    assert rows(read_table(spark, RATE_PLAN_TRENDS, path=os.path.join(out, "trends"))) == \
        rows(rate_plan_trends(inp))
    docs = read_documents(spark, os.path.join(out, "network_docs"))
    assert rows(docs.drop("_id")) == rows(to_documents(network_activity(inp)).drop("_id"))


def test_lenient_run_all_writes_its_rejects(spark, scratch_dir):
    inp = make_inputs(spark, voice=[("x", 1, "L1"), ("1", 2, None)], sms=[("1", "n", "L1")],
                      volume=[("1", "bad", "1", 1, 1)], subscriber=["1,a,b,c,d,40", "broken", "2,a,b,c,d,-4"],
                      locations=[("L1", "EU")])
    out = {k: os.path.join(scratch_dir, k) for k in ("activity", "trends", "network")}
    with pytest.raises(ValueError):
        run_all(inp, out, mode="lenient")
    run_all(inp, out | {"rejects": os.path.join(scratch_dir, "rejects")}, mode="lenient")
    got = rows(read_table(spark, REJECTS, path=os.path.join(scratch_dir, "rejects")), "product", "source", "reason")
    assert got == [
        ("activity", "mobile_data_activity", "volume is not an integer"),
        ("activity", "voice_call_record", "subscription_id is not an integer"),
        ("network", "voice_call_record", "null location code"),
        ("trends", "subscriber", "line has no integer age in field 5"),
        ("trends", "subscriber", "negative age")]


def test_truncation_cuts_facts_and_catalogue(spark):
    inp = make_inputs(spark, sms=[("1", "n", "AUSTRALIA-SYDNEY-1"), ("2", "n", "AUSTRALIA-SYDNEY-2")],
                      locations=[("AUSTRALIA-SYDNEY-1", "AU"), ("AUSTRALIA-SYDNEY-2", "AU")])
    from usagelens.plans.network import country_lookup
    assert rows(country_lookup(inp, "sms"), "country", "n_records") == [("AU", 1), ("AU", 1)]
    assert rows(country_lookup(inp, "sms", truncate_ids=True), "country", "n_records") == [("AU", 2)]


def test_cluster_conf():
    from usagelens.session import cluster_conf
    conf = cluster_conf(executors=1000, cores_per_executor=4, split_bytes=512 * 1024 ** 2)
    assert conf["spark.sql.shuffle.partitions"] == "16000"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.files.maxPartitionBytes"] == str(512 * 1024 ** 2)
    assert cluster_conf(2, 4)["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 ** 2)


def test_every_dirty_record_is_used_or_rejected(spark):
    from usagelens.plans import activity, network, trends
    from usagelens.plans.rejects import rejects
    from usagelens.sources.testdata import load_inputs as load
    inp = load(spark, SF0001, dirty=True)
    bad = {(r["product"], r["source"]): r["count"] for r in rejects(inp).groupBy("product", "source").count().collect()}
    voice, sms = inp.voice_call_record.count(), inp.sms_record.count()
    usage, lines = inp.mobile_data_activity.count(), inp.subscriber.count()
    ids = {name: activity._with_id(scan(inp, name), "lenient").count() for name in ("voice_call", "sms_rec")}
    assert voice == ids["voice_call"] + bad.get(("activity", "voice_call_record"), 0)
    assert sms == ids["sms_rec"] + bad.get(("activity", "sms_record"), 0)
    assert usage == activity._with_id(activity.clean_volumes(inp, "lenient"), "lenient").count() \
        + bad["activity", "mobile_data_activity"]
    assert usage == trends.plan_usage(inp, mode="lenient").count() + bad["trends", "mobile_data_activity"]
    assert lines == trends.subscriber_age_bands(inp, "lenient").count() + bad["trends", "subscriber"]
    assert sms == network.location_records(inp, "sms", "lenient").count() + bad["network", "sms_record"]
    assert voice == network.location_records(inp, "voice", "lenient").count() + bad["network", "voice_call_record"]
