"""Queries on tables like the larger scales': numbers of users, files and texts that the small ones do not reach."""

import duckdb
import pytest
from compare import same
from conftest import SF
from pyspark.sql import functions as F

from edgelens.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    """Events of users on both sides of 255, where the view's mapped addresses stop being addresses."""
    path = tmp_path_factory.mktemp("users")
    user = F.col("event_id") * 17 % 600
    spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", user).write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/events.parquet/*.parquet'")
    return str(path), con




@pytest.mark.parametrize("name", ["a5_ip_prefixes", "a6_ip_sni", "a7_fingerprints", "a8_fingerprint_ips", "a9_block_counts", "c2_sni_sentinel", "c3_sni_per_ip", "c5_block_counts", "k3_sampled_ips", "f6_connection_intake", "j5_ip_dimension"])
def test_connections_of_users_above_255(spark, many_users, name):
    same(QUERIES[name](spark, many_users[0]), many_users[1], ORACLES[name])


def test_tasks_do_not_grow_with_the_table(spark, monkeypatch):
    from edgelens import runtime

    monkeypatch.setattr(runtime, "SPREAD_ROWS", 20)
    rows = QUERIES["p_request_facts"](spark, SF)
    sizes = [n for n in rows.rdd.mapPartitions(lambda r: [sum(1 for _ in r)]).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 25


def test_the_address_dimension_of_events_derives_no_facts(spark, monkeypatch):
    from edgelens.operators import addresses

    plans, taken = [], addresses.ip_dimension

    def watched(rows, col="remote_addr", v6=True):
        plans.append(rows.select(col)._jdf.queryExecution().optimizedPlan().toString())
        return taken(rows, col, v6)

    monkeypatch.setattr(addresses, "ip_dimension", watched)
    QUERIES["p33_request_events"](spark, SF)
    assert len(plans) == 1 and "map" not in plans[0] and "Filter" not in plans[0]


def test_scores_of_one_time_rank_by_arrival(spark, tmp_path):
    """Events of equal times, as a larger table has them; DuckDB takes the last row of the file there, on one thread always."""
    con = duckdb.connect(config={"threads": 1})
    for cut in ("hour", "day"):
        path = str(tmp_path / f"{cut}.parquet")
        con.execute(f"copy (select * replace (date_trunc('{cut}', ts) as ts) from '{SF}/events.parquet' order by event_id) to '{path}'")
        con.execute(f"create or replace view events as select * from '{path}'")
        events = tmp_path / cut
        spark.read.parquet(path).repartition(5, "user_id").write.parquet(f"{events}/events.parquet")
        same(QUERIES["j6_rank_upstreams"](spark, str(events)), con, ORACLES["j6_rank_upstreams"])


def test_scores_of_one_time_without_arrival(spark):
    from edgelens.operators import addresses

    rows = [("u", 10, float(x)) for x in (3, 9, 5)]
    at = lambda df: df.withColumn("ts", F.timestamp_seconds("ts"))
    points = at(spark.createDataFrame([(1, 10, 0, "u", True, 0), (2, 4000, 0, "u", True, 0)], "point int, ts long, pos int, dial string, available boolean, inflight long"))
    for turn in range(3):
        scores = at(spark.createDataFrame(rows[turn:] + rows[:turn], "dial string, ts long, score double").coalesce(1))
        assert [r.score for r in addresses.rank_upstreams(points, scores, 1e12).sort("point").collect()] == pytest.approx([9.0, 9.0])


@pytest.fixture
def small_batches(spark):
    """Batches of three rows, as a task's last one may be: of many all headers are absent."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)


def test_forwarded_addresses_of_batches_without_any(spark, duck, small_batches):
    same(QUERIES["p18_forwarded_ips"](spark, SF), duck, ORACLES["p18_forwarded_ips"])


def test_identity_of_batches_without_any_address(spark, duck, small_batches):
    same(QUERIES["r4_redact_identity"](spark, SF), duck, ORACLES["r4_redact_identity"])


def test_identity_of_one_row_without_headers(spark):
    from edgelens.operators import exemptions

    rows = spark.createDataFrame([(None, "10.0.0.1", None, None, None)], "ua string, remote_addr string, xff string, cdn_ip string, hash_ip string")
    out = exemptions.redact_identity(exemptions.with_forwarded_ip(rows), [("X-Tag", "10.0.0.1"), ("X-Key", "long enough")]).first()
    assert (out.ua, out.forwarded_ip, out.hash_ip) == (None, "::", None)
