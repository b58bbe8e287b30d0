"""Version assignment on hand-made deliveries, and equality of formulations on random ones."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.columns import DELETED
from tidemark.operators import cdc, gold, incremental, policies, reconcile, scd2

SCHEMA = "tenant_id string, entity_key string, _row_hash string, _ingest_seq long, _ingest_ts timestamp_ntz, _batch_id string, _source_file string, _load_mode string, status string, modified_ts timestamp_ntz"
T0 = datetime(2026, 1, 1)


def staged(spark, rows):
    """rows: (entity, seq, hash, mode, file[, modified[, tenant]])"""
    full = []
    for r in rows:
        key, seq, h, mode, file = r[:5]
        modified = r[5] if len(r) > 5 else None
        tenant = r[6] if len(r) > 6 else "t"
        full.append((tenant, key, h, seq, T0 + timedelta(days=seq), f"b-{file}", file, mode, f"s{h}", modified))
    return spark.createDataFrame(full, SCHEMA)


def versions(spark, rows, **k):
    got = scd2.assign_versions(staged(spark, rows), **k).orderBy("tenant_id", "entity_key", "version_no").collect()
    return got


def test_first_delivery(spark):
    (v,) = versions(spark, [("e1", 1, "h1", "full", "f1")])
    assert (v.version_no, v.is_current, v._change_reason) == (1, True, "new")
    assert v.valid_to == datetime(9999, 12, 31)


def test_resend_is_no_version(spark):
    assert len(versions(spark, [("e1", 1, "h1", "full", "f1"), ("e1", 2, "h1", "full", "f2")])) == 1


def test_change_closes_the_old_version(spark):
    a, b = versions(spark, [("e1", 1, "h1", "full", "f1"), ("e1", 2, "h2", "full", "f2")])
    assert a.valid_to == b.valid_from and not a.is_current and b.is_current and b._change_reason == "changed"


def test_event_time_and_its_absence(spark):
    when = datetime(2025, 6, 1)
    a, b = versions(spark, [("e1", 1, "h1", "full", "f1", when), ("e2", 2, "h1", "full", "f1")], event_time="modified_ts")
    assert a.valid_from == when and b.valid_from == T0 + timedelta(days=2)


ABSENCE = [("e1", 1, "h1", "full", "f1"), ("e2", 2, "h2", "full", "f1"), ("e1", 3, "h1", "full", "f2")]


def test_absence_in_a_full_load_deletes(spark):
    got = [v for v in versions(spark, ABSENCE) if v.entity_key == "e2"]
    assert [v._change_reason for v in got] == ["new", "deleted"] and not any(v.is_current for v in got)
    assert got[1]._row_hash == DELETED and got[1].status == "sh2" and got[1]._source_file == "f2" and got[1]._ingest_seq == 3


def test_omission_in_a_delta_does_not(spark):
    got = versions(spark, [*ABSENCE[:2], ("e1", 3, "h1", "delta", "d2")])
    assert all(v.is_current for v in got)


def test_no_full_load_no_deletions(spark):
    assert scd2.deletion_events(staged(spark, [("e1", 1, "h1", "delta", "d1"), ("e2", 2, "h1", "delta", "d2")])).count() == 0


def test_repeated_absence_is_one_deletion(spark):
    rows = [*ABSENCE, ("e1", 4, "h1", "full", "f3")]
    assert scd2.deletion_events(staged(spark, rows)).count() == 2
    assert [v._change_reason for v in versions(spark, rows) if v.entity_key == "e2"] == ["new", "deleted"]


def test_reappearance_and_second_deletion(spark):
    rows = [*ABSENCE, ("e2", 4, "h2", "delta", "d1"), ("e1", 5, "h1", "full", "f3")]
    assert [v._change_reason for v in versions(spark, rows) if v.entity_key == "e2"] == ["new", "deleted", "changed", "deleted"]


def test_back_to_an_old_value_is_a_version(spark):
    assert len(versions(spark, [("e1", i, h, "delta", f"d{i}") for i, h in enumerate("aba", 1)])) == 3


def test_rows_without_key_are_never_deleted(spark):
    got = versions(spark, [(None, 1, "h1", "full", "f1"), ("e1", 2, "h1", "full", "f2")])
    assert all(v._change_reason != "deleted" for v in got)


def test_two_tenants_share_a_key(spark):
    got = versions(spark, [("e1", 1, "h1", "full", "f1"), ("e1", 2, "h1", "full", "g1", None, "u"), ("e2", 3, "h1", "full", "g2", None, "u")])
    assert [(v.tenant_id, v.entity_key, v._change_reason) for v in got] == [("t", "e1", "new"), ("u", "e1", "new"), ("u", "e1", "deleted"), ("u", "e2", "new")]


def test_repeated_key_in_one_file_and_backward_time_are_reported(spark):
    rows = [("e1", 1, "h1", "full", "f1", datetime(2026, 5, 1)), ("e1", 2, "h2", "full", "f1", datetime(2026, 5, 1)), ("e1", 3, "h3", "delta", "d1", datetime(2026, 4, 1))]
    v = scd2.assign_versions(staged(spark, rows), "modified_ts")
    assert sorted(r.kind for r in reconcile.bad_intervals(v).collect()) == ["empty", "inverted"]
    assert reconcile.late_arrivals(staged(spark, rows), "modified_ts").count() == 1


def random_rows(seed):
    rng = random.Random(seed)
    rows, seq = [], 0
    for tenant in ("t", "u"):
        for f in range(7):
            mode = rng.choice(("full", "delta"))
            keys = [k for k in ("e1", "e2", "e3", "e4", None) if rng.random() < 0.6]
            for k in keys:
                for _ in range(1 if rng.random() < 0.8 else 2):
                    seq += 1
                    rows.append((k, seq, rng.choice("abc"), mode, f"{tenant}{f}", None, tenant))
    return rows


def plain_versions(rows):
    """The definition, entity by entity and file by file."""
    out = []
    by_tenant = {}
    for r in rows:
        by_tenant.setdefault(r[6], []).append(r)
    for tenant, rs in by_tenant.items():
        files = {}
        for r in rs:
            files.setdefault(r[4], []).append(r)
        fulls = [(min(x[1] for x in v), max(x[1] for x in v), v) for v in files.values() if v[0][3] == "full"]
        for key in {r[0] for r in rs}:
            own = [(r[1], r[2]) for r in rs if r[0] == key]
            if key is not None:
                for lo, hi, v in fulls:
                    if any(s < lo for s, _ in own) and not any(x[0] == key for x in v):
                        own.append((hi, DELETED))
            chain = []
            for s, h in sorted(own):
                if not chain or chain[-1][1] != h:
                    chain.append((s, h))
            out += [(tenant, key, i + 1, s, h) for i, (s, h) in enumerate(chain)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_random_deliveries_follow_the_definition(spark, seed):
    rows = random_rows(seed)
    got = [(v.tenant_id, v.entity_key, v.version_no, v._ingest_seq, v._row_hash) for v in versions(spark, rows)]
    assert sorted(got, key=repr) == plain_versions(rows)


@pytest.mark.parametrize("seed", range(3))
def test_slices_equal_a_rebuild(spark, seed):
    rows = random_rows(seed + 10)
    s = staged(spark, rows)
    whole = scd2.assign_versions(s)
    borders = [max(r[1] for r in rows if r[4] == f) for f in sorted({r[4] for r in rows}, key=lambda f: min(r[1] for r in rows if r[4] == f))]
    cut = borders[len(borders) // 2]
    merged = incremental.merge_slice(scd2.assign_versions(s.where(F.col("_ingest_seq") <= cut)), s, cut)
    assert reconcile.differences(whole, merged).first() == (0, 0)


def test_versions_match_the_applied_feed(spark):
    s = staged(spark, [r for r in random_rows(3) if r[0]])
    live = reconcile.live(scd2.assign_versions(s)).select("tenant_id", "entity_key", "_row_hash", F.col("_ingest_seq").alias("__START_AT"))
    feed = cdc.staged_feed(s).select("tenant_id", "entity_key", "_row_hash", F.col("_ingest_seq").alias("seq"), "op")
    assert reconcile.differences(live, cdc.apply_changes(feed, ["tenant_id", "entity_key"]).drop("__END_AT")).first() == (0, 0)


def test_policies(spark):
    s = staged(spark, [*ABSENCE, ("e1", 4, "h9", "delta", "d1")])
    assert [(r.entity_key, r._row_hash) for r in policies.current_only(s).collect()] == [("e1", "h9")]
    assert {r.entity_key: r.is_deleted for r in policies.current_only(s, soft=True).collect()} == {"e1": False, "e2": True}
    assert sorted(r._row_hash for r in policies.insert_only(s).collect()) == ["h1", "h2"]
    assert policies.append_only(s).count() == 4
    assert policies.snapshot(s, "_ingest_ts").count() == 3


def test_gold_views(spark):
    v = scd2.assign_versions(staged(spark, ABSENCE))
    assert [r.entity_key for r in gold.current(v).collect()] == ["e1"]
    at = F.lit(T0 + timedelta(days=2, hours=12)).cast("timestamp_ntz")
    assert sorted(r.entity_key for r in gold.asof(v, at).collect()) == ["e1", "e2"]
    assert gold.deleted_timelines(v).count() == 2
    v.createOrReplaceTempView("tv")
    gold.create_asof_function(spark, "tv_asof", "tv", {"entity_key": "STRING"})
    assert spark.sql("SELECT * FROM tv_asof(TIMESTAMP_NTZ'2026-01-10 00:00:00')").count() == 1


def test_one_shuffle_for_all_windows(spark):
    """Collapse, numbering and validity share one exchange and one sort per entity."""
    s = staged(spark, ABSENCE)
    plan = s.sparkSession._jvm.PythonSQLUtils.explainString(scd2.number_versions(scd2.collapse(s))._jdf.queryExecution(), "simple")
    body = plan.split("== Initial Plan ==")[-1]
    assert body.count("Exchange hashpartitioning(tenant_id") == 1 and body.count("Window [") >= 2


@pytest.mark.parametrize("small", [True, False])
def test_entities_are_spread_beyond_their_tenant(spark, monkeypatch, small):
    """Without automatic broadcasts, rows are dealt by (tenant, entity) before files are joined, and carry no list of files."""
    monkeypatch.setattr(scd2, "BROADCAST_FILES", 50_000 if small else -1)
    s = staged(spark, ABSENCE)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        v = scd2.assign_versions(s)
        plan = spark._jvm.PythonSQLUtils.explainString(v._jdf.queryExecution(), "simple").split("== Initial Plan ==")[-1]
        rows = sorted(tuple(r) for r in v.select("entity_key", "version_no", "_row_hash", "is_current").collect())
    finally:
        spark.conf.set(key, old)
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "entity_key" in line]
    assert first and "_files" not in plan and "array<struct" not in plan
    if small:
        assert len(first) == 1 and "SortMergeJoin" not in plan
    assert rows == [("e1", 1, "h1", True), ("e2", 1, "h2", False), ("e2", 2, "__deleted__", False)]


def plain_absences(rows):
    """(entity, full file) pairs by the definition: known before the file, not in it."""
    files = {}
    for e, seq, _, mode, f in rows:
        files.setdefault(f, [mode, seq, seq, set()])
        files[f][1], files[f][2] = min(files[f][1], seq), max(files[f][2], seq)
        files[f][3].add(e)
    return sorted((e, hi) for f, (mode, lo, hi, es) in files.items() if mode == "full" for e in {r[0] for r in rows if r[1] < lo and r[0]} - es)


def test_absences_of_random_deliveries(spark):
    import random

    rng = random.Random(9)
    for _ in range(3):
        rows, seq = [], 0
        for f in range(14):
            mode = rng.choice(("full", "delta"))
            for e in rng.sample(["a", "b", "c", "d", None], rng.randint(1, 4)):
                seq += 1
                rows.append((e, seq, f"h{rng.randint(1, 2)}", mode, f"f{f}"))
        got = sorted((r.entity_key, r._ingest_seq) for r in scd2.deletion_events(staged(spark, rows)).collect())
        assert got == plain_absences(rows)


def test_pit_join_nulls_and_overlaps(spark):
    import random

    rng = random.Random(10)
    left = [(i, rng.choice(("a", "b", None)), rng.randint(0, 60)) for i in range(120)]
    right = [("a", 0, 100, 1), ("a", 5, 6, 2), ("a", 5, 9, 3), ("a", 20, 20, 4), ("a", 30, 25, 5), (None, 0, 99, 6)] + [("b", 7 * k, 7 * k + 5, 10 + k) for k in range(8)]
    lt = spark.createDataFrame(left, "id int, k string, t int")
    rt = spark.createDataFrame(right, "k string, valid_from int, valid_to int, v int")
    want = {}
    for i, k, t in left:
        met = [(lo, hi, v) for key, lo, hi, v in right if key == k is not None and lo <= t < hi]
        want[i] = max(met)[2] if met else None
    assert {r.id: r.v for r in gold.pit_join(lt, rt, ["k"], "t", ["v"]).collect()} == want


def test_numbers_within_a_file_by_coarse_values(spark):
    import hashlib

    from tidemark.operators.sequencing import ingest_seq

    rows = [(f"f{i % 3}", i % 3, hashlib.sha256(str(i % 70).encode()).hexdigest(), i) for i in range(300)]
    df = spark.createDataFrame(rows, "f string, o int, h string, i int")
    one = ingest_seq(df, "f", ["o"], ["h", "i"], 7)
    two = ingest_seq(df, "f", ["o"], ["h", "i"], 7, coarse=F.substring("h", 1, 1))
    assert sorted(map(tuple, one.select("i", "_ingest_seq").collect())) == sorted(map(tuple, two.select("i", "_ingest_seq").collect()))


# the change feed of the fixtures: three extracts, D vanishes in the last
EXTRACTS = [(e, a, s, m) for s, m, es in ((1, "full", {"A": "a1", "B": "a1", "C": "a1", "D": "a1"}), (2, "delta", {"B": "a2", "C": "a1", "E": "a1"}), (3, "full", {"A": "a1", "B": "a3", "C": "a1", "E": "a1"})) for e, a in es.items()]


def test_feed_and_its_application(spark, tmp_path):
    ex = spark.createDataFrame(EXTRACTS, "entity_id string, attr_a string, extract_seq int, load_mode string")
    feed = cdc.change_feed(ex, ["entity_id"], ["attr_a"])
    ops = [(r.op, r.entity_id, r.seq) for r in feed.collect()]
    assert len(ops) == 12 and [o for o in ops if o[0] == "DELETE"] == [("DELETE", "D", 3)]
    target = cdc.apply_changes(feed, ["entity_id"])
    rows = {(r.entity_id, r.attr_a, r["__START_AT"], r["__END_AT"]) for r in target.collect()}
    assert len(rows) == 7 and sorted(r[0] for r in rows if r[3] is None) == ["A", "B", "C", "E"]
    assert ("D", "a1", 1, 3) in rows and ("B", "a2", 2, 3) in rows
    assert sorted(r.entity_id for r in cdc.apply_changes(feed, ["entity_id"], scd_type=1).collect()) == ["A", "B", "C", "E"]
    # as a stream, in two batches, replayed
    from tidemark.plans.storage import Store
    from tidemark.streaming.feed import apply_stream, read_feed, target_of

    store = Store(spark, str(tmp_path / "store"))
    folder = str(tmp_path / "feed")
    for part in ("seq >= 2", "seq < 2"):
        feed.where(part).write.mode("append").parquet(folder)
        apply_stream(read_feed(spark, folder, feed.schema), store, "entities", ["entity_id"], str(tmp_path / "cp"))
    assert {(r.entity_id, r.attr_a, r["__START_AT"], r["__END_AT"]) for r in target_of(store, "entities", ["entity_id"]).collect()} == rows


def test_untracked_columns_make_no_versions(spark):
    feed = spark.createDataFrame([("A", "x", "b1", 1, "UPSERT"), ("A", "x", "b2", 2, "UPSERT"), ("A", None, "b3", 3, "UPSERT"), ("A", None, None, 4, "DELETE"), ("A", None, None, 5, "DELETE")], "k string, v string, batch string, seq int, op string")
    got = [(r.v, r.batch, r["__START_AT"], r["__END_AT"]) for r in cdc.apply_changes(feed, ["k"], untracked=["batch"]).orderBy("__START_AT").collect()]
    assert got == [("x", "b1", 1, 3), (None, "b3", 3, 4)]


def test_change_feed_within_tenants(spark):
    rows = [("a", "x", 1, "full"), ("a", "y", 2, "full"), ("b", "x", 1, "full"), ("b", "y", 3, "full")]
    df = spark.createDataFrame(rows, "tenant string, k string, extract_seq int, load_mode string").withColumn("attr", F.lit("v"))
    feed = cdc.change_feed(df, ["tenant", "k"], ["attr"], within=["tenant"])
    assert sorted((r.tenant, r.k, r.seq) for r in feed.collect() if r.op == "DELETE") == [("a", "x", 2), ("b", "x", 3)]


def test_pit_join_of_all_events(spark):
    import os

    from tidemark.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    assert QUERIES["pit_join"](spark, sf).count() == spark.read.parquet(f"{sf}/events.parquet").count()
