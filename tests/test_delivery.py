"""Cache commits, delivery ledger, isolation of sources, circuit breaker."""

import time

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import match
from lodestrata.plans import pipeline
from lodestrata.sources import cache, delivery

SCHEMA = "cache_key string, v int"


def held(spark, path):
    return {r.cache_key: r.v for r in cache.read(spark, path, SCHEMA).collect()}


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def test_commits(spark, tmp_path):
    path = str(tmp_path / "c")
    assert held(spark, path) == {}
    assert cache.commit(rows(spark, a=1, b=2), path) == 1
    first = held(spark, path)
    folders = cache.latest(spark, path)[1]
    assert cache.commit(rows(spark, b=3).unionByName(spark.createDataFrame([(None, 9)], SCHEMA)), path) == 2
    assert first == {"a": 1, "b": 2} and held(spark, path) == {"a": 1, "b": 3}
    kept = [b for b in folders if cache.latest(spark, path)[1][b] == folders[b]]
    assert len(kept) == len(folders) - 1  # only the touched bucket was written


def test_two_writers_lose_nothing_and_a_crash_leaves_a_whole_cache(spark, tmp_path):
    path = str(tmp_path / "c")
    cache.commit(rows(spark, a=1), path)
    others = iter([lambda: cache.commit(rows(spark, b=2), path), lambda: cache.commit(rows(spark, a=5, c=3), path)])
    assert cache.commit(rows(spark, d=4, c=9), path, before_swap=lambda: next(others, lambda: None)()) == 4
    assert held(spark, path) == {"a": 5, "b": 2, "c": 9, "d": 4}

    def crash():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        cache.commit(rows(spark, a=100), path, before_swap=crash)
    assert held(spark, path)["a"] == 5
    (tmp_path / "c" / "manifests" / "000000000005.json").write_text("{broken")
    assert held(spark, path)["a"] == 5 and cache.commit(rows(spark, a=6), path) == 6 and held(spark, path) == {"a": 6, "b": 2, "c": 9, "d": 4}


def test_delivery_repeats_no_acknowledged_batch(spark, tmp_path):
    tracks = spark.createDataFrame([("p", str(i % 250), i) for i in range(400)] + [("q", "7", 1), ("q", "", 2), ("q", None, 3), ("q", "x", 4)], "playlist string, id string, pos int").repartition(4)
    payload = delivery.batches(tracks, "playlist", "id", "pos", numeric=True)
    got = {(r.playlist, r.batch): r.ids for r in payload.collect()}
    assert got == {("p", 0): [str(i) for i in range(100)], ("p", 1): [str(i) for i in range(100, 200)], ("p", 2): [str(i) for i in range(200, 250)], ("q", 0): ["7"]}
    ledger, log = str(tmp_path / "ledger"), tmp_path / "log"
    log.mkdir()

    def sender(broken):
        def send(playlist, key, ids):
            if broken and ids[0] in ("100", "7"):
                raise OSError("down")
            (log / f"{key}-{time.time_ns()}").write_text(ids[0])

        return send

    first = delivery.deliver(payload, ledger, sender(True), 1)
    assert sorted((r.playlist, r.batch, r.ok, r.error) for r in first.collect()) == [("p", 0, True, None), ("p", 1, False, "down"), ("p", 2, True, None), ("q", 0, False, "down")]
    assert {r.playlist: (r.batches_sent, r.ids_sent, r.batches_failed, r.ids_failed) for r in delivery.report(first).collect()} == {"p": (2, 150, 1, 100), "q": (0, 0, 1, 1)}
    second = delivery.deliver(payload, ledger, sender(False), 2)
    assert sorted((r.playlist, r.batch, r.ok) for r in second.collect()) == [("p", 1, True), ("q", 0, True)]
    assert delivery.deliver(payload, ledger, sender(False), 3).collect() == []
    assert sorted(f.read_text() for f in log.iterdir()) == ["0", "100", "200", "7"]
    assert delivery.ledger(spark, ledger).count() == 6


def test_sources_run_apart(spark, tmp_path):
    def sleeps(parts):
        time.sleep(60)
        yield from parts

    ok = pipeline.Source("ok", lambda s, c: s.range(5))
    in_task = pipeline.Source("task", lambda s, c: s.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x")))
    in_plan = pipeline.Source("plan", lambda s, c: s.range(3).select("nothing"))
    endless = pipeline.Source("endless", lambda s, c: s.range(2).mapInPandas(sleeps, "id long"))
    config = pipeline.PipelineConfig(as_of="2026-01-01")
    began = time.time()
    parts, status = pipeline.run_isolated(spark, [in_task, ok, in_plan, endless, pipeline.Source("last", lambda s, c: s.range(2))], config, str(tmp_path), 6)
    assert time.time() - began < 50
    assert {n: df.count() for n, df in parts} == {"ok": 5, "last": 2}
    got = {r.name: (r.success, r["rows"], r.error) for r in status.collect()}
    assert got["ok"] == (True, 5, None) and got["last"] == (True, 2, None)
    assert not got["task"][0] and "boom" in got["task"][2] and not got["plan"][0] and got["endless"][2].startswith("not done")
    with pytest.raises(RuntimeError, match="source task"):
        pipeline.run_isolated(spark, [in_task], pipeline.PipelineConfig(as_of="2026-01-01", continue_on_source_error=False), str(tmp_path))


def test_breaker(spark):
    asked = spark.createDataFrame([(i, i * 2, "ab"[i % 2]) for i in range(10)], "query_id int, rank int, interface string")
    refusals = spark.createDataFrame([(4, "a"), (8, "a"), (99, "b"), (3, "a"), (4, "a")], "query_id int, interface string")
    got = {r.query_id: r.breaker for r in match.breaker(asked, refusals).collect()}
    assert got == {0: None, 2: None, 4: "rate_limited", 6: "deferred", 8: "deferred", 1: None, 3: None, 5: None, 7: None, 9: None}
