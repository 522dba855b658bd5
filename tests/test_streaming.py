from slotwise.streaming import streams

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def source(spark):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)


def put(spark, path, rows):
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", df["ts"].cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).collect()


def test_budget_in_windows(spark, tmp_path):
    put(spark, str(tmp_path), [(i, f"2024-01-01 00:0{i}:00", 1, "a", 1.0, "") for i in range(6)] + [(9, "2024-01-01 02:00:00", 1, "a", 1.0, "")])
    rows = drain(streams.budget(source(spark).parquet(str(tmp_path)), "ts", ["user_id"], "300 seconds", "300 seconds"), "budget", "complete")
    assert sorted(r["requests"] for r in rows) == [1, 1, 5]


def test_queue_takes_each_key_once(spark, tmp_path):
    put(spark, str(tmp_path), [(1, "2024-01-01 00:00:00", 1, "a", 1.0, ""), (2, "2024-01-01 00:00:01", 2, "a", 1.0, ""), (3, "2024-01-01 00:00:02", 1, "a", 1.0, "")])
    rows = drain(streams.unseen(source(spark).parquet(str(tmp_path)), "ts", ["user_id"]), "queue")
    assert sorted(r["user_id"] for r in rows) == [1, 2]


def test_upserting_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [(1, "2024-01-01", 1, "a", 1.0, ""), (2, "2024-01-01", 1, "b", 2.0, ""), (3, "2024-01-01", 2, "a", 3.0, "")])
    streams.upserting(source(spark).parquet(folder), out, ["user_id"], "event_id", str(tmp_path / "c")).awaitTermination()
    put(spark, folder, [(4, "2024-01-02", 2, "c", 4.0, "")])
    streams.upserting(source(spark).parquet(folder), out, ["user_id"], "event_id", str(tmp_path / "c")).awaitTermination()
    assert sorted((r["user_id"], r["event_type"]) for r in spark.read.parquet(f"{out}/v=1").collect()) == [(1, "b"), (2, "c")]


def test_upserts_write_what_they_touch(spark, tmp_path):
    folder, out, c = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")

    def files():
        return {(p.parent.name, p.name) for p in (tmp_path / "out").rglob("*.parquet")}

    def run():
        streams.upserting_buckets(source(spark).parquet(folder), out, ["user_id"], "event_id", c, buckets=8).awaitTermination()
        return sorted((r["user_id"], r["event_id"], r["event_type"]) for r in streams.upserted(spark, out).collect())

    put(spark, folder, [(i, "2024-01-01", i % 50, "a", 1.0, "") for i in range(200)])
    assert run() == [(u, 150 + u, "a") for u in range(50)]
    before = files()
    put(spark, folder, [(1000, "2024-01-02", 3, "c", 4.0, ""), (7, "2024-01-02", 7, "late", 4.0, ""), (1001, "2024-01-02", 3, "d", 4.0, "")])
    want = [(u, 1001 if u == 3 else 150 + u, "d" if u == 3 else "a") for u in range(50)]
    assert run() == want
    assert len(before - files()) <= 2 and len(before & files()) >= 6  # buckets of 3 and 7
    put(spark, folder, [(2000, "2024-01-03", 77, "e", 4.0, "")])
    assert run() == [*want, (77, 2000, "e")]
    # a batch that runs again, and an older one that comes late
    again = spark.createDataFrame([(1000, "x", 3), (2000, "e", 77)], "event_id long, event_type string, user_id long")
    batch = again.selectExpr("event_id", "timestamp'2024-01-02' AS ts", "user_id", "event_type", "4D AS value", "'' AS props")
    for _ in range(2):
        streams.upsert_batch(batch, 1, folder=out, key=["user_id"], seq="event_id", buckets=8)
    assert sorted((r["user_id"], r["event_id"], r["event_type"]) for r in streams.upserted(spark, out).collect()) == [*want, (77, 2000, "e")]


def test_queue_forgets_restarts_and_drops_late_rows(spark, tmp_path):
    folder, c = str(tmp_path / "in"), str(tmp_path / "c")

    def run():
        out = streams.queue(source(spark).parquet(folder), "ts", ["user_id", "event_type"], keep="2 hours", late="10 minutes")
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", c).trigger(availableNow=True).start()
        q.awaitTermination()
        rows = spark.read.schema("user_id long, event_type string, queued_ms long").parquet(str(tmp_path / "out")).collect()
        state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        return [(r["user_id"], r["event_type"], r["queued_ms"] // 60_000) for r in rows], state[-1]

    def at(minutes):
        return f"1970-01-01 {minutes // 60:02d}:{minutes % 60:02d}:00"

    put(spark, folder, [(1, at(5), 1, "a", 1.0, ""), (2, at(3), 1, "a", 1.0, ""), (3, at(4), 2, None, 1.0, "")])
    first, _ = run()
    assert sorted(first) == [(1, "a", 3), (2, None, 4)]
    # from the checkpoint: seen keys stay queued, and key 1 is seen again later
    put(spark, folder, [(4, at(100), 1, "a", 1.0, ""), (5, at(101), 3, "b", 1.0, "")])
    second, many = run()
    assert {*second} == {*first, (3, "b", 101)}
    # two hours after its last sighting key 2 is forgotten, and what comes before the watermark is dropped
    put(spark, folder, [(6, at(150), 4, "c", 1.0, "")])
    put(spark, folder, [(7, at(152), 2, None, 1.0, ""), (8, at(20), 9, "late", 1.0, "")])
    third, _ = run()
    assert {*third} == {*second, (4, "c", 150), (2, None, 152)}
    put(spark, folder, [(9, at(900), 5, "d", 1.0, "")])
    put(spark, folder, [(10, at(901), 5, "d", 1.0, "")])
    fourth, few = run()
    assert sorted(fourth) == sorted([*third, (5, "d", 900)]) and few < many
