import datetime as dt
import json
import time

from conftest import AS_OF, ORDER, control, message
from pyspark.sql import functions as F

from waybill.operators import extract, storage
from waybill.operators.rows import dedupe_latest, dedupe_repeated, repeated_keys
from waybill.plans import messages
from waybill.sources import messages as source
from waybill.streaming import alerts, jobs


def write(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) for m in messages))


def order(number, docnum, total="10.00", ts="2022-11-03T10:00:00.000Z", day="20221103"):
    data = json.loads(json.dumps(ORDER))
    data["E1EDK01"][0]["belnr"] = number
    data["E1EDK03"][1]["datum"] = day
    data["E1EDS01"][0]["summe"] = total
    return message("ORDERS", "ORDERS05", data, ts=ts, ctl=control(docnum))


def test_files_to_bronze_once(spark, tmp_path):
    write(tmp_path / "in", "a.json", order("O1", "1"), order("O2", "2"))
    args = (str(tmp_path / "bronze"), str(tmp_path / "cp"))
    for name in (None, "b.json"):
        if name:
            write(tmp_path / "in", name, order("O3", "3", ts="2022-11-04T01:00:00.000Z"))
        source.land(source.stream_files(spark, str(tmp_path / "in")), *args).awaitTermination()
    bronze = spark.read.parquet(args[0])
    rows = {r.docnum: r for r in bronze.collect()}
    assert set(rows) == {"1", "2", "3"} and rows["3"].source_file == "b.json"
    assert str(rows["3"].ingest_day) == "2022-11-04" and rows["1"].sender == "NORTH"
    assert rows["1"].ingestion_time is not None
    assert source.newer_rows(bronze, bronze.filter("docnum < 3")).count() == 1


def test_silver_by_route_late_and_redelivered(spark, tmp_path):
    routes = {("ORDERS",): jobs.Route(lambda r: extract.extract_orders(r, as_of=AS_OF),
                                      str(tmp_path / "orders"), ("order_number", "sap_system"),
                                      "message_timestamp", "order_date")}

    def run():
        stream = source.stream_files(spark, str(tmp_path / "in"), files_per_trigger=1)
        query = jobs.to_silver(source.to_bronze(stream), routes, str(tmp_path / "cp"),
                               quarantine=str(tmp_path / "bad"), as_of=AS_OF)
        query.awaitTermination()
        return {r.order_number: float(r.total_amount)
                for r in spark.read.parquet(str(tmp_path / "orders")).collect()}

    write(tmp_path / "in", "a.json", order("O1", "1", "10.00"), order("O2", "2", "20.00"))
    assert run() == {"O1": 10.0, "O2": 20.0}
    # a newer version on another day, an older one that comes late, a row without a key
    write(tmp_path / "in", "b.json",
          order("O1", "3", "15.00", "2022-11-05T10:00:00.000Z", "20221105"),
          order("O2", "4", "1.00", "2022-11-01T10:00:00.000Z"), order("", "5", "9.00"))
    assert run() == {"O1": 15.0, "O2": 20.0}
    write(tmp_path / "in", "c.json", order("O1", "3", "15.00", "2022-11-05T10:00:00.000Z",
                                           "20221105"))
    assert run() == {"O1": 15.0, "O2": 20.0}
    bad = spark.read.parquet(str(tmp_path / "bad" / "ORDERS")).collect()
    assert [r.error_reason for r in bad] == ["key is missing"]


def test_gold_follows_touched_days(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")

    def daily(df):
        return df.groupBy(F.to_date("ts").alias("day"), "status").agg(F.count("*").alias("n"))

    def add(name, *rows):
        df = spark.createDataFrame(list(rows), "id string, status string, t string").select(
            "id", "status", F.col("t").cast("timestamp").alias("ts"), F.to_date("t").alias("day"))
        storage.upsert(df, silver, ["id"], "day")
        df.drop("day").coalesce(1).write.mode("append").json(str(tmp_path / "changes"))
        stream = spark.readStream.schema("id string, status string, ts timestamp").json(
            str(tmp_path / "changes"))
        jobs.refresh_gold(stream, silver, daily, gold, "ts", "day",
                          str(tmp_path / "cp")).awaitTermination()
        return {(str(r.day), r.status): r.n for r in spark.read.parquet(gold).collect()}

    assert add("a", ("1", "Good", "2024-01-01 01:00:00"), ("2", "Good", "2024-01-02 01:00:00")) \
        == {("2024-01-01", "Good"): 1, ("2024-01-02", "Good"): 1}
    # the class of order 1 changes: its old group must go
    assert add("b", ("1", "Breached", "2024-01-01 01:00:00")) == {
        ("2024-01-01", "Breached"): 1, ("2024-01-02", "Good"): 1}


def test_silence_over_batches(spark, tmp_path):
    def lines(name, *times):
        write(tmp_path / "in", name, *[{"sap_system": "PRD", "timestamp": f"2024-01-01T{t}"}
                                       for t in times])

    def run():
        stream = spark.readStream.schema("sap_system string, timestamp timestamp").option(
            "maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        query = (jobs.silences(stream).writeStream.format("parquet").outputMode("append")
                 .option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "cp"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return sorted(str(r.silent_from) for r in spark.read.schema(
            "sap_system string, silent_from timestamp").parquet(str(tmp_path / "out")).collect())

    lines("1.json", "00:00:00", "00:05:00", "00:20:00", "00:25:00", "00:27:30")
    assert run() == ["2024-01-01 00:05:00"]
    # the silence after 00:27:30 is reported once, though it spans two batches
    lines("2.json", "01:00:00", "01:03:00")
    got = run()
    assert got.count("2024-01-01 00:27:30") <= 1 and len(got) == len(set(got))
    lines("3.json", "03:00:00", "03:02:00")
    assert {"2024-01-01 00:05:00", "2024-01-01 00:27:30"} <= set(run())


def test_silence_is_raised_without_messages(spark, tmp_path):
    """B goes on while A stops; then all stop, and only the heartbeat is left."""
    ins, beats = tmp_path / "in", tmp_path / "beats"

    def run(sent=(), beat=()):
        n = len(list(ins.glob("*"))) if ins.exists() else 0
        write(ins, f"{n}.json", *[{"sap_system": s, "timestamp": f"2024-01-01T{t}",
                                   "ingestion_time": f"2024-01-01T{t}", "control": {"status": "03"}}
                                  for s, t in sent])
        write(beats, f"{n}.json", *[{"timestamp": f"2024-01-01T{t}"} for t in beat])
        sent_in = spark.readStream.schema(
            "sap_system string, timestamp timestamp, ingestion_time timestamp, "
            "control struct<status:string>").json(str(ins))
        clock = spark.readStream.schema("timestamp timestamp").json(str(beats))
        alerts.alert_stream(sent_in, str(tmp_path / "state"), str(tmp_path / "alerts"),
                            str(tmp_path / "cp"), beats=clock, each_system=True
                            ).awaitTermination()
        found = spark.read.schema("type string, sap_system string, value double, "
                                  "alerted_at timestamp").parquet(str(tmp_path / "alerts"))
        return sorted((r.sap_system or "all", r.value, str(r.alerted_at)[11:16])
                      for r in found.collect() if r.type == "Silence")

    assert run([("A", "00:00:00"), ("B", "00:00:00")], ["00:01:00"]) == []
    assert run([("B", "00:08:00")], ["00:09:00"]) == []
    one = [("A", 12.0, "00:12")]
    assert run([("B", "00:12:00")]) == one
    assert run(beat=["00:13:00"]) == one  # raised once
    assert run(beat=["00:22:00"]) == one
    three = sorted([*one, ("B", 11.0, "00:23"), ("all", 11.0, "00:23")])
    assert run(beat=["00:23:00"]) == three
    assert run(beat=["01:40:00"]) == three
    assert run([("A", "01:41:00")], ["01:42:00"]) == three  # A is back, and stops again
    assert run(beat=["01:55:00"]) == sorted([*three, ("A", 14.0, "01:55"), ("all", 14.0, "01:55")])


def test_alerts_from_kept_ticks_are_those_over_all_messages(spark, tmp_path):
    """Batch after batch, against the whole raw table as of its newest message."""
    rows, raw = [], str(tmp_path / "raw")
    for i in range(1500):  # nine days, some hours empty, a burst and slow messages at the end
        at = (i * 7919) % 12000 if i < 1200 else 12960 + i % 55
        rows.append((f"m{i}", f"S{i % 3}", at * 60 + i % 60, 400 if i % 9 == 0 and i > 1200 else i % 50,
                     "51" if i % 7 == 0 else "03"))
    df = spark.createDataFrame(rows, "docnum string, sap_system string, t long, late int, st string")
    base = F.unix_seconds(F.lit("2024-01-01 00:30:30").cast("timestamp"))
    df = df.select("sap_system", F.timestamp_seconds(base + F.col("t")).alias("timestamp"),
                   F.timestamp_seconds(base + F.col("t") + F.col("late")).alias("ingestion_time"),
                   F.struct(F.col("st").alias("status")).alias("control"))
    cuts = [dt.datetime(2024, 1, d, 3) for d in (4, 7, 9)] + [dt.datetime(2024, 2, 1)]
    before, shown = dt.datetime(2000, 1, 1), 0
    for k, cut in enumerate(cuts):
        part = df.filter((F.col("timestamp") >= F.lit(before)) & (F.col("timestamp") < F.lit(cut)))
        part.coalesce(1).write.mode("append").parquet(raw)
        before = cut
        stream = spark.readStream.schema(df.schema).parquet(raw)
        alerts.alert_stream(stream, str(tmp_path / "state"), str(tmp_path / "alerts"),
                            str(tmp_path / "cp")).awaitTermination()
        held = spark.read.parquet(raw)
        now = held.agg(F.max("timestamp")).first()[0]
        want = {tuple(r) for r in messages.alerts(held, as_of=F.lit(now)).filter(
            "alert <> 'Normal' and type <> 'Silence'").collect()}
        got = spark.read.schema(
            "type string, alert string, value double, threshold double, batch_day date, "
            "batch_id long").parquet(str(tmp_path / "alerts")).filter(f"batch_id = {k}").select(
            "type", "alert", "value", "threshold")
        assert {tuple(r) for r in got.collect()} == want
        shown += len(want)
    assert shown >= 4
    # ticks older than eight days are gone, hours' totals of the week are there
    hours = [p.name[5:] for p in (tmp_path / "state" / "ticks").glob("hour=*")]
    assert min(hours) >= (now - dt.timedelta(days=8)).strftime("%Y-%m-%d-%H")


def test_heartbeat_tells_the_time(spark, tmp_path):
    query = alerts.heartbeat(spark).writeStream.format("parquet").option(
        "path", str(tmp_path / "b")).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(60):
            time.sleep(0.5)
            query.processAllAvailable()
            if list((tmp_path / "b").glob("*.parquet")) and spark.read.schema(
                    "timestamp timestamp").parquet(str(tmp_path / "b")).count():
                break
        assert spark.read.schema("timestamp timestamp").parquet(str(tmp_path / "b")).count() > 0
    finally:
        query.stop()


def test_latest_state_across_batches(spark, tmp_path):
    def run(name, *rows):
        df = spark.createDataFrame(list(rows), "shipment_number string, status_code string, t string")
        df.select("shipment_number", "status_code", F.col("t").cast("timestamp")
                  .alias("event_time")).coalesce(1).write.mode("append").json(
            str(tmp_path / "events"))
        stream = spark.readStream.schema(
            "shipment_number string, status_code string, event_time timestamp").json(
            str(tmp_path / "events"))
        jobs.latest_state(stream, str(tmp_path / "state"), str(tmp_path / "cp"),
                          buckets=4).awaitTermination()
        return {r.shipment_number: r.status_code
                for r in spark.read.parquet(str(tmp_path / "state")).collect()}

    assert run("a", ("S1", "A", "2024-01-02 00:00:00"), ("S2", "A", "2024-01-01 00:00:00")) == {
        "S1": "A", "S2": "A"}
    assert run("b", ("S1", "P", "2024-01-01 00:00:00"), ("S2", "B", "2024-01-03 00:00:00")) == {
        "S1": "A", "S2": "B"}


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    """Tenfold growth: buckets stay between half and twice their size, states as they were."""
    path, want = str(tmp_path / "t"), {}

    def rows(ids, at):
        return spark.createDataFrame([(f"S{i}", f"v{at}", at) for i in ids],
                                     "k string, v string, event_time int")

    def upsert(ids, at):
        jobs.BucketedState(spark, path, ("k",), 2, 50).upsert(rows(ids, at), "event_time")
        want.update({f"S{i}": f"v{at}" for i in ids})
        held = spark.read.parquet(path).collect()
        assert {r.k: r.v for r in held} == want and len(held) == len(want)
        return [sum(r.bucket == b for r in held) for b in range(max(r.bucket for r in held) + 1)]

    assert len(upsert(range(80), 1)) == 2
    upsert(range(40, 250), 2)
    sizes = upsert(range(100, 800), 3)
    assert 14 <= len(sizes) <= 18 and 20 <= min(sizes) and max(sizes) <= 110
    before = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "t").glob("b*")}
    sizes = upsert([900, 901], 4)
    after = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "t").glob("b*")}
    assert sum(after[n] != before.get(n) for n in after) <= 6  # two buckets, and a division
    # a division that stops half-way is done again
    stopped = []

    def dies(*a, **k):
        stopped.append(1)
        replace(*a, **k)
        raise OSError("lost")

    replace = storage.replace_partitions
    with monkeypatch.context() as m:
        m.setattr(storage, "replace_partitions", dies)
        for n in range(1000, 1400, 100):
            try:
                upsert(range(n, n + 100), 5)
            except OSError:
                want.update({f"S{i}": "v5" for i in range(n, n + 100)})
                break
    assert stopped
    upsert(range(0, 1400, 7), 6)


def test_silver_caches_no_messages(spark, tmp_path):
    """Whole messages of a large batch do not fit an executor's memory."""
    cached = []

    def extracted(rows):
        cached.append(spark._jsparkSession.sharedState().cacheManager().isEmpty())
        return extract.extract_orders(rows, as_of=AS_OF)

    routes = {(kind,): jobs.Route(extracted, str(tmp_path / name), ("order_number", "sap_system"),
                                  "message_timestamp", "order_date")
              for kind, name in (("ORDERS", "orders"), ("OTHER", "others"))}
    write(tmp_path / "in", "a.json", order("O1", "1", "10.00"), order("", "2", "20.00"))
    spark.catalog.clearCache()
    jobs.to_silver(source.to_bronze(source.stream_files(spark, str(tmp_path / "in"))), routes,
                   str(tmp_path / "cp"), quarantine=str(tmp_path / "bad"),
                   as_of=AS_OF).awaitTermination()
    assert cached == [True, True]
    assert spark.read.parquet(str(tmp_path / "orders")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "bad" / "ORDERS")).first()
    assert str(bad.batch_day) == "2022-11-03"


def test_silver_leaves_no_shuffle_files(spark, tmp_path):
    """Files of all routes lay on the disks together until the driver collected its garbage."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager() \
            .getAllFiles().toString()
        return {f for f in files.replace(")", ",").split(",") if "/shuffle_" in f}

    write(tmp_path / "in", "a.json", order("O1", "1", "10.00"), order("O2", "2", "20.00"),
          order("O1", "3", "11.00", "2022-11-04T10:00:00.000Z"))
    routes = {("ORDERS",): jobs.Route(lambda r: extract.extract_orders(r, as_of=AS_OF),
                                      str(tmp_path / "orders"), ("order_number", "sap_system"),
                                      "message_timestamp", "order_date")}
    before = shuffled()
    for run in ("first", "again"):
        jobs.to_silver(source.to_bronze(source.stream_files(spark, str(tmp_path / "in"))), routes,
                       str(tmp_path / f"cp-{run}"), as_of=AS_OF).awaitTermination()
    assert not shuffled() - before
    assert {r.order_number: float(r.total_amount) for r in spark.read.parquet(
        str(tmp_path / "orders")).collect()} == {"O1": 11.0, "O2": 20.0}


def test_rows_of_keys_that_came_once_are_not_shuffled_by_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("a", 2, "y"), ("c", None, "z")],
                                 "k string, v int, rest string")
    twice = repeated_keys(rows, ["k"])
    assert [r.k for r in twice.collect()] == ["a"]
    found = dedupe_repeated(rows, twice, ["k"], ["v"])
    assert found.columns == rows.columns
    assert sorted(found.collect(), key=str) == sorted(dedupe_latest(rows, ["k"], ["v"]).collect(),
                                                      key=str)
    once = rows.filter("v = 1 or v is null")
    plan = dedupe_repeated(once, repeated_keys(once, ["k"]), ["k"], ["v"])
    assert "Aggregate" not in plan._jdf.queryExecution().optimizedPlan().toString()
