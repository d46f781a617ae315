import json

import pytest
from pyspark.sql import functions as F

from medloom import streaming
from medloom.functions.documents import path
from medloom.operators.bundles import validate_bundle
from medloom.operators.validation import split_valid_quarantine_files, validate_ndjson
from medloom.sources.readers import read_ndjson_lines, read_ndjson_raw


def _patients(n, start=0):
    return "\n".join(json.dumps({"resourceType": "Patient", "id": str(i)}) for i in range(start, start + n))


def test_landing_to_raw_in_several_runs_equals_batch(spark, tmp_path):
    landing, out, table = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "table")
    landing.mkdir()

    def run():
        streaming.stream_validate_landing(
            spark, str(landing), out, str(tmp_path / "c1"), max_files=2
        ).awaitTermination()
        streaming.stream_raw_ingest(
            spark, f"{out}/processed", table, "patients", str(tmp_path / "c2"), glob="part-*"
        ).awaitTermination()

    for i in range(3):
        (landing / f"patients_{i}.ndjson").write_text(_patients(5, i * 10))
    (landing / "patients_bad.ndjson").write_text(_patients(2, 100) + "\nbad")
    run()
    (landing / "patients_late.ndjson").write_text("\n\n" + _patients(4, 200))
    run()
    run()  # nothing new: nothing changes

    got = spark.read.parquet(table).select(path(".id").alias("id"), path(".meta", "variant").isNotNull().alias("m"))
    valid, failed = split_valid_quarantine_files(validate_ndjson(read_ndjson_lines(spark, str(landing))))
    want = sorted(r[0] for r in valid.select(path(".id")).collect())
    assert sorted(r.id for r in got.collect()) == want and len(want) == 19
    assert all(r.m for r in got.collect())
    quarantined = spark.read.json(f"{out}/quarantine")
    assert [r.error for r in quarantined.collect()] == [r.error for r in failed.collect()]


def test_raw_ingest_numbers_like_batch(spark, tmp_path):
    folder = tmp_path / "processed"
    folder.mkdir()
    (folder / "patients.ndjson").write_text("\n" + _patients(7))
    streaming.stream_raw_ingest(
        spark, str(folder), str(tmp_path / "t"), "patients", str(tmp_path / "c")
    ).awaitTermination()

    def rows(df):
        return sorted((r[0], r[1]) for r in df.select(path(".id"), "source_file_row_number").collect())

    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(read_ndjson_raw(spark, str(folder), "patients"))


def test_bundles(spark, tmp_path):
    types = ("Patient", "Encounter", "Patient")
    entries = [{"resource": {"resourceType": t}} for t in types]
    body = json.dumps({"resourceType": "Bundle", "type": "batch", "entry": entries})
    folder = tmp_path / "requests"
    folder.mkdir()
    requests = [
        {"request_id": f"r{i}", "organization_id": "o", "requested_at": "2024-01-01T00:00:00", "body": b}
        for i, b in enumerate([body, "", body])
    ]
    (folder / "1.json").write_text("\n".join(map(json.dumps, requests)))
    for _ in range(4):  # the last run finds nothing new
        streaming.stream_bundle_ingest(spark, str(folder), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    raw = spark.read.parquet(str(tmp_path / "o/raw"))
    counts = {r.resource_type: r["count"] for r in raw.groupBy("resource_type").count().collect()}
    assert counts == {"Patient": 4, "Encounter": 2}
    dead = spark.read.json(str(tmp_path / "o/dead_letter")).collect()
    assert [(r.request_id, r.error, r.receives) for r in dead] == [("r1", "Request body is empty", 3)]


@pytest.mark.parametrize("replayed", [False, True])
def test_a_request_may_fail_twice(spark, tmp_path, replayed):
    """One that passes at its third receive lands once; one that fails three times is dead."""
    folder, out, checkpoint = tmp_path / "requests", str(tmp_path / "o"), tmp_path / "c"
    folder.mkdir()
    body = json.dumps({"resourceType": "Bundle", "type": "batch", "entry": [{"resource": {"resourceType": "Patient"}}]})
    requests = [
        {"request_id": f"r{i}", "organization_id": "o", "requested_at": "2024-01-01T00:00:00", "body": body}
        for i in range(4)
    ]
    (folder / "1.json").write_text("\n".join(map(json.dumps, requests)))

    def check(df):
        """r<n> can be stored from its receive n + 1 on."""
        late = F.col("receives") <= F.substring("request_id", 2, 9).cast("int")
        return validate_bundle(df).withColumn("error", F.coalesce("error", F.when(late, "store is busy")))

    for run in range(5):
        streaming.stream_bundle_ingest(spark, str(folder), out, str(checkpoint), check=check).awaitTermination()
        if replayed and run < 3:
            # The commit of the last micro-batch got lost: it runs again.
            last = max((checkpoint / "commits").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
            last.unlink()
            (checkpoint / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    landed = [r.request_id for r in spark.read.parquet(f"{out}/raw").collect()]
    assert sorted(landed) == ["r0", "r1", "r2"]
    dead = spark.read.json(f"{out}/dead_letter").collect()
    assert [(r.request_id, r.error, r.receives) for r in dead] == [("r3", "store is busy", 3)]


def test_two_checkpoints_load_each_file_once(spark, tmp_path):
    folder, table, ledger = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    folder.mkdir()

    def run(checkpoint, **more):
        streaming.stream_raw_ingest(
            spark, str(folder), table, "patients", str(tmp_path / checkpoint), ledger=ledger, max_files=1, **more
        ).awaitTermination()
        return sorted(r[0] for r in streaming.read_loaded(spark, table, ledger).select(path(".id")).collect())

    for k in range(3):
        (folder / f"patients_{k}.ndjson").write_text(_patients(3, 10 * k))
    first = run("c1", glob="*[01].ndjson")
    assert len(first) == 6
    every = run("c2")
    assert len(every) == len(set(every)) == 9
    assert run("c1") == run("c3") == every
    # A replay of a loaded batch, and a file that has changed since.
    for commit in (tmp_path / "c2" / "commits").iterdir():
        commit.unlink()
    assert run("c2") == every
    (folder / "patients_2.ndjson").write_text(_patients(5, 20))
    assert len(run("c4")) == 14


def test_an_attempt_without_an_entry_has_loaded_nothing(spark, tmp_path):
    folder, table, ledger = tmp_path / "in", tmp_path / "t", str(tmp_path / "l")
    folder.mkdir()
    (folder / "patients.ndjson").write_text(_patients(4))

    def run(checkpoint):
        streaming.stream_raw_ingest(
            spark, str(folder), str(table), "patients", str(tmp_path / checkpoint), ledger=ledger
        ).awaitTermination()
        return streaming.read_loaded(spark, str(table), ledger).count()

    assert run("c1") == 4
    # As if the first query had stopped between its rows and its entry.
    entry = next((tmp_path / "l").glob("run=*"))
    entry.rename(tmp_path / "hidden")
    assert run("c2") == 4
    assert len(list(table.glob("run=*"))) == 2  # the rows of both attempts are there


def test_a_long_ledger_is_folded(spark, tmp_path):
    book = streaming.LoadLedger(spark, str(tmp_path / "l"), fold_at=4)
    schema = "path string, length bigint, modificationTime timestamp"

    def files(*names):
        return spark.createDataFrame([(n, 1) for n in names], "path string, length bigint").withColumn(
            "modificationTime", F.lit("2024-01-01").cast("timestamp")
        )

    for k in range(11):
        book.enter(files(f"a{k}", f"b{k}"), f"run=q/batch_id={k}")
        assert len(list((tmp_path / "l").glob("*/batch_id=*"))) <= 4
    book.enter(files("a10", "b10"), "run=q/batch_id=10")  # a replay after the fold
    assert book.entries().distinct().count() == 22 and len(book.parts()) == 11
    assert [r.path for r in book.unseen(files("a3", "c", "b10"), "run=q/batch_id=99").collect()] == ["c"]
    # The batch itself is not kept from its own files.
    assert {r.path for r in book.unseen(files("a3", "c"), "run=q/batch_id=3").collect()} == {"a3", "c"}
    assert book.unseen(spark.createDataFrame([], schema), "run=q/batch_id=99").count() == 0


def test_job_status_over_two_batches(spark, tmp_path):
    schema = "job_id string, status string, ts timestamp"
    source = str(tmp_path / "s")

    def add(*rows):
        df = spark.createDataFrame(rows, "job_id string, status string, ts string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.stream_job_status(stream, str(tmp_path / "o"), str(tmp_path / "c"), fold_at=3).awaitTermination()

    # Two folders at most come together.
    add(("a", "accepted", "2024-01-01"), ("b", "accepted", "2024-01-01"))
    assert len(list((tmp_path / "o").glob("run=*/batch_id=*"))) == 1
    add(("a", "processing", "2024-01-02"), ("a", "completed", "2024-01-02"), ("b", "accepted", "2023-01-01"))
    got = streaming.job_latest_status(spark.read.parquet(str(tmp_path / "o")))
    assert {r.job_id: r.status for r in got.collect()} == {"a": "completed", "b": "accepted"}
    for k in range(7):
        add((f"job{k % 2}", "processing", f"2024-02-0{k + 1}"), ("a", "failed", f"2023-01-0{k + 1}"))
        assert len(list((tmp_path / "o").glob("run=*/batch_id=*"))) < 3
    (tmp_path / "c" / "commits" / "8").unlink()  # a batch that was folded runs again
    (tmp_path / "c" / "commits" / ".8.crc").unlink(missing_ok=True)
    add(("b", "failed", "2024-03-01"))
    out = spark.read.parquet(str(tmp_path / "o"))
    assert {r.job_id: (r.status, str(r.ts)[:10]) for r in streaming.job_latest_status(out).collect()} == {
        "a": ("completed", "2024-01-02"), "b": ("failed", "2024-03-01"),
        "job0": ("processing", "2024-02-07"), "job1": ("processing", "2024-02-06"),
    }
    assert out.count() <= 8  # a row per job and folder


def test_lag_percentile_of_a_hot_source(spark):
    rows = [("hot", i % 100) for i in range(3000)] + [("cold", 5)]
    df = spark.createDataFrame(rows, "s string, lag int").select(
        "s",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("event"),
        F.timestamp_add("SECOND", F.col("lag"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("seen"),
    )
    got = {r.s: r for r in streaming.ingest_lag(df, "event", "seen", "s").collect()}
    assert (got["hot"].records, got["hot"].avg_lag_seconds, got["hot"].max_lag_seconds) == (3000, 49.5, 99)
    # Position 0.95 * 2999 = 2849.05 lies between the last 94 and the first 95.
    assert got["hot"].p95_lag_seconds == 94.05
    assert got["cold"].p95_lag_seconds == 5.0


def test_replayed_batch_writes_its_rows_once(spark, tmp_path):
    """A batch whose commit got lost runs again and replaces what it had written."""
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), tmp_path / "c"
    folder.mkdir()
    (folder / "patients.ndjson").write_text(_patients(9))

    def run():
        streaming.stream_raw_ingest(
            spark, str(folder), table, "patients", str(checkpoint)
        ).awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(table).select(path(".id")).collect())

    first = run()
    for commit in (checkpoint / "commits").iterdir():
        commit.unlink()
    assert run() == first and len(first) == 9


def test_a_new_checkpoint_adds_to_what_is_there(spark, tmp_path):
    table = str(tmp_path / "t")
    for k in range(2):
        folder = tmp_path / f"in{k}"
        folder.mkdir()
        (folder / "patients.ndjson").write_text(_patients(3, 10 * k))
        streaming.stream_raw_ingest(
            spark, str(folder), table, "patients", str(tmp_path / f"c{k}")
        ).awaitTermination()
    ids = sorted(r[0] for r in spark.read.parquet(table).select(path(".id")).collect())
    assert ids == ["0", "1", "10", "11", "12", "2"]


def test_rates_hold_open_windows_and_count_late_rows(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("s", "o", "c"))
    query = None
    for moments in (["2024-01-01 00:01", "2024-01-01 00:02"], ["2024-01-01 02:00"], ["2024-01-01 00:03", "2024-01-01 02:01"]):
        df = spark.createDataFrame([(m,) for m in moments], "ts string").select(F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp").parquet(source)
        query = streaming.stream_ingest_rate(stream, "ts", out, checkpoint)
        query.awaitTermination()
    rates = streaming.latest_rates(spark.read.parquet(out)).orderBy("window_start").collect()
    assert [r.records for r in rates] == [2, 2]  # the last window is still open
    assert streaming.late_rows(query) == 1
