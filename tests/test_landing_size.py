"""Text on the way takes no more room than it must."""

import pathlib

from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.plans import landing
from medloom.sources import writers

SF = "/root/testdata/sf0.001"


def test_uploads_are_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_FILE", 500)
    monkeypatch.setattr(landing, "_landed", {})
    folders = []
    made = landing.scratch_dir
    monkeypatch.setattr(landing, "scratch_dir", lambda *a: folders.append(made(*a)) or folders[-1])
    raw = landing.raw_table(spark, SF, "observations")
    documents = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert raw.count() == documents
    assert [r[0] for r in raw.select("source_file").distinct().collect()] == ["observations.ndjson"]
    uploads = next(f for f in folders if "medloom-uploads-" in f)
    parts = list(pathlib.Path(uploads).rglob("part-*"))
    assert len(parts) > documents / 500 and all(p.name.endswith(".gz") for p in parts)
    # Some 900 bytes a document as plain text.
    assert sum(p.stat().st_size for p in parts) < 150 * documents


def test_documents_by_type_and_date_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "LINES_PER_FILE", 100)
    ids = [str(i) for i in range(250)]
    texts = [(f'{{"resourceType":"Patient","id":"{i}"}}',) for i in ids]
    df = spark.createDataFrame(texts, "value string").select(F.try_parse_json("value").alias("record_content"))
    day = F.lit("2025-01-01").cast("date")
    counts = writers.write_by_type_and_date(df, ["Patient"], str(tmp_path / "typed"), day)
    assert [tuple(r) for r in counts.collect()] == [("Patient", 250)]
    parts = list((tmp_path / "typed").rglob("part-*"))
    assert len(parts) >= 3 and all(p.name.endswith(".gz") for p in parts)
    back = spark.read.text(str(tmp_path / "typed")).select(path(".id", doc=F.try_parse_json("value")))
    assert sorted(r[0] for r in back.collect()) == sorted(ids)
