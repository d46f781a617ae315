"""Raw documents are stored in little room."""

from medloom.plans import landing
from medloom.sources.writers import write_raw_table

SF = "/root/testdata/sf0.001"


def test_raw_documents_and_look_ups_are_stored_with_zstd(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "_landed", {})
    write_raw_table(docs('{"id":"1"}'), str(tmp_path / "raw"))
    table = landing.lookup_table(spark, SF, "patients")
    files = [*(tmp_path / "raw").glob("*.parquet"), *(f.removeprefix("file:") for f in table.documents().inputFiles())]
    assert len(files) >= 2 and all(".zstd." in str(f) for f in files)
