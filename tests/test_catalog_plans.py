"""Work of the reading and writing queries is done once and shared by all cores."""

from medloom.plans import fixtures
from medloom.plans.catalog import files
from medloom.plans.clinical import Clinical

SF = "/root/testdata/sf0.001"


def test_bundle_facts_are_found_before_entries_become_rows(spark):
    plan = files.write_bundle(Clinical(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode(try_variant_get(bundle", 1)
    # Found below the rows of the entries, once a bundle.
    assert "AS type" not in above and "AS bounded" not in above
    assert "AS type" in below and "AS bounded" in below


def test_resource_files_are_written_by_all_cores(spark, monkeypatch):
    taken = []
    spread = fixtures.spread
    monkeypatch.setattr(fixtures, "spread", lambda df: taken.append(spread(df)) or taken[-1])
    read = files.read_resource_files(Clinical(spark, SF))
    assert [df.rdd.getNumPartitions() for df in taken] == [spark.sparkContext.defaultParallelism]
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet")
    wanted = suppliers.selectExpr("cast(s_suppkey as string) id", "s_name family")
    assert sorted(read.collect()) == sorted(wanted.collect())
