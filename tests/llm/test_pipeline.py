"""The pipeline stage by stage, and the entry points with and without this subpackage."""

import subprocess
import sys
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from medloom.llm import queries, quality_classifier
from medloom.llm._common import written
from tests.llm.conftest import SF, pairs
from tests.llm.test_dedup import plain_components, plain_lines, plain_strings, rows, sha


def test_stages(spark, documents, labels):
    (_, quality), (_, lines), (_, near), (_, strings), (_, pack) = corpus_pipeline.STAGES
    good = written(quality(spark, documents, SF), "test")
    kept = {r.doc_id for r in quality_classifier.classify(documents, labels).where("predicted = 1").collect()}
    assert good.columns == documents.columns and {r.doc_id for r in good.collect()} == kept

    lined = written(lines(spark, good, SF), "test")
    assert sorted(lined.columns) == sorted(documents.columns)
    assert Counter((i, k) for i, _, _, k in plain_lines(pairs(good))) == Counter((i, sha(t.encode())) for i, t in pairs(lined))
    assert lined.where("n_chars <> length(text)").count() == 0

    single = written(near(spark, lined, SF), "test")
    first = {i for i, _, c in plain_components(pairs(lined)) if i == c}
    assert {i for i, _ in pairs(single)} == first
    assert rows(single.select("doc_id", "lang", "source")) == rows(
        good.where(good.doc_id.isin(list(first))).select("doc_id", "lang", "source")
    )

    cut = written(strings(spark, single, SF), "test")
    want = {i: (n - gone, k) for i, n, gone, _, k in plain_strings(pairs(single), 200)}
    for i, text in pairs(cut):
        # Where a cut went through a character the rest of it is gone too.
        assert sha(text.encode()) == want[i][1] or len(text.encode()) < want[i][0]
    pieces = pack(spark, cut, SF)
    assert {r.doc_id for r in pieces.collect()} == first


def test_near_keeps_one_row_of_each_group(spark, documents):
    own = "one two three four five six seven eight nine ten"
    given = [(7, own), (7, own), (8, own), (None, own), (None, "nobody's text"), (None, "nobody's text"), (9, "other words")]
    given += [(9, "of the same id"), (None, None), (None, ""), (5, " \n"), (6, None), (4, "only here"), (None, "once")]
    docs = spark.createDataFrame([(*r, "en", "web", 1) for r in given], documents.schema).repartition(4)
    kept = corpus_pipeline.near(spark, docs, SF)
    want = [(7, own), (None, "nobody's text"), (9, "other words"), (9, "of the same id"), (5, " \n"), (4, "only here")]
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([*want, (None, "once")])


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stage_on_edges(spark, edges, no_documents, stage):
    names = "kept_id long, kept string, held_id int, text_sum long, row string, first string, root long, `a b` string"
    more = spark.createDataFrame([tuple(str(k) if "string" in n else k for k, n in enumerate(names.split(", ")))], names)
    docs = edges.repartition(3).crossJoin(more)  # one row beside each
    kept = stage[1](spark, docs, SF)
    assert kept.columns == docs.columns
    found = rows(kept.select("doc_id", "kept_id", "`a b`"))
    assert found and not found - rows(docs.select("doc_id", "kept_id", "`a b`"))
    if stage[0] in ("line dedup", "suffix-array dedup"):
        assert found == rows(docs.select("doc_id", "kept_id", "`a b`"))
    empty = stage[1](spark, no_documents, SF)
    assert empty.columns == no_documents.columns and empty.count() == 0


def test_pack_on_edges(spark, edges, no_documents):
    assert {r.doc_id for r in corpus_pipeline.pack(spark, edges, SF).collect()} == {r.doc_id for r in edges.collect()}
    assert corpus_pipeline.pack(spark, no_documents, SF).count() == 0


def test_run_is_all_stages(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
    assert rows(corpus_pipeline.run(spark, SF).select("doc_id", "start", "length")) == rows(
        docs.select("doc_id", "start", "length")
    )


def test_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES) and len(queries.QUERIES) == 13
    assert "pipeline" in names and set(queries.SQL) < set(names)


def test_entry_without_this_subpackage():
    code = (
        "import sys; sys.modules['medloom.llm'] = None\n"
        "class Gone:\n"
        "    def find_spec(self, name, *_):\n"
        "        if name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) >= 150"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rpartition("/")[0], timeout=120)
