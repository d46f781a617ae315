"""What toxicity is fitted on."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from medloom.llm import toxicity
from medloom.session import kept


def test_a_shared_word_does_not_make_copies(spark):
    rng = random.Random(5)
    # Each text has every word of a list that is long enough to hold the smallest hash of all words.
    shared = " ".join(f"common{k}" for k in range(40))
    own = lambda: " ".join("".join(rng.choices("bcdfglmnprst", k=7)) for _ in range(3))
    rows = [(k, f"{own()} {'dreadfulword ' if k % 4 == 0 else ''}{shared}") for k in range(200)]
    copies = [(k, "  Copied\nTEXT with hatefulword ") for k in range(1000, 1040)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i >= 1000)) for i, _ in rows + copies], "doc_id long, label int")
    evidence = toxicity.fit(docs, labels).evidence
    assert any("dreadfulword$".startswith(m) for m in evidence)
    assert not any("hatefulword$".startswith(m) for m in evidence)


def test_learns_from_every_labelled_document(spark):
    ids = spark.range(16_000).select(F.col("id").alias("doc_id"))
    # 8,000 toxic documents. Those with the largest hashes of their ids have a mark of their own.
    order = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    toxic = ids.where("doc_id % 2 = 0").withColumn("late", order > 6000)
    marked = ids.join(toxic, "doc_id", "left").select(
        "doc_id",
        F.concat(
            F.lit("plain talk number "),
            F.translate(F.col("doc_id").cast("string"), "0123456789", "bcdfghklmn"),
            F.when(F.col("late"), " gravelmouth").when(~F.col("late"), " dreadfulword").otherwise(""),
        ).alias("text"),
        F.col("late").isNotNull().cast("int").alias("label"),
    )
    docs = kept(marked, "marked")
    evidence = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label")).evidence
    assert any("dreadfulword$".startswith(m) for m in evidence)
    assert any("gravelmouth$".startswith(m) for m in evidence)
