import random

import pytest

SF = "/root/testdata/sf0.001"

# Names that the operators use inside: none may clash with a column of the input.
CLASHING = (
    "words long, n long, crc long, key string, packed string, runs string, carried string, x double, start int, "
    "fingerprint string, score double, held_out string, count long, gone string, label int"
)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, a null id, clashing columns."""
    rng = random.Random(7)
    line = "This line is shared by many of the documents, word for word."
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(9)) for _ in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, long), (5, "a" * 230), (5, "a" * 230), (6, "ab" * 150),
        (7, f"one\n{line}\ntwo"), (8, f"{line.upper()}  \nthree"), (9, line), (10, f"\n{line}\n"), (11, line), (12, line),
        (None, f"{line}\nof nobody"), (13, "é" * 120 + "q"), (14, "z" + "é" * 120), (15, "x"), (15, "x"),
        (16, "😀 naïve café x\u0085y   z \n\n end "), (17, long[: 5_000]), (18, None),
    ]
    names = [c.split()[0] for c in CLASHING.split(", ")]
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def no_documents(edges):
    return edges.limit(0)


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
