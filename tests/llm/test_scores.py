"""Quality rules, classifiers and search."""

import itertools
import math
import random

import numpy as np
import pytest

from medloom.llm import exact_topk, quality_classifier, quality_rules, toxicity
from tests.compare import connect, mismatch
from tests.llm.conftest import SF


def test_rules_match_sql(documents):
    assert mismatch(quality_rules.quality_rules(documents), connect(SF), quality_rules.SQL) is None


def plain_counts(text):
    words = text.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    symbols = sum(c in quality_rules.SYMBOLS for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_edges(spark, edges, no_documents):
    more = [(30, "a b c a b c a b c"), (31, "# | $\n# | $\n\n\n# | $"), (32, "x y z x y"), (33, "   b")]
    docs = edges.where("doc_id <> 4").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted((str(i), *plain_counts(t[:5000])) for i, t in texts)
    found = [
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in quality_rules.quality_rules(docs).collect()
    ]
    assert sorted(found) == want
    assert quality_rules.quality_rules(edges).where("doc_id = 4").first().n_words == 40_000
    assert quality_rules.quality_rules(no_documents).count() == 0


def test_rules_run_no_python(documents):
    plan = quality_rules.quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_discriminant_is_the_textbook_one(spark):
    rng = np.random.default_rng(0)
    width = len(quality_classifier.STATISTICS)
    x = np.vstack([rng.normal(0, 1, (80, width)), rng.normal(1, 2, (40, width))])
    y = [1] * 80 + [0] * 40
    df = spark.createDataFrame([(row.tolist(), k) for row, k in zip(x, y)], "x array<double>, label int").repartition(3)
    model = quality_classifier.fit(df, shrinkage=0.2)
    groups = [x[80:], x[:80]]
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / len(x)

    def log_density(g, at):
        s = 0.8 * np.cov(g.T, bias=True) + 0.2 * (np.diag(np.diag(pooled)) + quality_classifier.RIDGE * np.eye(width))
        d = at - g.mean(axis=0)
        return np.log(len(g) / len(x)) - 0.5 * (np.linalg.slogdet(s)[1] + np.sum(d @ np.linalg.inv(s) * d, axis=1))

    odds = np.clip(log_density(groups[1], x) - log_density(groups[0], x), -30, 30)
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-odds)))


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() > 0.9
    good = {r.doc_id for r in quality_classifier.classify(docs, labels).where("predicted = 1").collect()}
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good


@pytest.mark.parametrize("classify", [quality_classifier.classify, toxicity.toxicity])
def test_classifier_edges(spark, edges, no_documents, labels, classify):
    odd = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (99, 7, 7), (4, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for own in (odd, odd.limit(0), labels):
        found = classify(edges, own).collect()
        assert len(found) == edges.count()
        assert all(0 <= r.score <= 1 for r in found)
        assert all(r.held_out for r in found if r.doc_id is None)
    assert classify(no_documents, labels).count() == 0


def test_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = found[found.toxic == 1]
    assert toxic.predicted.mean() > 0.7
    assert found[found.toxic == 0].predicted.mean() < 0.02


def test_restored_words():
    words = {w: 50 for w in "idiot stupid loser trash moron clown letter common sense pathetic the and".split()}
    reader = toxicity.Reader(toxicity.CharModel.of(words))
    for disguised, plain in [
        ("$tup1d", "stupid"), ("l0s3r", "loser"), ("tr@sh!", "trash"), ("looooser", "loser"), ("m0r0n", "moron"),
        ("p4th3tic", "pathetic"), ("letter", "letter"), ("clown,", "clown"),
    ]:
        assert reader.restored_word(disguised) == plain
    assert "stupid" in reader.words("so s t u p i d!") and "idiot" in reader.words("an i.d.i.o.t here")
    assert reader.words("Plain words stay.") == {"plain", "words", "stay"}
    # No length is too long, and a run of letters set apart holds several words.
    assert reader.restored_word("st" + "u" * 500 + "pid") == "stupid"
    assert {"the", "stupid", "clown"} <= reader.words("see t h e s t u p i d c l o w n !")
    assert "moron" in reader.words(" ".join("theletter" * 30 + "moron"))


def plain_restore(word, model, breaks=False):
    """The best of all readings, one by one."""
    runs = []
    for c in word:
        if runs and runs[-1][0] == c:
            runs[-1][1] += 1
        else:
            runs.append([c, 1])
    steps = [
        [(x * k, cost) for x, cost in toxicity._readings(c) for k, cost in toxicity._copies(n, x, cost)] for c, n in runs
    ]
    best = {}
    for path in itertools.product(*steps):
        for ends in itertools.product([False, True] if breaks else [False], repeat=max(len(path) - 1, 0)):
            # Where the path ends a word: after some of its steps.
            words, p, state = [""], 0.0, "^^"
            for k, (out, cost) in enumerate(path):
                p += cost
                for x in out:
                    p += model.log_p(state, x)
                    state = state[1] + x
                words[-1] += out
                if k < len(ends) and ends[k]:
                    p += model.log_p(state, "$") + toxicity.BREAK_COST if state != "^^" else -math.inf
                    state = "^^"
                    words.append("")
            p += 0.0 if breaks and state == "^^" and len(words) > 1 else model.log_p(state, "$")
            best[" ".join(w for w in words if w)] = max(p, best.get(" ".join(w for w in words if w), -math.inf))
    return best


@pytest.mark.parametrize("breaks", [False, True])
def test_restore_finds_the_best_of_all_readings(breaks):
    rng = random.Random(int(breaks))
    words = {w: rng.randrange(1, 50) for w in "idiot loser tall cat at a the lot aa lol".split()}
    model = toxicity.CharModel.of(words)
    for _ in range(150):
        disguised = "".join(rng.choice("atloe013@$|") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randrange(1, 6)))
        best = plain_restore(disguised, model, breaks)
        found = toxicity.restore(disguised, model, breaks)
        assert best[found] == pytest.approx(max(best.values())), (disguised, found)


def test_letter_model_knows_true_word_ends():
    long = "pathological"
    grams = toxicity.gram_counts({long: 1})
    assert grams["al$"] == 1 and "og$" not in grams and grams["^^p"] == 1


def test_search_matches_sql(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = exact_topk.top_k(vectors, vectors.vec_id % exact_topk.QUERY_EVERY == 0)
    assert mismatch(found, connect(SF), exact_topk.SQL) is None


@pytest.mark.parametrize("block", [4, 2048])
def test_search_edges(monkeypatch, spark, block):
    monkeypatch.setattr(exact_topk, "BLOCK", block)
    monkeypatch.setattr(exact_topk, "GROUP", 2)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [float("nan")] + [1.0] * 5)]
    rows += [(304, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (50, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cell string, d int")
    usable = [
        (i, np.floor(256 * np.array(v, float)))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()
    ]
    want = []
    for q in sorted({i for i, _ in usable if i % 50 == 0}):
        own = min(tuple(v) for i, v in usable if i == q)
        scored = sorted((-int(np.dot(own, v)), i) for i, v in usable if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    found = exact_topk.top_k(df, df.vec_id % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert exact_topk.top_k(df.limit(0), df.vec_id % 50 == 0).count() == 0
    few = df.where("vec_id IN (0, 1, 2)")
    assert exact_topk.top_k(few, few.vec_id % 50 == 0).count() == 2


@pytest.mark.parametrize("power", [20, 22, 45])
def test_search_with_large_components(spark, power):
    """Beyond 2^20, where doubles and then longs no longer hold the products of all vectors."""
    rng = np.random.default_rng(power)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(150)]
    rows += [(200 + i, [float(2**power + i), *rng.normal(size=4).tolist()]) for i in range(4)]
    rows = [(i, [0.0, *v[1:]] if i % 50 == 0 and power > 40 and i < 200 else v) for i, v in rows]
    if power > 40:
        rows = [(i + 1 if i == 200 else i, v) for i, v in rows]  # no query whose scores fit no long
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for q, own in sorted(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = exact_topk.top_k(df, df.vec_id % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_search_refuses_what_fits_no_long(spark):
    df = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        exact_topk.top_k(df, df.vec_id % 50 == 0).collect()
