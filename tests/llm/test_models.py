"""Language ID, toxicity chain and nearest neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmart.llm import langid, nn_descent, toxicity_chain

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, no_id int"


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, langid.id_remainder() != 2)
    out = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(langid.id_remainder() == 2)
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.98


def test_language_id_equals_plain_naive_bayes(spark):
    rows = [(1, "aa ab", "x"), (2, "ab ab ba!", "x"), (3, "cc cd", "y"), (4, None, "y"), (5, "dc cc", None)]
    docs = spark.createDataFrame([(i, t, g, "s", 0) for i, t, g in rows], DOCS)
    model = langid.fit(docs, F.lit(True), orders=(1, 2), buckets=1 << 12)
    assert model.languages == ("x", "y")
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    grams = lambda t: [c for c in t if c != " "] + [t[i:i + 2] for i in range(len(t) - 1)]
    train = {"x": grams("aa ab") + grams("ab ab ba "), "y": grams("cc cd")}

    def joint(text, lang, prior):
        total = len(train[lang]) + 0.5 * (1 << 12)
        return np.log(prior) + sum(np.log((train[lang].count(g) + 0.5) / total) for g in grams(text))

    for i, text in ((1, "aa ab"), (2, "ab ab ba "), (3, "cc cd"), (5, "dc cc")):
        a, b = joint(text, "x", 2 / 3), joint(text, "y", 1 / 3)
        assert got[i]["lang_pred"] == ("x" if a > b else "y")
        assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(-abs(a - b))))
    assert (got[4]["lang_pred"], got[4]["score"]) == ("und", 0.0)


def test_language_id_odd_rows(spark):
    big = 2**60 + 1
    rows = [(1, "abc def", "x"), (big, "123 !?", "x"), (None, "abc", "x"), (2, "", "x"), (2, "", "x"),
            (3, "abc " * 200000, "x"), (4, "zzz", "y")]
    docs = spark.createDataFrame([(i, t, g, "s", 0) for i, t, g in rows], DOCS)
    model = langid.fit(docs, F.lit(True))
    out = langid.predict(docs, model).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in out}
    assert len(out) == 7 and by == {1: "x", big: "und", None: "x", 2: "und", 3: "x", 4: "y"}
    kept = langid.keep_known(docs, model, 0.5)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, None, 3, 4}
    none = langid.fit(docs, F.lit(False))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), none).isEmpty()
    with pytest.raises(ValueError):
        langid.fit(docs, F.lit(True), max_languages=1)


def test_toxicity_chain_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("low", 1 - F.col("quality"))
    even = F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0
    chain = toxicity_chain.fit_chain(docs, labels.filter(even), ["low", "toxic"])
    rest = labels.filter(~even)
    held = docs.join(rest.select("doc_id"), "doc_id")
    out = toxicity_chain.score(held, chain).join(rest.select("doc_id", F.col("toxic").alias("y")), "doc_id").toPandas()
    flagged = out["flags"].map(lambda f: "toxic" in f)
    assert flagged[out.y == 1].mean() > 0.9 and flagged[out.y == 0].mean() < 0.02


def test_toxicity_chain_uses_the_earlier_category(spark):
    """The second category is the first one's, seen through words it cannot see itself."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(300):
        first = i % 2
        rows.append((i, " ".join(["bad" if first else "good"] + [f"w{k}" for k in rng.integers(0, 50, 8)]), "x"))
        labels.append((i, first, first))
    docs = spark.createDataFrame(rows, "doc_id long, text string, p0 string")
    chain = toxicity_chain.fit_chain(docs, spark.createDataFrame(labels, "doc_id long, a int, b int"), ["a", "b"])
    assert len(chain[1].weights) == len(chain[1].ids) + toxicity_chain.SHAPES + 2 and chain[1].weights[-2] > 0
    out = {r["doc_id"]: r["flags"] for r in toxicity_chain.score(docs, chain).collect()}
    assert all(out[i] == (["a", "b"] if i % 2 else []) for i in range(300))


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, "bad", "x"), (2, None, "x"), (3, "", "x"), (None, "bad thing", "x"), (1, "bad", "x"),
                                  (4, "nice", "x")], "doc_id long, text string, flags string")
    labels = spark.createDataFrame([(1, 1, 1), (4, 0, 1), (4, 0, 1), (None, 1, 1), (2, None, 1)],
                                   "doc_id long, a int, b int")
    chain = toxicity_chain.fit_chain(docs, labels, ["a", "b"])
    out = toxicity_chain.score(docs, chain).collect()
    assert len(out) == 6 and chain[1].constant == 1.0
    assert all(r["a"] == 0.0 and r["b"] == 0.0 for r in out if r["doc_id"] in (2, 3))
    unknown = toxicity_chain.fit_chain(docs, labels.limit(0), ["a", "b"])
    rows = toxicity_chain.score(docs, unknown).collect()
    assert all(r["a"] is None and r["flags"] == [] for r in rows)
    assert toxicity_chain.score(docs.limit(0), chain).isEmpty()


def _exact(rows, queries, k):
    out = {}
    for q, v in queries:
        d = sorted((float(np.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(v, w)))), i) for i, w in rows if i != q)
        out[q] = d[:k]
    return out


def test_nearest_neighbours_recall_and_scores(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    asked = [r for r in rows if r[0] % 25 == 0]
    out = nn_descent.nearest_neighbours(vectors, vectors.filter("vec_id % 25 = 0"), 10).collect()
    want = _exact(rows, asked, 10)
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert all([r["rank"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] == list(range(1, 11))
               for q in want)
    hit = np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want])
    assert hit >= 0.9
    true = dict(rows)
    for q, found in got.items():
        assert found == sorted(found)
        for s, i in found:
            assert s == pytest.approx(np.linalg.norm(np.float64(true[q]) - np.float64(true[i])), abs=1e-12)


def test_nearest_neighbours_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(50)] + [(50 + i, rng.standard_normal(3).tolist()) for i in range(30)]
    odd = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [float("nan"), 1.0, 1.0]), (203, [1.0]), (None, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank string")
    out = nn_descent.nearest_neighbours(df, df.filter("vec_id in (0, 3, 49, 60, 200)"), 10).collect()
    want = _exact(rows, [r for r in rows if r[0] in (0, 3, 49, 60)], 10)
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for _, i in w] for q, w in want.items()}
    few = nn_descent.nearest_neighbours(df.filter("vec_id in (0, 50, 51)"), df.filter("vec_id = 0"), 10).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] == [
        i for _, i in _exact([r for r in rows if r[0] in (0, 50, 51)], [rows[0]], 10)[0]]
    outside = spark.createDataFrame([(999, [0.9, 0.1, 0.0])], "vec_id long, embedding array<double>")
    near = nn_descent.nearest_neighbours(df, outside, 5).collect()
    assert [r["vec_id"] for r in sorted(near, key=lambda r: r["rank"])] == [
        i for _, i in _exact(rows, [(999, [0.9, 0.1, 0.0])], 5)[999]]
    assert nn_descent.nearest_neighbours(df.limit(0), df, 5).isEmpty()
    assert nn_descent.nearest_neighbours(df, df.limit(0), 5).isEmpty()


def test_nn_descent_goes_on_until_few_edges_change(spark):
    x = np.random.default_rng(8).standard_normal((3000, 48)).astype(np.float32)
    nodes = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(nn_descent.encode(x))], "id long, code binary")
    d = (x * x).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * x @ x.T
    np.fill_diagonal(d, np.inf)
    near = {(a, b) for a, row in enumerate(np.argpartition(d, 5, axis=1)[:, :6].tolist()) for b in row}
    hits = [len(near & {(r["a"], r["b"]) for r in nn_descent.build_graph(nodes, 6, **kw).collect()})
            for kw in ({}, {"rounds": 5})]
    assert hits[0] > hits[1]
    small, check_l, large = (nn_descent.sizes(n) for n in (2_000, 51_282, 3_000_000))
    assert all(a <= b < c for a, b, c in zip(small, check_l, large))
