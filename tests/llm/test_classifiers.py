"""The classifiers: held-out accuracy on the given tables, odd inputs, and the solvers by themselves."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("stagetime.llm.common")
from stagetime.llm import langid, quality, queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (None, "word", "x"), (4, "word " * 30000, "x"), (4, "word", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string").withColumn("quality_score", F.lit("clash")).withColumn("toxic_score", F.lit(1)).withColumn("lang_pred", F.lit(1))


def test_language(spark, odd):
    got = queries.op4_ftrl_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.98 and got.score.between(0, 1).all()
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    out = {(r["doc_id"], r["text"]): r for r in langid.predict(odd, model).collect()}
    assert [out[1, None]["lang_pred"], out[2, ""]["lang_pred"], out[3, "12 !?"]["lang_pred"]] == ["und"] * 3 and len(out) == 6
    assert out[4, "word"]["lang_pred"] in model.langs
    assert langid.predict(odd.limit(0), model).count() == 0
    nothing = langid.fit(odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}


def test_sparse_weights():
    rng = np.random.default_rng(0)
    model = langid.FollowTheLeader(50, 2, l1=1.0)
    for _ in range(400):
        y = int(rng.integers(2))
        model.learn(np.array([y, *rng.choice(np.arange(2, 50), 5, False)]), np.ones(6) / 6**0.5, y)
    w = model.weights()
    assert w[0, 0] > 0 > w[1, 0] and (w[2:] == 0).mean() > 0.5


def test_temperature_is_that_of_the_least_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    p = np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)
    label = np.array([rng.choice(3, p=q) for q in p])
    assert abs(langid.best_temperature(x * 4, label) - 4) < 0.6


def test_quality(spark, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op10_nbsvm_quality(spark, SF).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.97 and got.score.between(0, 1).all()
    one = quality.fit(odd, odd.select("doc_id", F.lit(1).alias("label")))
    rows = quality.score(odd, one).collect()
    assert {r["quality_score"] for r in rows} == {0.5} and len(rows) == 6
    assert quality.score(odd.limit(0), one).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(60, 4)), np.where(rng.random(60) < 0.5, 1.0, -1.0)
    w = quality.dual_coordinate_descent(x.ravel(), np.tile(np.arange(4), 60), np.arange(61) * 4, y, 4, np.full(60, 0.7), epochs=3000)
    loss = lambda v: v @ v / 2 + 0.7 * np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(loss(w) <= loss(w + rng.normal(scale=s, size=4)) + 1e-2 for s in (0.3, 0.1, 0.03) for _ in range(200))


def test_toxicity(spark, odd):
    rng = np.random.default_rng(3)
    mean = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join([*rng.choice(mean, 60), *(rng.choice(["vile", "nasty"], 2) if i % 8 == 0 else [])]), int(i % 8 == 0)) for i in range(1600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2 == 0], "doc_id long, toxic int")
    model = toxicity.fit(docs.filter("doc_id < 1200"), labels.filter("doc_id < 1200"))
    got = toxicity.score(docs.filter("doc_id >= 1200"), model).collect()
    assert all((r["toxic_score"] >= 0.5) == (r["doc_id"] % 8 == 0) for r in got)
    assert toxicity.score(odd, model).count() == 6 and toxicity.score(odd.limit(0), model).count() == 0
    unknown = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert max(r["toxic_score"] for r in toxicity.score(odd, unknown).collect()) < 0.5


def test_toxicity_on_rows_that_no_label_was_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op2_nnpu_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert got.predicted[got.toxic == 1].mean() >= 0.85 and got.predicted[got.toxic == 0].mean() <= 0.04 and got.score.between(0, 1).all()


def test_descent_lowers_the_non_negative_risk():
    rng = np.random.default_rng(6)
    n, p, size, prior = 500, 120, 12, 0.3
    ones = rng.random((n, size)) < 0.3
    ones[:p, 0] = True  # the word of the positives, which a part of the unlabelled has as well
    ones[p:, 0] = rng.random(n - p) < prior
    row, column = np.nonzero(ones)

    def plain(w, bias):
        g = ones @ w + bias
        loss = lambda sign, x: float(np.mean(np.log1p(np.exp(-sign * x))))
        return prior * loss(1, g[:p]) + max(0.0, loss(-1, g[p:]) - prior * loss(-1, g[:p]))

    before = plain(np.zeros(size), float(np.log(prior / (1 - prior))))
    seen = []
    for epochs in (1, 20, 200):
        w, bias = toxicity._descend(row, column, n, p, prior, np.zeros(size), epochs, 0.1)
        assert abs(toxicity.risk(ones @ w + bias, p, prior) - plain(w, bias)) < 1e-9
        seen.append(plain(w, bias))
    assert before > seen[0] > seen[1] >= seen[2] - 1e-3 >= -1e-3 and w[0] == w.max()


def test_counts_are_of_all_rows_and_scores_follow_from_the_weights(spark):
    """Class counts, ratios and scores against one text at a time, with repeats, two labels and a hot id."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["good", "fine", "bad", "poor", "x"], 6, p=[0.4, 0.3, 0.1, 0.1, 0.1] if i % 2 else [0.1, 0.1, 0.4, 0.3, 0.1]))) for i in range(60)]
    rows += [rows[3]] * 5 + [(7, "another text of seven"), (8, None), (9, "")]
    labels = [(i, i % 2) for i in range(60)] + [(3, 1), (7, 0), (11, 5), (None, 1), (999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    known = {(i, y) for i, y in labels if y in (0, 1) and i is not None}
    total, n = np.zeros((2, 1 << quality.BITS)), np.zeros(2)

    def buckets(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return quality._indicators(raw, np.array([0, len(raw)]))[1]

    for i, text in rows:
        for y in (0, 1):
            if (i, y) in known:
                n[y] += 1
                total[y, buckets(text)] += 1
    ratio = np.log((total[1] + 1) / (n[1] + 2)) - np.log((total[0] + 1) / (n[0] + 2))
    assert np.allclose(model.ratio, ratio, atol=1e-5)
    for r in quality.score(docs, model).collect():
        at = buckets(r["text"])
        margin = model.weight[at].sum() / max(np.sqrt((model.ratio[at].astype(float) ** 2).sum()), 1e-9) + model.bias
        assert abs(r["quality_score"] - 1 / (1 + np.exp(-(model.a * margin + model.b)))) < 1e-4


def test_document_frequencies_equal_counting(spark):
    rows = [(1, "abc", "en"), (2, "abd", "en"), (3, "xyz", "de"), (3, "xyz", "de"), (4, None, "de"), (5, "", "en"), (6, "abc", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2))
    known = [t for _, t, lang in rows if lang]
    df = np.zeros(len(model.idf))
    for t in known:
        df[np.unique(langid._terms([t or ""])[1])] += 1
    assert np.allclose(model.idf, np.log((1 + len(known)) / (1 + df)) + 1, atol=1e-5) and model.langs == ["de", "en"]


def test_language_query_equals_plain_logits(spark, tmp_path):
    """The whole query op4 against counting n-grams, plain logits and a softmax, one text at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(900001, "12 34 !!", "en", "s", 1), (900002, None, None, None, None), (900003, "", "de", "s", 0), (900004, "naïve " * 20000, "fr", "s", 1), (5, "once more five", "en", "s", 1)], docs.schema)
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    learn = lambda i: zlib.crc32(str(i).encode()) % 3 != 1
    model = langid.fit(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    df, known = np.zeros(1 << langid.BITS), [t for i, t, lang in rows if lang is not None and learn(i)]
    for t in known:
        df[np.unique(langid._terms([t or ""])[1])] += 1
    want = []
    for i, t, _ in rows:
        if not any(map(str.isalpha, t or "")):
            want.append((i, not learn(i), "und", 0.0))
            continue
        _, bucket, n = langid._terms([t])
        value = (1 + np.log(n)) * (np.log((1 + len(known)) / (1 + df[bucket])) + 1)
        x = (value / np.sqrt((value**2).sum()) @ model.weight[bucket].astype(float) + model.weight[-1]) / model.temperature
        p = np.exp(x - x.max())
        want.append((i, not learn(i), model.langs[int(p.argmax())], float(p.max() / p.sum())))
    got = sorted(map(tuple, queries.op4_ftrl_langid(spark, str(tmp_path)).collect()))
    assert [x[:3] for x in got] == [x[:3] for x in sorted(want)] and np.allclose([x[3] for x in got], [x[3] for x in sorted(want)], atol=1e-3)


def test_toxicity_query_equals_counting(spark, tmp_path):
    """The vocabulary, the shares of words over all texts, and every score of op2 against plain counting."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900002, None), (900003, ""), (900004, "word " * 50000)], "doc_id long, text string")).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    own, train = docs.filter(fold), toxicity.train

    def watched(row, column, n, p, share, prior):
        seen.update(share=share, n=n, p=p, prior=prior, out=train(row, column, n, p, share, prior))
        return seen["out"]

    toxicity.train = watched
    try:
        model = toxicity.fit(own, labels.filter(fold))
    finally:
        toxicity.train = train
    parts = lambda t: set(toxicity._parts(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[1].tolist())
    texts = [(r["doc_id"], r["text"]) for r in own.collect()]
    positive = {r["doc_id"] for r in labels.filter(fold).filter("toxic = 1").collect()}
    # Under its bound the sample of either kind is all rows, so the vocabulary is that of every text, positives counted twice.
    count, twice = Counter(w for _, t in texts for w in parts(t)), Counter(w for i, t in texts if i in positive for w in parts(t))
    vocabulary = sorted(w for w in count if count[w] + twice[w] >= 5)
    assert seen["p"] == len(positive & {i for i, _ in texts}) and seen["n"] == len(texts) + seen["p"]
    assert np.allclose(seen["share"], [count[w] / len(texts) for w in vocabulary])
    known = labels.filter(fold).filter("toxic is not null").collect()
    assert abs(seen["prior"] - min(max(sum(r["toxic"] for r in known) / len(known), 1e-3), 0.9)) < 1e-12
    chosen, w, bias = seen["out"]
    weight = {vocabulary[c]: x for c, x in zip(chosen, w, strict=True)}
    got = {r["doc_id"]: r["score"] for r in queries.op2_nnpu_toxicity(spark, str(tmp_path)).collect()}
    for r in docs.collect():
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-(bias + sum(weight.get(x, 0.0) for x in parts(r["text"])))))) < 1e-6
    assert len(got) == docs.count() and model.bias == bias


def test_samples_keep_their_bound(spark):
    from stagetime.llm import sampling

    hot = spark.range(50_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit("a").alias("label"))
    same = spark.range(50_000).select(F.lit(2).cast("long").alias("doc_id"), F.lit("copy").alias("text"), F.lit("a").alias("label"))
    few = spark.range(30).select((F.col("id") + 10).alias("doc_id"), F.lit("few").alias("text"), F.lit("b").alias("label"))
    got = {r[0]: r[1] for r in sampling.bounded_by_class(hot.union(same).union(few), "label", 500).groupBy("label").count().collect()}
    assert 0 < got["a"] <= 600 and got["b"] == 30
    ids = sampling.least_ids(few.select("doc_id", "label").union(few.select("doc_id", F.lit("c"))), "label", ("b", "c"), 7)
    assert ids.count() == 14
    texts = sampling.one_text_each(hot.union(few), ids.filter("label = 'b'").union(spark.createDataFrame([(1, "b")], "doc_id long, label string")))
    assert texts.count() == 8 and texts.filter("doc_id = 1").count() == 1


def test_scratch_tables(spark, monkeypatch):
    from stagetime.llm import common

    scratch = common.Scratch(spark)
    first = scratch.stored(spark.range(3).toDF("a"), "x")
    second = scratch.stored(first.withColumn("a", F.col("a") + 1), "x")
    assert sorted(r["a"] for r in second.collect()) == [1, 2, 3] and len(scratch.paths) == 1
    scratch.drop("x", "unknown")
    assert not scratch.paths

    class Far:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(dict)
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_root(Far)
