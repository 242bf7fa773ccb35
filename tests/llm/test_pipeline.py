"""The pipeline's stages one after another, on the smallest tables and on a table of odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")
from stagetime.llm import pii, quality  # noqa: E402
from stagetime.llm.tokens import default_vocabulary  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, None, "en", "s", 0), (900001, "", "en", "s", 0), (900002, None, None, None, None)], docs.schema)
    kept = docs.unionByName(extra).withColumn("leaks", F.lit(1))
    ids = None
    for k, (_, stage) in enumerate(pipeline.STAGES):
        columns = kept.columns
        out = stage(spark, kept, SF)
        out.write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(pipeline.STAGES) - 1:
            assert set(docs.columns) <= set(kept.columns) <= set(columns)
            now = {r[0] for r in kept.select("doc_id").collect()}
            assert ids is None or now <= ids
            ids = now
    assert {r[0] for r in kept.select("doc_id").distinct().collect()} == ids


def test_run_and_empty(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on what the one before it kept, held against plain Python."""
    from test_text_operators import brute_bm25, brute_components, plain_disclosure

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(None, "nameless text here", "en", "s", 0), (900001, "", "en", "s", 0), (900002, None, None, None, None)], docs.schema)).withColumn("leaks", F.lit(1)).withColumn("quality_score", F.lit("kept"))
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    def step(k, kept):
        pipeline.STAGES[k][1](spark, kept, SF).write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    good = step(0, docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels)

    def plain_score(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        at = quality._indicators(raw, np.array([0, len(raw)]))[1]
        margin = model.weight[at].sum() / max(np.sqrt((model.ratio[at].astype(float) ** 2).sum()), 1e-9) + model.bias
        return 1 / (1 + np.exp(-(model.a * margin + model.b)))

    scores = [(i, t, plain_score(t)) for i, t in rows(docs)]
    sure = [x for x in scores if abs(x[2] - 0.5) > 1e-4]
    assert {x[:2] for x in sure if x[2] >= 0.5} <= set(rows(good)) <= {x[:2] for x in scores if x[2] >= 0.5 - 1e-4} and good.columns == docs.columns
    assert {r["quality_score"] for r in good.collect()} == {"kept"} and {r["leaks"] for r in good.collect()} == {1}

    single = step(1, good)
    kept = [eval(x) for x in brute_components(rows(good), 80)]
    assert rows(single) == [x for x in rows(good) if x[0] is None or (x[0] in {k[0] for k in kept if k[3]})]

    clean = step(2, single)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = rows(single)
    assert rows(clean) == [x for x, leaks in zip(texts, brute_bm25([t for _, t in texts], items), strict=True) if not leaks] and clean.columns == docs.columns

    masked = step(3, clean)
    near, decoys, places = plain_disclosure([(k, t) for k, (_, t) in enumerate(rows(clean))])
    risky = {x for x, bits in near.items() if bits <= 2.0}
    assert {i for i, _ in rows(masked)} == {i for i, _ in rows(clean)} and masked.count() == clean.count()
    plain = {}
    for k, (i, t) in enumerate(rows(clean)):
        base = [(s, pii.KINDS[kind].upper(), e) for s, kind, e in pii.base_spans(t or "")]
        assert not any(x in risky for j, e, x in [(j, e, (e, w[2])) for j, e, w in places] if j == k)  # so base spans are all there is
        out, done = "", 0
        for s, kind, e in base:
            if e > done:
                out, done = out + (t[done:s] + f"[{kind}]" if s >= done else ""), e
        plain.setdefault(i, []).append(None if t is None else out + t[done:])
    got = {}
    for i, t in rows(masked):
        got.setdefault(i, []).append(t)
    assert {i: sorted(x, key=str) for i, x in got.items()} == {i: sorted(x, key=str) for i, x in plain.items()}

    packed = step(4, masked)
    from tokenizers import Tokenizer

    tokenizer, sizes = Tokenizer.from_file(default_vocabulary()), {}
    for i, t in rows(masked):
        sizes[i] = sizes.get(i, 0) + len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    assert {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == sizes
    gaps = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"), F.count_distinct("offset").alias("starts"), F.count("*").alias("pieces"))
    assert gaps.filter("n <> end or starts <> pieces or n > 2048").count() == 0
