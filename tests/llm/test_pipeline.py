"""The pipeline's stages in turn, each over what the one before kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import toxicity


def test_stages(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{d}/labels.parquet"))
            bad = toxicity.score(before, *model).where("predicted = 1").count()
            assert counts[-1] == counts[-2] - bad
        if name == "pii":
            assert docs.where(F.col("text").rlike("[a-z0-9]@mail")).count() == 0
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_awkward_documents(spark, tmp_path):
    """Null and repeated ids, null, empty and very long texts, repeated rows; and no documents at all."""
    long = " ".join(f"w{i % 5000} mail{i}@x.yz" if i % 40 == 0 else f"w{i % 5000}" for i in range(60_000))
    rows = [(None, "nothing here", "en", "a", 12), (None, None, None, None, None), (5, None, "en", "a", 0), (6, "", "en", "a", 0), (7, " \n\t", "en", None, 3), (8, "one two three " * 30, "en", "b", 1), (9, "one two three " * 30, "en", "b", 1), (9, "one two three " * 30, "en", "b", 1), (9, "other words é", "en", None, 1), (10, long, "en", "c", 1), (11, "x" * 300_000, "en", "c", 1), (12, "write to a@b.cd or +1 (555) 123-4567 now", "en", "c", 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for name, df in (("some", docs), ("none", docs.limit(0))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(8, 1, 0), (9, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, f"{tmp_path}/some")
        assert kept.schema.names == docs.schema.names
        out = kept.collect()
        if name == "toxicity":
            assert len(out) == len(rows)
        if name == "jaccard_join":
            assert sorted(r["doc_id"] for r in out if r["text"] and r["text"].startswith("one two")) == [8] and len(out) == len(rows) - 2
        if name == "pii":
            by = {r["doc_id"]: r for r in out}
            assert by[12]["text"] == "write to [email] or [phone] now" and by[12]["n_chars"] == 31 and by[5]["n_chars"] == 0
            assert by[10]["text"].count("[email]") == 1500 and "@" not in by[10]["text"]
        if name == "mixing":
            assert all(r["text"] and r["text"].strip() for r in out)
    packed = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in out} and max(r["length"] for r in packed) <= 1024
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_clashing_columns_stay(spark, tmp_path):
    from meterline.llm import jaccard_join, mixing, pii, quality

    names = "key row text_ _text _words _salt _n _of _number number whole spans _spans _at body size_ first at".split()
    rows = [(i, f"doc {i} says a{i}@b.cd to all of you " * 8, "s", *(f"{n}{i}" for n in names)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for f in (jaccard_join.one_of_each, mixing.mixed, pii.redacted, quality.quality_cascade, mixing.mix):
        got = f(docs).select("doc_id", *names).distinct().collect()
        assert {tuple(r) for r in got} <= {(r[0], *r[3:]) for r in rows} and len(got) == 6, f.__name__
