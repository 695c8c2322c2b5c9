from llm_fixtures import empty

import corpus_pipeline
from matchspark.llm import queries
from matchspark.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_drop_what_they_must(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "benchmark decontamination",
                                                      "secret scans", "best-fit packing"]
    source = table(spark, SF, "documents")
    first = source.orderBy("doc_id").first()
    leak = " ".join(sorted(first.text.split())) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
    source = docs = source.union(spark.createDataFrame([(10**6, leak, "en", "s", len(leak))], source.schema))
    n, sizes = source.count(), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == source.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.select("doc_id").distinct().count())
    assert n >= sizes[0] >= sizes[1] >= sizes[2] == sizes[3] == sizes[4] > 0.5 * n
    same = {r.doc_id: r.text for r in source.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert texts[10**6].endswith('[SECRET]" end')
    assert all(t == same[d] or "[SECRET]" in t for d, t in texts.items())


def test_stages_on_an_empty_table(spark):
    docs = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_has_a_query():
    found = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert found == set(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
