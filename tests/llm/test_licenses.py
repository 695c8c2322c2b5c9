from llm_fixtures import docs, empty, rows

from matchspark.llm import licenses


def test_whole_texts_lines_and_spellings(spark):
    tail = rows()[0][2:]
    mit = next(t for k, t in licenses.KNOWN if k == "MIT" and len(t) > 500)
    extra = [(800, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,"), *tail),
             (801, "prose\nReleased under the MIT Licence\n\nLicensed  under CC BY-NC 4.0", *tail),
             (802, "This mentions the MIT License in a sentence", *tail), (803, None, *tail), (804, "Copyright 2020 X", *tail)]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, extra), licenses.known_digests(spark)).collect()}
    assert len(got) == len(rows()) + len(extra)
    assert got[800].license == "MIT"
    assert (got[801].license, got[801].notices, got[801].n_notice_lines) == (None, "CC-BY-NC-4.0,MIT", 2)
    assert got[802].license is None and got[802].notices == ""
    assert got[803].digest == got[804].digest and got[803].license is None
    assert all(got[r[0]].license is None for r in rows())


def test_empty_tables_and_no_python(spark):
    known = licenses.known_digests(spark)
    assert licenses.scan(empty(spark), known).count() == 0
    df = licenses.scan(docs(spark), known.limit(0))
    assert {r.license for r in df.collect()} == {None}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
