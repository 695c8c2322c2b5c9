import random

from llm_fixtures import docs, empty, rows
from pyspark.sql import functions as F

from matchspark.llm import language

WORDS = {"en": "the of and house river that with".split(), "de": "der und nicht schön über straße mit".split(),
         "es": "el niño que está mañana los con".split()}


def corpus(spark, n=150):
    r = random.Random(4)
    data = [(i, " ".join(r.choice(WORDS[k]) for _ in range(r.randint(3, 60))), k) for i, k in
            ((i, "en de es".split()[i % 3]) for i in range(n))]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    df = corpus(spark)
    model = language.train(df, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    truth = {r.doc_id: r.lang for r in df.collect()}
    held = [d for d in truth if d % 5 == 0]
    assert sum(got[d].lang_pred == truth[d] for d in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    assert (model.weights == 0).mean() > 0.9            # elastic net keeps the model sparse


def test_odd_texts_and_filter(spark):
    model = language.train(corpus(spark), F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs(spark), model).collect()}
    assert got[0] == got[3] == got[6] == ("und", 0.0) and len(got) == len(rows())
    assert got[9][0] != "und"
    kept = language.in_known_language(docs(spark), model, 0.4)
    assert kept.columns == docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {d for d, (p, s) in got.items() if p != "und" and s >= 0.4}


def test_nothing_to_learn(spark):
    model = language.train(empty(spark), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs(spark), model).collect()} == {"und"}
    assert language.predict(empty(spark), model).count() == 0
