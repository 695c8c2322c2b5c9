import random

import numpy as np
from llm_fixtures import docs, empty, prose, rows

from matchspark.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, key string"


def corpus(spark):
    r = random.Random(8)
    data, labels = [], []
    for i in range(200):
        text = prose(r, 60, [f"w{k}" for k in range(150)])
        bad = i % 4 == 0
        if bad:
            for _ in range(1 + i % 9):
                text += " " + r.choice(["vile", "Scoundrel!", "wretch"])
        data.append((i, text))
        labels.append((i, 1, int(bad), "k"))
    return spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_severity(spark):
    df, labels = corpus(spark)
    model = toxicity.train(df, labels.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r for r in toxicity.predict(df, model).collect()}
    held = [d for d in got if d % 5 == 0]
    assert sum(got[d].toxic == (d % 4 == 0) for d in held) / len(held) >= 0.95
    assert list(model.thresholds) == sorted(model.thresholds)
    mild = np.mean([got[d].expected_severity for d in got if d % 4 == 0 and d % 9 < 2])
    harsh = np.mean([got[d].expected_severity for d in got if d % 4 == 0 and d % 9 > 6])
    assert harsh > mild and all(0 <= r.expected_severity <= 3 for r in got.values())


def test_odd_texts_and_missing_labels(spark):
    none = toxicity.train(docs(spark), spark.createDataFrame([], LABELS))
    got = toxicity.predict(docs(spark), none).collect()
    assert len(got) == len(rows()) and not any(r.toxic for r in got)
    one = toxicity.train(docs(spark), spark.createDataFrame([(21, 1, 1, "k"), (21, 0, None, "k")], LABELS))
    assert not len(one.keys)
    assert toxicity.predict(empty(spark), none).count() == 0
