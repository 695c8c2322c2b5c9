"""Small documents with the awkward cases every operator must survive."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rep long, bucket int, label string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def prose(rnd, n, words=None):
    words = words or ["the", "of", "and", "river", "stone", "winter", "Garden", "élan", "über", "niño", "open", "seven",
                      "glass", "tower", "music", "paper", "north", "quiet", "engine", "harbor"]
    return " ".join(rnd.choice(words) + str(rnd.randint(0, 40)) for _ in range(n))


def rows(seed=5):
    rnd = random.Random(seed)
    out, passage = [], prose(rnd, 60)
    base = prose(rnd, 120)
    texts = [None, "", " \t\n ", "word", "two words", "a b c d e", "A B c D e", base, base, base.replace("the", "The")]
    for k in range(8):                                     # near copies
        w = base.split(" ")
        w[10 * k + 3] = f"edit{k}"
        texts.append(" ".join(w))
    for _ in range(6):                                     # a passage that several documents share
        texts.append(prose(rnd, 30) + "\n" + passage + "\n" + prose(rnd, 25))
    texts += ["for " * 300, ("tick tock " * 80).strip(), prose(rnd, 6000), "日本語 テキスト です", "x" * 5000]
    texts += [prose(rnd, rnd.randint(1, 90)) for _ in range(20)]
    for i, t in enumerate(texts):
        out.append((i * 3, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}",
                    None if t is None else len(t), "k", -1, 7, "z"))
    return out


def docs(spark, extra=()):
    return spark.createDataFrame([*rows(), *extra], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)
