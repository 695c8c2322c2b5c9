import random

from llm_fixtures import docs, empty, prose, rows

from matchspark.llm import tiling

BENCH = "item_id long, text string, key string"


def test_verbatim_reordered_and_clean(spark):
    rnd = random.Random(1)
    item = prose(rnd, 40, [f"q{i}" for i in range(200)])
    w = item.split(" ")
    shuffled = " ".join(w[30:] + w[10:20] + w[:10] + w[20:30])
    extra = [(9000, "intro " + item.upper() + " outro", *rows()[0][2:]), (9001, "x " + shuffled, *rows()[0][2:]),
             (9002, " ".join(w[:12]) + " other things", *rows()[0][2:])]
    bench = spark.createDataFrame([(1, item, "k"), (2, None, "k"), (3, "", "k"), (4, "one two", "k"), (5, item, "k")], BENCH)
    got = {r.doc_id: r for r in tiling.decontaminate(docs(spark, extra), bench).collect()}
    assert len(got) == len(rows()) + 3
    assert {d for d, r in got.items() if r.contaminated} == {9000, 9001}
    assert got[9000].coverage == 1.0 and got[9000].item_ids == [1, 5] and got[9001].coverage >= 0.9
    assert 0 < got[9002].coverage < 0.5 and got[0].coverage == 0


def test_blocks_give_the_same(spark, monkeypatch):
    bench = spark.createDataFrame([(i, r[1], "k") for i, r in enumerate(rows()[7:20])], BENCH)
    key = lambda df: sorted((r.doc_id, r.coverage, tuple(r.item_ids), r.n_tiles) for r in df.collect())
    one = key(tiling.decontaminate(docs(spark), bench))
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 1500)
    assert key(tiling.decontaminate(docs(spark), bench)) == one
    # every benchmark text is itself contaminated
    ids = {r[0] for r in rows()[7:20]}
    assert ids <= {d for d, c, *_ in one if c == 1.0}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], BENCH)
    assert not any(r.contaminated for r in tiling.decontaminate(docs(spark), bench).collect())
    assert tiling.decontaminate(empty(spark), bench).count() == 0


def greedy(doc, item, least):
    """Plain greedy string tiling."""
    used_d, used_i, out = set(), set(), 0
    for size in range(min(len(doc), len(item)), least - 1, -1):
        for i in range(len(doc) - size + 1):
            for j in range(len(item) - size + 1):
                if doc[i:i + size] == item[j:j + size] and not used_d & set(range(i, i + size)) \
                        and not used_i & set(range(j, j + size)):
                    used_d |= set(range(i, i + size))
                    used_i |= set(range(j, j + size))
                    out += size
    return out


def test_tiles_equal_plain_tiling():
    import pyarrow as pa

    from matchspark.llm.words import SPACES, batch_words
    rnd = random.Random(2)
    for _ in range(25):
        item = [f"w{rnd.randint(0, 12)}" for _ in range(25)]
        doc = [f"w{rnd.randint(0, 12)}" for _ in range(20)] + item[5:17] + [f"z{k}" for k in range(4)] + item[:7]
        w = next(iter(batch_words(pa.array([" ".join(doc)]), SPACES, True)))[2]
        block = tiling._Block([(1, " ".join(item))], 4)
        found = list(tiling._findings(w, block, 4))
        assert sum(f[2] for f in found) == greedy(doc, item, 4)
