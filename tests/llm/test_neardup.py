import pytest
from llm_fixtures import docs, empty, rows, words

from matchspark.llm import common, neardup


def sets_of(source):
    out = {}
    for d, t in source:
        w = words(t, lower=True)
        out[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(source):
    s, label = sets_of(source), {}
    ids = sorted(s)
    near = {d: [e for e in ids if s[d] and s[e] and 100 * len(s[d] & s[e]) >= 85 * len(s[d] | s[e])] for d in ids}
    for d in ids:
        if d not in label:
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = d
                    todo += near[x]
    return {d: (len(s[d]), label[d]) for d in ids}


def test_equals_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(spark)).collect()}
    assert got == brute([(r[0], r[1]) for r in rows()])


def test_group_without_links_and_chain(spark):
    """Documents at similarity under the threshold, and a chain that only its middle joins."""
    base = [f"w{i}" for i in range(200)]
    source = [(100, " ".join(base))]
    for k in range(6):                          # pairwise below 0.85, all far from the base
        source.append((k, " ".join([*base[:120], *[f"own{k}x{i}" for i in range(80)]])))
    for k in range(4):                          # each is near its neighbour only
        w = [*base]
        w[:12 * k] = [f"c{i}" for i in range(12 * k)]
        source.append((200 + k, " ".join(w)))
    df = spark.createDataFrame(source, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == brute(source)


def test_empty_and_repeated_rows(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    twice = spark.createDataFrame([(4, "a b"), (4, "a b"), (2, "A b"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(twice).collect())
    assert got == [(2, 1, 2), (4, 1, 2), (4, 1, 2), (9, 0, 9)]


@pytest.mark.parametrize("swapped", [False, True])
def test_repeated_doc_ids_lose_no_link(spark, swapped):
    """Two texts under one id, each with a near copy under another id, in either order of the rows."""
    p, q = ([f"{c}{i}" for i in range(200)] for c in "pq")
    near = lambda w, tag: " ".join([*w[:195], *[f"{tag}{i}" for i in range(5)]])
    both = [(1, " ".join(p)), (1, " ".join(q))]
    source = (both[::-1] if swapped else both) + [(2, near(p, "x")), (3, near(q, "y")), (3, near(q, "y")), (8, "p0 p1"),
                                                  (None, near(p, "z")), (None, "alone here"), (None, "Alone here"), (None, None)]
    df = spark.createDataFrame(source, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 196, 1), (1, 196, 1), (2, 196, 1), (3, 196, 1), (3, 196, 1), (8, 1, 8), (None, 196, 1),
                          (None, 1, None), (None, 1, None), (None, 0, None)], key=repr)


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in common.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 7: 7}


def test_stage_links_from_a_similarity_of_080(spark):
    from matchspark.llm import queries
    base = [f"w{i}" for i in range(204)]                   # 200 shingles
    near = [*base[:184], *[f"x{i}" for i in range(20)]]    # 180 of 220 shared: 0.818
    far = [f"{w}z" for w in base]
    less = [*far[:179], *[f"y{i}" for i in range(25)]]     # 175 of 225 shared: 0.778
    source = [(k, " ".join(w)) for k, w in enumerate((base, near, far, less))]
    s = sets_of(source)
    assert 0.80 < len(s[0] & s[1]) / len(s[0] | s[1]) < 0.85 and len(s[2] & s[3]) / len(s[2] | s[3]) < 0.80
    df = spark.createDataFrame(source, "doc_id long, text string")
    assert sorted(r.doc_id for r in queries.stage_near_dedup(spark, df, "").collect()) == [0, 2, 3]
