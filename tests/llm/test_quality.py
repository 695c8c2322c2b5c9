from collections import Counter

from llm_fixtures import docs, empty, rows, words

from matchspark.llm import quality


def plain(text):
    w, text = words(text), text or ""
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    extra = [(900, "a b\na b\n\na b \n#*$ | <x>", *rows()[0][2:]), (901, "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8", *rows()[0][2:])]
    got = {r.doc_id: r for r in quality.quality(docs(spark, extra)).collect()}
    for d, t in [(r[0], r[1]) for r in rows()] + [(x[0], x[1]) for x in extra]:
        r = got[d]
        n = plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, d
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r.kept and r.base_failed)


def _prose(i, n=60, size=97):
    return [f"word{(i * 7 + k * k) % size}x{k}" for k in range(n)]


def _marks(n):
    return " ".join(f"#{k}" for k in range(n))


def test_one_planted_outlier_per_metric_and_source(spark):
    """Every source has its own habits; what is ordinary in one is an outlier in another."""
    rows, planted = [], {}
    for s, marks in (("plain", 0), ("marked", 40)):
        for i in range(300):
            w = _prose(i)
            lines = [" ".join(w[k:k + 6]) for k in range(0, 60, 6)]
            rows.append((len(rows), "\n".join(lines) + " " + _marks(marks + i % 3), "en", s))
        base = _prose(999)
        lines = [" ".join(base[k:k + 6]) for k in range(0, 60, 6)]
        planted[len(rows)] = "symbols" if s == "plain" else None   # ordinary where sources mark their text
        rows.append((len(rows), "\n".join(lines) + " " + _marks(60), "en", s))
        planted[len(rows)] = "lines"
        rows.append((len(rows), "\n".join(lines + [f"short {k % 2}" for k in range(8)]) + " " + _marks(marks), "en", s))
        planted[len(rows)] = "repeats"
        rows.append((len(rows), " ".join(_prose(999, 160, 997) + _prose(999, 22, 997)) + " " + _marks(marks), "en", s))
        planted[len(rows)] = "long words"
        rows.append((len(rows), " ".join(x * 9 for x in base) + " " + _marks(marks), "en", s))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    for i, r in got.items():
        assert not r.base_failed, i
        assert r.kept == (planted.get(i) is None), (i, planted.get(i))


def test_fences_follow_the_sketches_and_shrink_smoothly(spark):
    rows = [(lang, "s", r / 100, 100, r, False) for lang, top in (("en", 10), ("de", 40)) for r in range(top) for _ in range(30)]
    rows += [("en", "tiny", .9, 100, 90, False)]
    df = spark.createDataFrame(rows, "lang string, source string, symbol_rate double, word_chars long, n_symbols long, base_failed boolean")
    df = df.selectExpr("*", *(f"0D as {m}" for m in quality.METRICS if m != "symbol_rate"))
    by = {r.lang: r.symbol_rate_high for r in quality.fences(df, ["lang"]).collect()}
    assert abs(by["de"] - (.38 + 3 * (.38 - .20))) < .05 and by["en"] < by["de"] / 2
    seen = [spark.range(1).selectExpr(f"{n}L as size", "1D as own").select(
        quality._shrunk("size", "own", quality.F.lit(0.0))).first()[0] for n in (0, 1, 50, 10**6)]
    assert seen[0] == 0 and 0 < seen[1] < .02 and seen[2] == .5 and seen[3] > .999


def test_repeated_and_null_ids(spark):
    text = " ".join(_prose(1))
    df = spark.createDataFrame([(None, text, "en", None), (4, text, "en", None), (4, "short", None, "s")],
                               "doc_id long, text string, lang string, source string")
    assert sorted(((r.doc_id, r.n_words, r.kept) for r in quality.quality(df).collect()), key=repr) == [
        (4, 1, False), (4, 60, True), (None, 60, True)]


def test_empty_table_and_no_python(spark):
    assert quality.quality(empty(spark)).count() == 0
    plan = quality.measures(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
