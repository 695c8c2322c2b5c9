import os

import pytest
from conftest import SF_SMALL

from matchspark.operators import joins, quality
from matchspark.sources import seasons, sinks, standins


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture()
def season_dir(tmp_path):
    d = str(tmp_path)
    for s, extra in (("2022", ""), ("2023", "")):
        _write(d, f"{s} Fantasy Offense Stats.csv", "Name,GP,PTS,All,Run,Pass,QB\nA,17,28.5,82.3,30.1,50.2,18.0\n"
                                                       "B,17,24.0,75.0,28.0,47.0,16.5\nC,16,21.5,70.2,25.1,45.1,14.0\n")
        _write(d, f"{s} Fantasy Defense Stats.csv", "Name,GP,PA,DEF,QB\nA,17,20.1,6.5,15.2\nB,17,22.0,7.1,17.0\n"
                                                       "C,16,25.3,8.0,19.5\n")
        _write(d, f"{s} Schedule.csv", "Week,Team1,Team2\n1,A,B\n2,B,C\n3,A,C\n4,A,Z\n")
    return d


def test_scan_tags_season_from_file_name(spark, season_dir):
    off = seasons.read_kind(spark, season_dir, "offense", ["2022", "2023"])
    got = sorted((r["season"], r["Name"]) for r in off.collect())
    assert got[0] == ("2022", "A") and len(got) == 6
    assert dict(off.dtypes)["GP"] == "int" and dict(off.dtypes)["PTS"] == "double"


def test_union_by_name_with_other_column_order(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "2021 Fantasy Offense Stats.csv", "Name,GP,PTS,All,Pass,Run,QB\nA,17,1,2,3,4,5\n")
    _write(d, "2022 Fantasy Offense Stats.csv", "Name,GP,PTS,All,Run,Pass,QB,RB\nA,17,1,2,4,3,5,6\n")
    off = seasons.read_kind(spark, d, "offense", ["2021", "2022"])
    rows = {r["season"]: r for r in off.collect()}
    assert rows["2021"]["Pass"] == rows["2022"]["Pass"] == 3.0
    assert rows["2021"]["RB"] is None and rows["2022"]["RB"] == 6.0


def test_missing_file(spark, season_dir):
    with pytest.raises(FileNotFoundError, match="not found"):
        seasons.check_files(spark, season_dir, ["2019"])


def test_load_merge_and_reject(spark, season_dir):
    off = seasons.read_kind(spark, season_dir, "offense", ["2023"])
    dfn = seasons.read_kind(spark, season_dir, "defense", ["2023"])
    sch = seasons.read_kind(spark, season_dir, "schedule", ["2023"])
    for df, kind in ((off, "offense"), (dfn, "defense"), (sch, "schedule")):
        assert quality.validate_data(df, kind)
    extra = (*seasons.POSITION, seasons.BAD, seasons.REJECT)
    stats = joins.merge_team_stats(off.drop(*extra), dfn.drop(*extra))
    assert stats.columns[-1] == "GP" and "off_PTS" in stats.columns and "def_PA" in stats.columns
    games = seasons.schedule_games(sch)
    ok = joins.games_with_stats(games, stats)
    bad = joins.unmatched_games(games, stats)
    assert ok.count() == 3
    assert [(r["team2"], r["missing"]) for r in bad.collect()] == [("Z", "team2")]
    assert "team1_off_PTS" in ok.columns and "team2_def_DEF" in ok.columns


def test_empty_merge_guard(spark):
    a = spark.createDataFrame([("2023", "X", 1)], "season string, Name string, GP int")
    b = spark.createDataFrame([("2023", "A", 1)], "season string, Name string, GP int")
    with pytest.raises(ValueError, match="empty"):
        joins.require_nonempty(joins.merge_team_stats(a, b), "Merge resulted in empty DataFrame")


def test_prediction_and_metadata_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", "B", "A")], "week int, team1 string, team2 string, consensus_winner string")
    sinks.write_predictions(df, str(tmp_path / "pred"), fmt="csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "pred"))
    assert back.first()["consensus_winner"] == "A"
    meta = {"seasons": ["2021", "2022", "2023"], "num_features": 36, "cv_scores": {"rf": 0.85},
            "best_params": {"rf": {"numTrees": 20}}, "split_counts": {"train": 20}}
    sinks.write_metadata(spark, meta, str(tmp_path / "meta"))
    got = sinks.read_metadata(spark, str(tmp_path / "meta"))
    assert got["seasons"] == ["2021", "2022", "2023"] and got["best_params"]["rf"]["numTrees"] == "20"
    with pytest.raises(FileNotFoundError):
        sinks.read_metadata(spark, str(tmp_path / "nothing"))


def test_load_all_seasons_end_to_end(spark, season_dir):
    from matchspark.plans import pipeline
    rows, rejects = pipeline.load_all_seasons(spark, season_dir, ["2022", "2023"], with_rejects=True)
    assert rows.count() == 6                      # 3 matched games per season
    assert rejects.count() == 2                   # A-Z in each season
    assert {"team1_off_PTS", "team2_def_DEF", "team1_GP"} <= set(rows.columns)
    with pytest.raises(FileNotFoundError, match="not found"):
        pipeline.load_all_seasons(spark, season_dir, ["2022", "2019"])


def test_loader_duplicates_headers_and_urls(spark, tmp_path):
    """First offense and first defense row of a duplicated name, differing schedule
    headers, a URL path, and the same ids on every run."""
    from matchspark.plans import pipeline
    d = str(tmp_path)
    for s, head in (("2021", "Week,Team1,Team2"), ("2022", "Week,Team2,Team1,Stadium")):
        _write(d, f"{s} Fantasy Offense Stats.csv", "Name,GP,PTS,All,Run,Pass,QB\nA,17,10,2,3,4,5\nA,17,99,2,3,4,5\nB,17,24,75,28,47,16\n")
        _write(d, f"{s} Fantasy Defense Stats.csv", "Name,GP,PA,DEF,QB\nA,17,20,6.5,15\nA,17,77,6.5,15\nB,17,22,7,17\n")
        games = "1,A,B\n2,B,A\n" if s == "2021" else "1,B,A,1\n2,A,B,2\n"
        _write(d, f"{s} Schedule.csv", head + "\n" + games)
    runs = []
    for path in (d, "file://" + d):
        rows = pipeline.load_all_seasons(spark, path, ["2021", "2022"], threshold=None).collect()
        assert len(rows) == 4 and len({r["game_id"] for r in rows}) == 4
        assert {(r["team1_off_PTS"], r["team1_def_PA"]) for r in rows if r["team1"] == "A"} == {(10.0, 20.0)}
        runs.append(sorted((r["season"], r["week"], r["team1"], r["game_id"]) for r in rows))
    assert runs[0] == runs[1]
    assert seasons.list_seasons(spark, "file://" + d) == ["2021", "2022"]
    with pytest.raises(FileNotFoundError, match="not found"):
        pipeline.load_all_seasons(spark, "file://" + d, ["2020"])


def test_loader_reports_bad_numbers(spark, season_dir):
    from matchspark.plans import pipeline
    _write(season_dir, "2023 Fantasy Offense Stats.csv", "Name,GP,PTS,All,Run,Pass,QB\nA,17,lots,82.3,30.1,50.2,18.0\nB,17,24.0,75.0,28.0,47.0,16.5\n")
    with pytest.raises(ValueError, match="PTS='lots'"):
        pipeline.load_all_seasons(spark, season_dir, ["2023"])


def test_rows_with_too_many_fields_are_reported_not_cut(spark, season_dir):
    from matchspark.plans import pipeline
    _write(season_dir, "2023 Fantasy Offense Stats.csv", 'Name,GP,PTS,All,Run,Pass,QB\nA,17,1,2,3,4,5,6\n"B, jr",17,1,2,3,4,5\n'
                                                         'C,17,1,2\nD,17,1,2,3,4,5,\n"E, sr",17,1,2,3,4,"5,5",9\n')
    off = seasons.read_kind(spark, season_dir, "offense", ["2022", "2023"])
    got = sorted((r.season, r.line) for r in seasons.rejected_rows(off).collect())
    assert got == [("2023", '"E, sr",17,1,2,3,4,"5,5",9'), ("2023", "A,17,1,2,3,4,5,6"), ("2023", "D,17,1,2,3,4,5,")]
    whole = {r.Name: r for r in off.where("season = '2023' and Name is not null").collect()}
    assert set(whole) == {"B, jr", "C"} and whole["C"].Run is None and whole["B, jr"].QB == 5.0
    assert off.where("season = '2022'").count() == 3
    with pytest.raises(ValueError, match="more fields than the header.*A,17,1,2,3,4,5,6"):
        pipeline.load_all_seasons(spark, season_dir, ["2022", "2023"])


def test_loader_scans_each_kind_once(spark, season_dir, tmp_path):
    """All audits of a kind come with the one job that writes its table."""
    from matchspark.plans import pipeline
    table, audit = pipeline.load_kind(spark, season_dir, "offense", ["2022", "2023"], str(tmp_path / "kinds"))
    assert audit.rows == 6 and audit.by_value["season"] == {"2022": 3, "2023": 3} and audit.flagged == {"bad": 0, "rejected": 0}
    assert audit.missing["QB"] == 0 and "csv" not in table._jdf.queryExecution().executedPlan().toString().lower()
    assert {f for f in os.listdir(tmp_path / "kinds" / "offense") if f.startswith("season=")} == {"season=2022", "season=2023"}
    with pytest.raises(ValueError, match="empty"):
        _write(season_dir, "2024 Schedule.csv", "Week,Team1,Team2\n")
        pipeline.load_kind(spark, season_dir, "schedule", ["2024"], str(tmp_path / "none"))


def test_season_is_scored_into_one_file(spark, season_dir):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from matchspark.functions.constants import FEATURE_NAMES
    from matchspark.operators import scaling
    from matchspark.plans import pipeline
    n = len(FEATURE_NAMES)
    two = spark.createDataFrame([(Vectors.dense([0.0] * n), 0.0), (Vectors.dense([1.0] * n), 1.0)], ["features", "label"])
    fitted = {"logistic_regression": LogisticRegression(maxIter=1).fit(two)}
    zero = spark.createDataFrame([tuple([0.0, 1.0] * n)], ", ".join(f"{c}__mean double, {c}__std double" for c in FEATURE_NAMES))
    scaler = scaling.Scaler(FEATURE_NAMES)
    scaler.stats = zero
    found, rejects = pipeline.score_season_files(spark, season_dir, "2023", fitted, scaler, write=True)
    path = os.path.join(season_dir, "2023 Schedule_predictions.csv")
    assert spark.read.option("header", True).csv(path).count() == found.count() == 3 and rejects.count() == 1
    assert sorted(f for f in os.listdir(season_dir) if "predictions" in f and not f.startswith(".")) == ["2023 Schedule_predictions.csv"]


def test_joins_by_order_have_tasks_that_follow_the_lines(spark, monkeypatch):
    want = sorted(standins.defense(spark, SF_SMALL).collect())
    monkeypatch.setattr(standins, "ORDER_BYTES", 4000)
    parts = standins.order_parts(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"))
    many = standins.defense(spark, SF_SMALL)
    assert parts > 4 and f", {parts}), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(many.collect()) == want


def test_joins_by_order_have_no_fewer_tasks_than_a_plain_join(spark, monkeypatch):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert standins.order_parts(lines) == 1
    monkeypatch.setattr(standins, "ORDER_BYTES", standins.size_estimate(lines) - 1)   # two tasks by size alone
    assert standins.order_parts(lines) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 2
