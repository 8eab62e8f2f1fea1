import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from builders import league, record
from valora.plans import dataset, features, models, report
from valora.sources import pages, tables


def dump(folder, name, errors, total, response):
    body = {"errors": errors, "response": response}
    if total:
        body["paging"] = {"current": 1, "total": total}
    (folder / name).write_text(json.dumps(body, indent=2), encoding="utf-8")


@pytest.fixture
def cache(tmp_path):
    r = lambda i, **k: record(i, f"F{i}", f"L{i}", "1999-01-01", **k)
    for page in (1, 2, 3, 4):
        dump(tmp_path, f"players_page-{page}_season-2022_team-33.json", [], 4, [r(page)])
    dump(tmp_path, "players_page-1_season-2022_team-34.json", [], 1, [r(11), r(12, league=140)])
    dump(tmp_path, "players_page-2_season-2022_team-34.json", [], 1, [r(13)])  # beyond the announced total
    dump(tmp_path, "players_page-1_season-2022_team-35.json", {"rateLimit": "Too many"}, 1, [r(14)])
    dump(tmp_path, "players_page-1_season-2022_team-36.json", [], None, [r(15)])  # no paging: one page
    dump(tmp_path, "players_page-1_season-2022_team-529.json", [], 1, [r(16, league=140, team=529)])
    dump(tmp_path, "players_page-1_season-2021_team-33.json", [], 1, [r(17)])
    dump(tmp_path, "players_page-1_season-2022_team-9999.json", [], 1, [r(18)])  # owned by no league
    dump(tmp_path, "teams_league-140_season-2022.json", [], None, [{"team": {"id": 529}}, {"team": {"id": 530}}])
    return str(tmp_path)


def test_cached_pages(spark, cache):
    got = pages.load_statistics(spark, cache, [2022], [39, 140])
    rows = got.select("player.id", "season", "league_id", F.size("statistics").alias("n"), "rec_ord").orderBy("rec_ord").collect()
    assert [(r.id, r.league_id) for r in rows] == [(1, 39), (2, 39), (3, 39), (4, 39), (11, 39), (15, 39), (16, 140)]
    assert all(r.season == 2022 and r.n == 1 for r in rows)
    assert [r.id for r in pages.load_statistics(spark, cache, [2021, 2022]).select("player.id", "rec_ord").orderBy("rec_ord").collect()][:2] == [17, 1]


def test_page_cap_is_an_argument(spark, cache):
    got = pages.load_statistics(spark, cache, [2022], [39, 140], page_cap=3)
    assert [r.id for r in got.select("player.id", "rec_ord").orderBy("rec_ord").collect()] == [1, 2, 3, 11, 15, 16]


def test_pages_stay_when_the_first_one_failed(spark, cache, tmp_path):
    for page in (2, 3):
        dump(tmp_path, f"players_page-{page}_season-2022_team-35.json", [], 3, [record(30 + page, "F", "L", "1999-01-01")])
    got = pages.load_statistics(spark, cache, [2022], [39, 140])
    assert {32, 33} <= {r.id for r in got.select("player.id").collect()}


def test_error_pages_are_set_aside(spark, cache):
    usable, failed = pages.split_errors(pages.scan_pages(spark, f"{cache}/players_*.json"))
    assert [(r.team, r.page, r.season) for r in failed.collect()] == [(35, 1, 2022)]
    assert usable.count() == 10


def test_request_names():
    assert pages.request_slug("players", team=33, season=2022, page=1) == "players_page-1_season-2022_team-33.json"
    assert pages.request_slug("status") == "status.json"


def test_pages_written_and_read_back(spark, tmp_path, cache):
    scanned = pages.scan_pages(spark, f"{cache}/players_*.json")
    out = str(tmp_path / "export")
    pages.write_pages(scanned.select("request", "errors", "paging", "response"), out)
    back = pages.scan_pages(spark, f"{out}/{pages.EXPORTED.format(endpoint='players')}", multiline=False)
    key = lambda df: sorted((r.team, r.season, r.page, len(r.response)) for r in df.collect())
    assert key(back) == key(scanned)


def test_flatten(spark, cache):
    records = pages.load_statistics(spark, cache, [2022], [39])
    row = dataset.flatten_players(records).filter("api_player_id = 1").first()
    assert (row.appearances, row.minutes, row.rating, row.goals, row.passes_accuracy) == (12, 1080, 6.9, 4, 76.0)
    assert (row.full_name_norm, row.last_name_norm, row.dob, row.team_name) == ("f l", "l", dt.date(1999, 1, 1), "Team 33")
    nothing = records.withColumn("statistics", F.filter("statistics", lambda s: F.lit(False)))
    assert dataset.flatten_players(nothing).count() == 0
    twice = records.unionByName(records)
    assert dataset.flatten_players(twice, dedup=True).count() == records.count()


MARKET_FILES = {
    "clubs": "club_id,name,domestic_competition_id\n1,A,GB1\n2,B,ES1\n3,C,XX\n",
    "player_valuations": "player_id,date,market_value_in_eur,extra,player_club_domestic_competition_id\n"
                         "1,2023-06-01,5000000,x,GB1\n1,2023-08-20,7000000,x,GB1\n2,2023-06-01,1000000,x,ES1\n3,bad,1,x,XX\n",
    "players": "player_id,first_name,last_name,name,date_of_birth\n1,F1,Dé,Abc Dé,1999-01-01 00:00:00\n2,F2,L2,\"Two, L2\",\n3,F3,L3,F L,1990-01-01\n",
    "transfers": "player_id,player_name,transfer_date,transfer_season,from_club_id,to_club_id,from_club_name,to_club_name,"
                 "transfer_fee,market_value_in_eur\n1,P1,2024-07-01,24/25,1,2,A,B,1000.5,900\n2,P2,2024-07-01,24/25,3,9,C,D,?,\n"
                 "3,P3,,23/24,9,1,D,A,,100\n4,P4,,23/24,1,1,A,A,5,\n",
}


@pytest.fixture
def market_dir(tmp_path):
    folder = tmp_path / "market"
    folder.mkdir()
    for name, text in MARKET_FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_market_tables(spark, market_dir):
    m = tables.load_market(spark, market_dir)
    assert [r.club_id for r in m.clubs.collect()] == [1]
    assert m.valuations.count() == 2 and [r.player_id for r in m.players.collect()] == [1]
    assert sorted(r.player_id for r in m.transfers.collect()) == [1, 3, 4]
    two = tables.load_market(spark, market_dir, ["GB1", "ES1"])
    assert {r.player_id: (r.name, r.date_of_birth) for r in two.players.collect()} == {
        1: ("Abc Dé", dt.date(1999, 1, 1)), 2: ("Two, L2", None)}


def test_table_round_trip(spark, tmp_path):
    df = tables.from_records(spark, [(2022, 1), (2023, 2)], "season INT, x INT")
    path = str(tmp_path / "t")
    tables.write_table(df, path)
    back = tables.read_table(spark, path, "x INT, season INT").filter("season = 2023")
    assert [r.x for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(season" in back._jdf.queryExecution().toString()
    assert tables.from_records(spark, [], "a INT").count() == 0


def test_joined_dataset(spark, tmp_path, market_dir):
    folder = tmp_path / "api"
    folder.mkdir()
    r = [record(1, "Abc", "De", "1999-01-01"), record(2, "Abc", "De", "1999-01-01", position="goalkeeper"),
         record(3, "No", "Body", "1980-01-01"), record(4, "Abc", "De", "1999-01-01", position=None)]
    dump(folder, "players_page-1_season-2022_team-33.json", [], 1, r)
    rows = dataset.flatten_players(pages.load_statistics(spark, str(folder), [2022]))
    out = dataset.build_joined_dataset(rows, tables.load_market(spark, market_dir)).collect()
    # 2023-06-01 is 30 days before July 1, 2023-08-20 is 50 days after it
    assert sorted((x.api_player_id, x.tm_player_id, x.market_value_in_eur) for x in out) == [(1, 1, 5e6), (4, 1, 5e6)]
    late = dataset.build_joined_dataset(rows, tables.load_market(spark, market_dir), direction="forward")
    assert {x.market_value_in_eur for x in late.collect()} == {7e6}


TRANSFERS = tables.TRANSFERS


def transfers(spark, *rows):
    return spark.createDataFrame([(p, f"N{p}", None, s, 1, 2, "A", "B", fee, value) for p, s, fee, value in rows], TRANSFERS)


def test_benchmark(spark):
    t = transfers(spark, (1, "24/25", "10000000", "8000000"), (2, "24/25", "20000000", None), (1, "25/26", "0", "1"),
                  (9, "25/26", "5000000", "1"), (3, "24/25", "?", "1"), (1, "23/24", "1", "1"), (1, "bad", "7", "1"))
    p = spark.createDataFrame([(1, 9e6), (2, 25e6), (2, 21e6), (None, 1.0)], "tm_player_id BIGINT, predicted_eur DOUBLE")
    out = report.transfer_benchmark(t, p)
    assert [(r.player_name, r.actual_fee_M, r.error_model_M, r.error_tm_M) for r in out.collect()][0][:2] == ("N2", 20.0)
    assert sorted((r.player_name, r.error_model_M, r.error_tm_M) for r in out.collect()) == [
        ("N1", 1.0, 2.0), ("N2", 1.0, 20.0), ("N2", 5.0, 20.0)]
    summary = report.benchmark_winner(out).first()
    assert (summary.matched, summary.winner) == (3, report.MODEL) and summary.mae_tm == 14.0
    assert report.transfer_benchmark(t, p, 2023).count() == 1
    assert report.transfer_benchmark(t, p.filter("tm_player_id = 77")).count() == 0
    assert report.benchmark_winner(out.limit(0)).first().winner == report.MARKET


def test_ranking_and_lookup_over_a_scored_season(spark):
    rows = league(spark, players=60)
    stage1 = features.build_stage1(rows, ["ord"])
    names = models.feature_columns(stage1)
    model = models.fit_forest(stage1.filter("season < 2024"), names, {"RandomForest": {"numTrees": 5}})
    scored = report.with_names(models.score(model, stage1.filter("season = 2024"), names), rows, ["ord"]).cache()
    assert scored.count() == 60
    ranked = report.undervalued(scored, ["api_player_id"]).collect()
    gaps = [r.gap_m for r in ranked]
    assert gaps == sorted(gaps, reverse=True) and min(gaps) > 0
    (hit,) = report.lookup(scored, "f7 L7$").collect()
    assert (hit.name, hit.season_label) == ("F7 L7", "2024/25") and hit.verdict.startswith(hit.verdict_code)


def _response(page, season, value, errors="[]"):
    return (pages.request_slug("players", page=page, season=season, team=1), errors, [value])


def _stored(spark, path):
    rows = pages.scan_pages(spark, f"{path}/endpoint=players", "errors STRING, response ARRAY<STRING>", multiline=False)
    return sorted((r.season, r.page, r.response[0], r.errors) for r in rows.collect())


def test_refresh_keeps_the_newest_usable_response(spark, tmp_path):
    schema, path, failed = "request STRING, errors STRING, response ARRAY<STRING>", str(tmp_path / "cache"), '{"rateLimit":"x"}'
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    pages.refresh_pages(frame(), path)
    pages.refresh_pages(frame(_response(1, 2021, "a"), _response(1, 2022, "b", failed), _response(2, 2022, "c")), path)
    pages.write_pages(frame(_response(2, 2022, "c2")), path)
    before = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in (tmp_path / "cache" / "endpoint=players" / "season=2021").iterdir()}
    pages.refresh_pages(frame(_response(1, 2022, "d"), _response(2, 2022, "e", failed), _response(3, 2022, "f"), _response(3, 2022, "f")), path)
    assert _stored(spark, path) == [(2021, 1, "a", "[]"), (2022, 1, "d", "[]"), (2022, 2, "c2", "[]"), (2022, 3, "f", "[]")]
    assert before == {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in (tmp_path / "cache" / "endpoint=players" / "season=2021").iterdir()}
    pages.refresh_pages(frame(), path)
    assert len(_stored(spark, path)) == 4


def test_refresh_keeps_fields_without_a_schema(spark, tmp_path):
    folder = tmp_path / "endpoint=players" / "season=2022"
    folder.mkdir(parents=True)
    name = pages.request_slug("players", page=1, season=2022, team=1)
    (folder / "part.json").write_text(json.dumps({"request": name, "errors": [], "get": "players", "response": []}) + "\n" + '{"other": 1}\n' * 2)
    pages.refresh_pages(spark.createDataFrame([_response(2, 2022, "x")], "request STRING, errors STRING, response ARRAY<STRING>"), str(tmp_path))
    lines = [r.value for r in spark.read.text(str(tmp_path)).collect()]
    assert len(lines) == 3 and sum('"get": "players"' in line for line in lines) == 1 and lines.count('{"other": 1}') == 1
