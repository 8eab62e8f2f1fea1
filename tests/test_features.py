import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from builders import joined, league
from valora.plans import features as f
from valora.plans.models import feature_columns


@pytest.fixture(scope="module")
def people(spark):
    df = league(spark, players=40)
    return df.cache()


@pytest.mark.parametrize("stage, count", [(1, 10), (2, 24), (3, 31), (4, 41), (5, 46)])
def test_feature_counts(people, stage, count):
    df = f.STAGES[f"stage{stage}"](people, order_cols=["ord"])
    assert len(feature_columns(df)) == count
    assert df.count() == 120


def test_value_history_adds_two(spark, people):
    valuations = spark.createDataFrame(
        [(1000, dt.date(2021, 7, 1), 1e6), (1000, dt.date(2022, 7, 1), 3e6), (1000, dt.date(2022, 7, 2), 9e6)],
        "player_id BIGINT, date DATE, market_value_in_eur DOUBLE")
    df = f.build_stage3(people, valuations, order_cols=["ord"])
    assert len(feature_columns(df)) == 33
    got = {r.season: (r.log_tm_prev_value, r.tm_value_trend) for r in df.filter("api_player_id = 0").collect()}
    assert got[2022] == pytest.approx((np.log1p(3e6), np.log1p(3e6) - np.log1p(1e6)))
    assert got[2023] == pytest.approx((np.log1p(9e6), np.log1p(9e6) - np.log1p(3e6)))
    other = df.filter("api_player_id = 1").first()
    assert other.log_tm_prev_value is None and other.tm_value_trend is None


def test_stage1_drops_unmapped_positions_and_missing_values(spark):
    df = f.build_stage1(joined(spark, {}, dict(api_player_id=2, position="Goalkeeper"), dict(api_player_id=3, position=None),
                               dict(api_player_id=4, minutes=None), dict(api_player_id=5, dob=None),
                               dict(api_player_id=6, market_value_in_eur=None), dict(api_player_id=7, position="FORWARD")), ["ord"])
    rows = {r.api_player_id: r for r in df.collect()}
    assert set(rows) == {1, 7}
    assert rows[1].age == 25.5 and (rows[7].pos_DEF, rows[7].pos_FWD, rows[7].pos_MID) == (0.0, 1.0, 0.0)
    assert rows[1].log_market_value == pytest.approx(np.log1p(7.5e6))


def test_stage2_rates(spark):
    rows = {r.api_player_id: r for r in f.build_stage2(joined(
        spark, {}, dict(api_player_id=2, minutes=0, shots_total=0, duels_total=None, dribbles_attempts=0),
        dict(api_player_id=3, goals=1, penalty_goals=3), dict(api_player_id=4, penalty_goals=None)), ["ord"]).collect()}
    assert rows[1].goals_p90 == pytest.approx(0.5) and rows[1].np_goals_p90 == pytest.approx(5 / 14)
    assert (rows[1].duels_won_pct, rows[1].shot_accuracy, rows[1].dribble_success_pct) == (0.625, 0.36, 12 / 18)
    assert rows[2].goals_p90 is None and rows[2].shot_accuracy is None and rows[2].duels_won_pct is None
    assert rows[3].np_goals_p90 == 0.0 and rows[4].np_goals_p90 == pytest.approx(0.5)
    assert "np_goals" not in f.build_stage2(joined(spark, {}), ["ord"]).columns


def test_stage3_ranks_and_deltas(people):
    df = f.build_stage3(people, order_cols=["ord"]).toPandas()
    for c in ("goals_p90", "assists_p90", "minutes"):
        assert np.allclose(df[f"{c}_pct"], df.groupby("pos_FWD")[c].rank(pct=True))
    assert df[df.season == 2022].delta_goals.isna().all() and df[df.season > 2022].delta_minutes.notna().all()
    assert np.allclose(df.age_sq, df.age**2)
    single = f.build_stage3(people, order_cols=["ord"], with_delta=False)
    assert "delta_goals" not in single.columns


def test_stage4_team_quality_and_league(people):
    df = f.build_stage4(people, order_cols=["ord"]).toPandas().set_index(["api_player_id", "season"])
    raw = people.toPandas()
    mean = raw.groupby(["team_id", "season"]).market_value_in_eur.mean()
    for r in raw.itertuples():
        row = df.loc[(r.api_player_id, r.season)]
        assert row.log_team_avg_value == pytest.approx(np.log1p(mean[(r.team_id, r.season)]))
        assert row[f"league_{r.league_id}"] == 1.0 and row.league_id == r.league_id
        assert sum(row[f"league_{i}"] for i in (39, 140, 78, 135, 61)) == 1.0
    alone = f.build_stage4(people, order_cols=["ord"], exclude_self=True, include_raw_league_id=False)
    assert "league_id" not in alone.columns
    sizes = raw.groupby(["team_id", "season"]).market_value_in_eur.agg(["sum", "count"])
    r = raw.iloc[7]
    s = sizes.loc[(r.team_id, r.season)]
    got = alone.filter((F.col("api_player_id") == int(r.api_player_id)) & (F.col("season") == int(r.season))).first()
    assert got.log_team_avg_value == pytest.approx(np.log1p((s["sum"] - r.market_value_in_eur) / (s["count"] - 1)))


def test_stage5_age_curve(spark):
    rows = {r.api_player_id: r for r in f.build_stage5(joined(
        spark, {}, dict(api_player_id=2, position="Defender", dob=dt.date(2002, 1, 1)),
        dict(api_player_id=3, position="Midfielder", dob=dt.date(1985, 1, 1), minutes=0)), ["ord"]).collect()}
    assert rows[1].age_vs_pos_peak == pytest.approx(0.5) and rows[1].years_to_30 == pytest.approx(4.5) and rows[1].is_young == 0.0
    assert rows[2].age_vs_pos_peak == pytest.approx(21.5 - 28) and rows[2].is_young == 1.0
    assert rows[3].years_to_30 == 0 and rows[3].age_x_goal_inv == 0.0 and rows[3].age_x_minutes == 0.0
    assert rows[1].age_x_goal_inv == pytest.approx(25.5 * 11 / 14)


@pytest.mark.parametrize("partitions", [1, 17])
def test_stage5_is_independent_of_partitioning(people, partitions):
    def frame(df):
        return f.build_stage5(df, order_cols=["ord"]).toPandas().sort_values(["api_player_id", "season"], ignore_index=True)
    pd.testing.assert_frame_equal(frame(people), frame(people.repartition(partitions)))
