import datetime as dt

import pytest

from builders import joined
from valora import config
from valora.plans.features import aggregate_multi_club


def rolled(spark, *rows, **options):
    return aggregate_multi_club(joined(spark, *rows), ["ord"], **options).collect()


def test_single_row(spark):
    (row,) = rolled(spark, {})
    assert (row.goals, row.minutes, row.appearances) == (7, 1260, 16)


def test_two_clubs_are_summed(spark):
    (row,) = rolled(spark, {}, dict(goals=3, assists=1, minutes=450))
    assert (row.goals, row.assists, row.minutes) == (10, 5, 1710)


def test_accuracy_is_weighted(spark):
    (row,) = rolled(spark, {}, dict(passes_total=100, passes_accuracy=70.0))
    assert row.passes_accuracy == pytest.approx((420 * 84 + 100 * 70) / 520)


def test_accuracy_null_without_passes_and_zero_without_values(spark):
    (row,) = rolled(spark, dict(passes_total=0))
    assert row.passes_accuracy is None
    (row,) = rolled(spark, dict(passes_accuracy=None), dict(passes_accuracy=None))
    assert row.passes_accuracy == 0.0
    (row,) = rolled(spark, dict(passes_accuracy=None), null_if_all_null=True)
    assert row.passes_accuracy is None


def test_rating_is_null_safe(spark):
    (row,) = rolled(spark, {}, dict(rating=None, minutes=300))
    assert row.rating == pytest.approx(6.8 * 1260 / 1560)  # minutes without a rating still count
    (row,) = rolled(spark, dict(rating=None))
    assert row.rating is None
    (row,) = rolled(spark, dict(minutes=None))
    assert row.rating is None


def test_grain(spark):
    rows = rolled(spark, {}, dict(season=2023), dict(api_player_id=2), dict(api_player_id=None))
    assert sorted((r.api_player_id, r.season) for r in rows) == [(1, 2022), (1, 2023), (2, 2022)]


def test_all_columns(spark):
    (row,) = rolled(spark, {})
    assert set(config.SUM_COLUMNS) <= set(row.asDict()) and len(config.SUM_COLUMNS) == 20


def test_meta_takes_first_known_value_per_column(spark):
    (row,) = rolled(spark, dict(firstname=None, lastname="", dob=None, tm_player_id=999),
                    dict(firstname="Alice", lastname="Smith", dob=dt.date(1990, 1, 1), tm_player_id=1))
    assert (row.firstname, row.lastname, row.dob, row.tm_player_id) == ("Alice", "", dt.date(1990, 1, 1), 999)


def test_all_null_sum_is_null(spark):
    (row,) = rolled(spark, dict(goals=None), dict(goals=None, yellow_cards=2))
    assert row.goals is None and row.yellow_cards == 4


def test_three_clubs(spark):
    (row,) = rolled(spark, dict(goals=2), dict(goals=3), dict(goals=1))
    assert row.goals == 6


def test_primary_club_by_minutes_nulls_last(spark):
    (row,) = rolled(spark, dict(minutes=None, team_id=1), dict(minutes=10, team_id=2, league_id=140), dict(minutes=10, team_id=3))
    assert (row.team_id, row.league_id) == (2, 140)


@pytest.mark.parametrize("partitions", [1, 17])
def test_independent_of_partitioning(spark, partitions):
    df = joined(spark, *[dict(api_player_id=i % 5, goals=i, firstname=None if i % 3 else f"n{i}") for i in range(40)])
    got = aggregate_multi_club(df.repartition(partitions), ["ord"]).collect()
    assert sorted((r.api_player_id, r.goals, r.firstname) for r in got) == sorted(
        (p, sum(i for i in range(40) if i % 5 == p), f"n{next(i for i in range(40) if i % 5 == p and i % 3 == 0)}")
        for p in range(5))
