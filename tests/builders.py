"""Small inputs shared by the tests."""

import datetime as dt

from valora import config

JOINED_SCHEMA = (
    "api_player_id BIGINT, season INT, firstname STRING, lastname STRING, dob DATE, nationality STRING, position STRING, "
    "tm_player_id BIGINT, market_value_in_eur DOUBLE, " + ", ".join(f"{c} INT" for c in config.SUM_COLUMNS)
    + ", passes_accuracy DOUBLE, rating DOUBLE, team_id BIGINT, league_id INT, ord INT")

BASE_ROW = dict(
    api_player_id=1, season=2022, firstname="Ilse", lastname="Brandt", dob=dt.date(1998, 1, 1), nationality="Norway",
    position="Attacker", tm_player_id=611, market_value_in_eur=7.5e6, appearances=16, minutes=1260, goals=7, assists=4,
    yellow_cards=2, red_cards=1, shots_total=25, shots_on=9, passes_total=420, passes_key=21, tackles=11, interceptions=6,
    blocks=2, duels_total=64, duels_won=40, dribbles_attempts=18, dribbles_success=12, fouls_drawn=7, fouls_committed=9,
    penalty_goals=2, passes_accuracy=84.0, rating=6.8, team_id=33, league_id=39)


def joined(spark, *rows):
    """Rows as overrides of the base row, numbered in the given order."""
    full = [{**BASE_ROW, **row, "ord": i} for i, row in enumerate(rows)]
    names = [f.split()[0] for f in JOINED_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], JOINED_SCHEMA)


def league(spark, players=150, seasons=(2022, 2023, 2024), seed=3):
    """A season-by-season population whose value depends on age, goals and minutes."""
    import random
    r = random.Random(seed)
    rows = []
    for player in range(players):
        born = dt.date(1988 + r.randrange(17), 1 + r.randrange(12), 1 + r.randrange(28))
        position = r.choice(["Attacker", "Midfielder", "Defender"])
        skill = r.random()
        for season in seasons:
            minutes = int(300 + 2500 * r.random())
            goals = int(skill * minutes / 150)
            age = season + 1 - born.year
            value = 1e6 * (1 + 20 * skill + minutes / 500) * max(0.2, 1.5 - abs(age - 25) / 12)
            rows.append(dict(api_player_id=player, tm_player_id=1000 + player, season=season, dob=born, position=position,
                             minutes=minutes, goals=goals, assists=goals // 2, appearances=1 + minutes // 80,
                             team_id=player % 12, league_id=[39, 140, 78, 135, 61][player % 5],
                             firstname=f"F{player}", lastname=f"L{player}", market_value_in_eur=value))
    return joined(spark, *rows)


def record(api_id, first, last, dob, league=39, team=33, **games):
    """One raw record of the statistics source as the nested dict of its JSON."""
    return {
        "player": {"id": api_id, "firstname": first, "lastname": last, "birth": {"date": dob}, "nationality": "X"},
        "statistics": [{
            "team": {"id": team, "name": f"Team {team}"}, "league": {"id": league},
            "games": {"appearences": 12, "minutes": 1080, "position": "Attacker", "rating": "6.90", **games},
            "goals": {"total": 4, "assists": 2}, "cards": {"yellow": 2, "red": 1}, "shots": {"total": 31, "on": 14},
            "passes": {"total": 340, "key": 17, "accuracy": 76}, "tackles": {"total": 9, "interceptions": 4, "blocks": 3},
            "duels": {"total": 52, "won": 26}, "dribbles": {"attempts": 13, "success": 8},
            "fouls": {"drawn": 6, "committed": 11}, "penalty": {"scored": 1}}]}
