"""Fixed values of the domain: names, codes and constants that results depend on."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

SUM_COLUMNS = [
    "appearances", "minutes", "goals", "assists", "yellow_cards", "red_cards",
    "shots_total", "shots_on", "passes_total", "passes_key",
    "tackles", "interceptions", "blocks", "duels_total", "duels_won",
    "dribbles_attempts", "dribbles_success", "fouls_drawn", "fouls_committed",
    "penalty_goals",
]

PER90_COLUMNS = [
    "goals", "np_goals", "assists", "shots_total", "shots_on", "passes_total", "passes_key",
    "tackles", "interceptions", "dribbles_attempts", "dribbles_success",
    "fouls_drawn", "fouls_committed",
]

META_COLUMNS = [
    "firstname", "lastname", "dob", "nationality", "position",
    "tm_player_id", "market_value_in_eur",
]

POSITION_GROUPS = {"defender": "DEF", "midfielder": "MID", "attacker": "FWD", "forward": "FWD"}
POSITION_LABELS = ["DEF", "FWD", "MID"]
EXCLUDED_POSITION = "goalkeeper"

PEAK_AGE = {"DEF": 28.0, "MID": 27.0, "FWD": 25.0}
DEFAULT_PEAK_AGE = 26.0
RESALE_AGE = 30.0
YOUNG_AGE = 23

# name -> (statistics league id, market competition id)
LEAGUES = {
    "PL": (39, "GB1"),
    "LaLiga": (140, "ES1"),
    "Bundesliga": (78, "L1"),
    "SerieA": (135, "IT1"),
    "Ligue1": (61, "FR1"),
}
DEFAULT_LEAGUE = 39
DEFAULT_COMPETITIONS = ["GB1"]
DEFAULT_SEASONS = [2022, 2023, 2024]
DEFAULT_LEAGUE_TEAMS = [
    33, 34, 35, 36, 39, 40, 41, 42, 45, 46, 47, 48, 49, 50, 51, 52, 55, 57, 62, 65, 66, 1359,
]

ID_COLUMNS = ["api_player_id", "season", "tm_player_id", "market_value_in_eur", "log_market_value"]

SEED = 42
FUZZY_THRESHOLD = 80.0
VERDICT_THRESHOLD = 0.20
WINNER_MODEL = "MODEL"
WINNER_MARKET = "Transfermarkt"
MIN_GROUP_ROWS = 30
MIN_EXPLAIN_TRAIN = 10
MIN_EXPLAIN_TEST = 5

RIDGE_ALPHA = 10.0
META_ALPHA = 1.0
FOREST_PARAMS = {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 3, "featureSubsetStrategy": "all"}
BOOST_PARAMS = {"maxIter": 300, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8"}
SECOND_ORDER_PARAMS = {"rounds": 300, "depth": 4, "rate": 0.05, "rows": 0.8, "columns": 0.8, "penalty": 1.0, "least": 1.0}
# Search spaces; depth 30 is the deepest tree Spark ML grows and stands for "no limit".
SEARCH_SPACES = {
    "RandomForest": {
        "maxDepth": [6, 8, 10, 30],
        "minInstancesPerNode": [2, 3, 5],
        "featureSubsetStrategy": ["0.5", "0.7", "sqrt"],
    },
    "GBT": {
        "maxDepth": [3, 4, 5, 6],
        "stepSize": [0.03, 0.05, 0.1],
        "subsamplingRate": [0.7, 0.8, 0.9],
        "featureSubsetStrategy": ["0.7", "0.8"],
    },
}
SEARCH_DRAWS = 10
SEARCH_FOLDS = 3
CV_FOLDS = 5
