"""Fixed values that must equal the original tool's for equal results.

FIXED VALUES — stated as given, in natural order, not derived:
formula coefficients, the weather odds per home stadium, the conference
membership lists, the weather multipliers and the 36 feature names.
"""

from __future__ import annotations

# --- FIXED VALUES: ratings formulas -------------------------------------
PLAYS_PER_GAME_ESTIMATE = 65          # offensive efficiency = All / (GP * 65)
TURNOVER_BASELINE = 20                # turnovers = max(0, (20 - QB) / GP)
X_OFF_SLOPE, X_OFF_INTERCEPT = 0.19, 12.0      # x_off = 0.19 * All + 12
X_DEF_SLOPE, X_DEF_INTERCEPT = -1.24, 30.8     # x_def = -1.24 * DEF + 30.8
X_WINS_SLOPE, X_WINS_INTERCEPT = 0.418, 8.5    # x_wins = 0.418 * net + 8.5
SEASON_GAMES = 17                              # x_losses = 17 - x_wins
NET_PRODUCTION_DEF_WEIGHT = 7.06               # net production = round(All + DEF * 7.06)
HOME_MULTIPLIER = 1.05                         # home side's game score * 1.05
STREAK_STEP = 0.02                             # score * (1 + 0.02 * streak)
ACCURACY_TARGET = 0.71                         # model comparison flag

# --- FIXED VALUES: weather multipliers (efficiency, net production) ------
WEATHER_EFFECTS = {
    "Clear": (1.0, 1.0),
    "Rain": (0.9, 1.1),
    "Snow": (0.8, 1.2),
    "Wind": (0.85, 1.15),
}
WEATHER_CONDITIONS = ["Clear", "Rain", "Snow", "Wind"]

# --- FIXED VALUES: weather odds per home team (Clear, Rain, Snow, Wind) ---
STADIUM_WEATHER = {
    "Arizona Cardinals": (1.0, 0.0, 0.0, 0.0),
    "Atlanta Falcons": (1.0, 0.0, 0.0, 0.0),
    "Baltimore Ravens": (0.7, 0.2, 0.05, 0.05),
    "Buffalo Bills": (0.5, 0.2, 0.2, 0.1),
    "Carolina Panthers": (0.75, 0.2, 0.05, 0.0),
    "Chicago Bears": (0.6, 0.2, 0.15, 0.05),
    "Cincinnati Bengals": (0.65, 0.25, 0.05, 0.05),
    "Cleveland Browns": (0.55, 0.25, 0.15, 0.05),
    "Dallas Cowboys": (1.0, 0.0, 0.0, 0.0),
    "Denver Broncos": (0.8, 0.1, 0.05, 0.05),
    "Detroit Lions": (1.0, 0.0, 0.0, 0.0),
    "Green Bay Packers": (0.5, 0.1, 0.35, 0.05),
    "Houston Texans": (1.0, 0.0, 0.0, 0.0),
    "Indianapolis Colts": (1.0, 0.0, 0.0, 0.0),
    "Jacksonville Jaguars": (0.8, 0.2, 0.0, 0.0),
    "Kansas City Chiefs": (0.7, 0.2, 0.05, 0.05),
    "Las Vegas Raiders": (1.0, 0.0, 0.0, 0.0),
    "Los Angeles Chargers": (1.0, 0.0, 0.0, 0.0),
    "Los Angeles Rams": (1.0, 0.0, 0.0, 0.0),
    "Miami Dolphins": (0.75, 0.25, 0.0, 0.0),
    "Minnesota Vikings": (1.0, 0.0, 0.0, 0.0),
    "New England Patriots": (0.65, 0.2, 0.1, 0.05),
    "New Orleans Saints": (1.0, 0.0, 0.0, 0.0),
    "New York Giants": (0.65, 0.2, 0.1, 0.05),
    "New York Jets": (0.65, 0.2, 0.1, 0.05),
    "Philadelphia Eagles": (0.7, 0.2, 0.05, 0.05),
    "Pittsburgh Steelers": (0.6, 0.2, 0.15, 0.05),
    "San Francisco 49ers": (0.85, 0.15, 0.0, 0.0),
    "Seattle Seahawks": (0.6, 0.3, 0.05, 0.05),
    "Tampa Bay Buccaneers": (0.8, 0.2, 0.0, 0.0),
    "Tennessee Titans": (0.75, 0.2, 0.05, 0.0),
    "Washington Commanders": (0.7, 0.2, 0.05, 0.05),
}

# --- FIXED VALUES: conference membership --------------------------------
AFC_TEAMS = [
    "Baltimore Ravens", "Buffalo Bills", "Cincinnati Bengals", "Cleveland Browns",
    "Denver Broncos", "Houston Texans", "Indianapolis Colts", "Jacksonville Jaguars",
    "Kansas City Chiefs", "Las Vegas Raiders", "Los Angeles Chargers", "Miami Dolphins",
    "New England Patriots", "New York Jets", "Pittsburgh Steelers", "Tennessee Titans",
]
NFC_TEAMS = [
    "Arizona Cardinals", "Atlanta Falcons", "Carolina Panthers", "Chicago Bears",
    "Dallas Cowboys", "Detroit Lions", "Green Bay Packers", "Los Angeles Rams",
    "Minnesota Vikings", "New Orleans Saints", "New York Giants", "Philadelphia Eagles",
    "San Francisco 49ers", "Seattle Seahawks", "Tampa Bay Buccaneers", "Washington Commanders",
]

# --- FIXED VALUES: the 36 model features, in order -----------------------
TEAM_FEATURE_STEMS = [
    "points_per_game",
    "yards_per_game",
    "pass_yards_per_game",
    "rush_yards_per_game",
    "offensive_efficiency",
    "points_allowed_per_game",
    "defensive_efficiency",
    "turnovers_gained",
    "turnovers_lost",
    "turnover_ratio",
    "points_per_game_rolling_3games",
    "yards_per_game_rolling_3games",
    "offensive_efficiency_rolling_3games",
    "defensive_efficiency_rolling_3games",
]
MATCHUP_FEATURES = [
    "head_to_head_win_pct",
    "head_to_head_avg_point_diff",
    "home_field_advantage",
    "rest_days_difference",
    "weather_clear",
    "weather_rain",
    "weather_snow",
    "weather_wind",
]
ROLES = ("team1", "team2")
FEATURE_NAMES = (
    [f"team1_{s}" for s in TEAM_FEATURE_STEMS]
    + [f"team2_{s}" for s in TEAM_FEATURE_STEMS]
    + MATCHUP_FEATURES
)
ROLLING_STEMS = ["points_per_game", "yards_per_game", "offensive_efficiency", "defensive_efficiency"]

# --- FIXED VALUES: required columns per file kind -------------------------
REQUIRED_COLUMNS = {
    "offense": ["Name", "GP", "PTS"],
    "defense": ["Name", "GP", "PA"],
    "schedule": ["Week", "Team1", "Team2"],
    "general": ["Name"],
}

# --- FIXED VALUES: documented plausible ranges (data preparation guide) ---
# column -> (low, high); checked by the range audit, never enforced.
DOCUMENTED_RANGES = {
    "GP": (1, 17),
    "off_PTS": (150, 600),
    "off_All": (3000, 7000),
    "off_Pass": (2000, 5000),
    "off_Run": (1000, 3000),
    "off_QB": (150, 400),
    "def_PA": (200, 500),
    "def_DEF": (150, 400),
    "def_QB": (150, 350),
}
MIN_PRESENT_SHARE = 0.80       # completeness: at least 80 % present values
MIN_GAMES_PER_SEASON = 100     # completeness: at least 100 games per season
MIN_SEASONS = 3                # training needs at least 3 seasons
MISSING_THRESHOLD = 0.20       # drop columns with more than 20 % nulls
