"""Fixed values of the football data: positions, column names and lookups."""

# Skill positions and the size of the elite tier of each.
POSITIONS = ("QB", "RB", "WR", "TE")
TOP_K = {"QB": 8, "RB": 12, "WR": 12, "TE": 8}

# Season ranges.
STATS_SEASONS = range(2015, 2026)
LAST_WEEKLY_SEASON = 2024
MARKET_SEASONS = range(2016, 2026)
RAW_PLAY_SEASONS = range(2010, 2026)
PLAY_FEATURE_SEASONS = range(2016, 2025)
FIRST_OUTPUT_SEASON = 2016
PAGE_MARKET_SEASON = 2026
TRAIN_SEASONS = tuple(range(2016, 2024))
TEST_SEASONS = (2024, 2025)

# Labels of the two market sources, the page variable and the price key (format, source, size).
FEED_SOURCE = "ffc"
PAGE_SOURCE = "draftsharks"
PAGE_VARIABLE = "vueAppData"
PAGE_KEY = (11, 107, 12)
GENERATED_PREFIX = "ds-"

# Market name to roster name, per source.
FEED_NAME_FIXES = {
    "Chris Herndon": "Christopher Herndon",
    "Joshua Palmer": "Josh Palmer",
    "Javorius Allen": "Buck Allen",
    "Robert Kelley": "Rob Kelley",
}
PAGE_NAME_FIXES = {
    "Cameron Skattebo": "Cam Skattebo",
    "Chigoziem Okonkwo": "Chig Okonkwo",
    "Nathaniel Dell": "Tank Dell",
    "Cameron Ward": "Cam Ward",
}
# Positions corrected by player id.
POSITION_OVERRIDES = {"00-0035624": "WR", "00-0033357": "TE"}

# Standings of players without a market price.
UNPRICED = {"adp_overall": 300.0, "adp_position_rank": 75.0}

# Weekly columns summed to a season.
WEEKLY_SUMS = (
    "fantasy_points_ppr", "completions", "attempts", "passing_yards", "passing_tds", "interceptions",
    "carries", "rushing_yards", "rushing_tds", "receptions", "targets", "receiving_yards", "receiving_tds",
)
# Names used by the season files of the newer format.
SEASON_FILE_RENAMES = {
    "recent_team": "team",
    "player_display_name": "full_name",
    "games": "games_played",
    "attempts": "pass_attempts",
    "passing_interceptions": "interceptions",
}
STAT_COLUMNS = (
    "games_played", "fantasy_points_ppr", "completions", "pass_attempts", "passing_yards", "passing_tds",
    "interceptions", "carries", "rushing_yards", "rushing_tds", "receptions", "targets", "receiving_yards",
    "receiving_tds",
)
SEASON_STATS_COLUMNS = ("player_id", "season", "full_name", "position", "team", *STAT_COLUMNS)

# Season-level advanced columns.
SEASONAL_RENAMES = {"receiving_air_yards": "air_yards", "receiving_yards_after_catch": "yards_after_catch"}
SEASONAL_COLUMNS = (
    "player_id", "season", "target_share", "air_yards_share", "wopr", "racr", "ppr_sh", "targets", "air_yards",
    "yards_after_catch", "adot",
)

# Tracking columns per frame with the volume column that weighs them.
TRACKING = {
    "passing": (
        "attempts",
        ("avg_time_to_throw", "avg_intended_air_yards", "aggressiveness", "completion_percentage_above_expectation"),
    ),
    "rushing": ("rush_attempts", ("efficiency", "percent_attempts_gte_eight_defenders")),
    "receiving": ("targets", ("avg_separation", "avg_cushion", "avg_intended_air_yards")),
}

# Stat and feature columns of each position's table.
_RECEIVING = ("receptions", "targets", "receiving_yards", "receiving_tds")
_RUSHING = ("carries", "rushing_yards", "rushing_tds")
_PASSING = ("completions", "pass_attempts", "passing_yards", "passing_tds", "interceptions")
_VOLUME = ("games_played", "fantasy_points_ppr")
POSITION_STATS = {
    "QB": (*_VOLUME, *_PASSING, *_RUSHING),
    "RB": (*_VOLUME, *_RUSHING, *_RECEIVING),
    "WR": (*_VOLUME, *_RECEIVING),
    "TE": (*_VOLUME, *_RECEIVING),
}
_SEASONAL = ("target_share", "air_yards_share", "wopr", "racr", "adot", "air_yards", "yards_after_catch")
_SNAPS = ("snap_pct", "offense_snaps")
_CATCHER = (
    *_SEASONAL, "avg_separation", "avg_cushion", "avg_intended_air_yards_receiving", *_SNAPS, "rz_targets",
    "team_pass_rate",
)
POSITION_FEATURES = {
    "QB": (*TRACKING["passing"][1], *_SNAPS, "designed_rushes", "scrambles", "team_pass_rate"),
    "RB": (
        *_SEASONAL, *TRACKING["rushing"][1], "avg_separation", "avg_cushion", *_SNAPS, "rz_targets", "rz_carries",
        "goalline_carries", "carry_share", "team_pass_rate",
    ),
    "WR": _CATCHER,
    "TE": _CATCHER,
}
POSITION_BASE = (
    "full_name", "season", "career_season", "team", "adp_overall", "adp_position_rank", "finish", "ppg", "prev_ppg",
    "ppg_delta", "pts_delta",
)
MARKET_COLUMNS = ("adp_overall", "adp_position_rank")
PROFILE_COLUMNS = (
    "full_name", "season", "career_season", "team", "adp_overall", "adp_position_rank", "finish",
    "fantasy_points_ppr", "games_played", "ppg", "prev_fantasy_points_ppr", "prev_ppg", "pts_delta", "ppg_delta",
)
VALUE_COLUMNS = ("full_name", "season", "career_season", "adp_position_rank", "finish", "ppg")
