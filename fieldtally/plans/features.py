"""Season features per player from seasonal, tracking, snap and play records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldtally.contracts import PLAY_FEATURES, shape
from fieldtally.functions.numeric import flag, safe_ratio, sum_or_zero, to_number
from fieldtally.operators.aggregates import conditional_counts, group_denominators, group_present, weighted_mean
from fieldtally.operators.joins import crosswalk, join_crosswalk, outer_join_first_wins, outer_join_suffix
from fieldtally.operators.ordering import dominant
from fieldtally.operators.project import conform, select_present, stack_frames
from fieldtally.plans import league
from fieldtally.session import settle

KEYS = ("player_id", "season")
REGULAR = "season_type = 'REG'"


def seasonal_features(legacy: DataFrame | None, newer: DataFrame | None = None) -> DataFrame:
    """Season-level shares plus average target depth. Only the newer files carry a season type to filter."""
    frames = []
    if legacy is not None:
        frames.append(conform(legacy, league.SEASONAL_RENAMES))
    if newer is not None:
        regular = newer.where(REGULAR)
        frames.append(conform(regular, {"passing_interceptions": "interceptions", **league.SEASONAL_RENAMES}))
    rows = stack_frames(frames)
    deep = rows.withColumn("adot", safe_ratio(F.col("air_yards"), F.col("targets")))
    return select_present(deep, league.SEASONAL_COLUMNS).dropna(subset=list(KEYS))


def tracking_features(
    frames: Mapping[str, DataFrame], spec: Mapping[str, tuple[str, Sequence[str]]] = league.TRACKING,
    entity: str = "player_gsis_id", week_filter=None,
) -> DataFrame:
    """Volume-weighted season means of each tracking frame, joined on the player-season.

    ``week_filter`` can leave out summary rows that are not weeks.
    """
    means = {}
    for label, frame in frames.items():
        weight, values = spec[label]
        weekly = frame.where(REGULAR)
        weekly = weekly if week_filter is None else weekly.where(week_filter)
        means[label] = weighted_mean(weekly.withColumnsRenamed({entity: "player_id"}), KEYS, values, weight)
    return outer_join_suffix(means, KEYS, unique_keys=True)


def snap_features(
    snaps: DataFrame, rosters: DataFrame, roster_order: Sequence[str], positions: Sequence[str] = league.POSITIONS,
    external: str = "pfr_player_id", roster_external: str = "pfr_id", observation: Observation | None = None,
) -> DataFrame:
    """Snap totals and mean snap share per player-season, ids translated through the roster.

    Weeks are combined per external id before the translation, so the join
    sees one row per external id and season.
    """
    listed = snaps.where((F.col("game_type") == "REG") & F.col("position").isin(*positions))
    combined = listed.groupBy(external, "season").agg(
        F.sum("offense_snaps").alias("snaps"), F.sum("offense_pct").alias("pct_sum"),
        F.count("offense_pct").alias("pct_n"), F.count(F.lit(1)).alias("rows"),
    )
    ids = crosswalk(rosters.where(F.col("position").isin(*positions)), roster_external, "player_id", roster_order)
    joined = join_crosswalk(
        combined, ids.withColumnsRenamed({roster_external: external}), external, "player_id", "rows", observation
    )
    return group_present(joined, KEYS).agg(
        sum_or_zero(F.col("snaps")).alias("offense_snaps"),
        safe_ratio(F.sum("pct_sum"), F.sum("pct_n")).alias("snap_pct"),
    )


def clean_plays(plays: DataFrame) -> DataFrame:
    """Regular-season plays with numeric 0/1 columns; text that is no number counts as 0."""
    flags = [c for c in ("rush_attempt", "qb_scramble", "pass_attempt", "sack") if c in plays.columns]
    return plays.where(REGULAR).withColumns({c: to_number(F.col(c)) for c in flags})


# What a play counts as. Team passes and receiver targets use different columns on purpose.
PASS = "pass_attempt = 1"
RUSH = "rush_attempt = 1"
TARGET = "(play_type = 'pass' and receiver_player_id is not null)"
CARRY = "(rush_attempt = 1 and rusher_player_id is not null)"
RED_ZONE = "yardline_100 <= 20"
GOAL_LINE = "yardline_100 <= 5"
RUSH_COUNTS = {
    "carries": "true",
    "rz_carries": RED_ZONE,
    "goalline_carries": GOAL_LINE,
    "designed_rushes": "qb_scramble = 0",
    "scrambles": "qb_scramble = 1",
}


def _flag(condition: str):
    return flag(F.expr(condition))


def team_rates(plays: DataFrame) -> DataFrame:
    """Pass plays, rush attempts and pass rate per team and season (cleaned plays)."""
    return group_denominators(plays, ["posteam", "season"], F.expr(PASS), F.expr(RUSH))


def receiver_counts(plays: DataFrame) -> DataFrame:
    """Red-zone targets per receiver and season (cleaned plays)."""
    targets = plays.where(TARGET).withColumnsRenamed({"receiver_player_id": "player_id"})
    return conditional_counts(targets, KEYS, {"rz_targets": F.expr(RED_ZONE)})


def rusher_counts(plays: DataFrame) -> DataFrame:
    """Carries by kind per rusher and season (cleaned plays)."""
    carries = plays.where(CARRY).withColumnsRenamed({"rusher_player_id": "player_id"})
    return conditional_counts(carries, KEYS, {name: F.expr(cond) for name, cond in RUSH_COUNTS.items()})


def rusher_team(plays: DataFrame) -> DataFrame:
    """The team each rusher carried most often for in a season (cleaned plays)."""
    carries = plays.where(CARRY).withColumnsRenamed({"rusher_player_id": "player_id"})
    return dominant(carries, KEYS, "posteam")


# Columns of the one-pass play table: output -> condition counted.
_LEVEL_COUNTS = {
    "n": "true", "red_zone": RED_ZONE, "goal_line": GOAL_LINE, "designed": "qb_scramble = 0",
    "scrambled": "qb_scramble = 1",
}


def play_levels(plays: DataFrame, detail: bool = False) -> DataFrame:
    """Plays counted per (season, kind, player, team), kind being passer, rusher or receiver.

    This is the only pass over the plays, the largest table: each play emits
    one entry per role it fills and the entries combine before the shuffle.
    The result is written once because several groupings read it; left lazy,
    the optimizer would push each grouping's filter down and scan the plays
    again for every one. Rows without a player or team stay, as they count for
    totals. ``detail`` adds depth, completions, yards after catch and
    completion over expectation, whose columns are otherwise not read.
    """
    p = clean_plays(plays)
    who = plays.schema["rusher_player_id"].dataType
    role = lambda kind, cond, column: F.when(
        F.expr(cond), F.struct(F.lit(kind).alias("kind"), F.col(column).cast(who).alias("player_id"))
    )
    roles = F.array(
        role("passer", PASS, "passer_player_id"), role("rusher", RUSH, "rusher_player_id"),
        role("receiver", TARGET, "receiver_player_id"),
    )
    measures = {name: _flag(cond) for name, cond in _LEVEL_COUNTS.items()}
    if detail:
        measures |= {"air": F.col("air_yards"), "yac": F.col("yards_after_catch"), "cpoe": F.col("cpoe"),
                     "caught": to_number(F.col("complete_pass"))}
    totals = [F.sum(m).alias(m) for m in measures]
    if detail:
        totals.append(F.count("cpoe").alias("cpoe_n"))
    entries = p.where(f"season is not null and ({PASS} or {RUSH} or {TARGET})").select(
        "season", F.col("posteam").alias("team"), F.explode(roles).alias("role"),
        *[m.alias(name) for name, m in measures.items()],
    ).where("role is not null")
    return settle(
        entries.groupBy("season", F.col("role.kind").alias("kind"), F.col("role.player_id").alias("player_id"), "team")
        .agg(*totals)
    )


def _of(kind: str, column: str):
    return F.sum(F.when(F.col("kind") == kind, F.col(column)))


def play_features(plays: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Receiver, rusher and team-share features per player-season.

    A player without rushes (or targets) has NULL in those columns, as an
    outer join of the two groups would give; one grouping supplies both.
    """
    levels = play_levels(plays) if levels is None else levels
    main_team = F.min(F.when(
        (F.col("kind") == "rusher") & F.col("team").isNotNull(), F.struct((-F.col("n")).alias("rank"), "team")
    ))
    player = levels.where("kind <> 'passer' and player_id is not null").groupBy(*KEYS).agg(
        _of("receiver", "red_zone").alias("rz_targets"), _of("rusher", "n").alias("carries"),
        _of("rusher", "red_zone").alias("rz_carries"), _of("rusher", "goal_line").alias("goalline_carries"),
        _of("rusher", "designed").alias("designed_rushes"), _of("rusher", "scrambled").alias("scrambles"),
        main_team["team"].alias("team"),
    )
    team = levels.where("kind <> 'receiver' and team is not null").groupBy("team", "season").agg(
        F.coalesce(_of("passer", "n"), F.lit(0)).alias("passes"), F.coalesce(_of("rusher", "n"), F.lit(0)).alias("rushes")
    )
    return player.join(team, ["team", "season"], "left").select(
        *KEYS, "rz_targets", "carries", "rz_carries", "goalline_carries", "designed_rushes", "scrambles",
        safe_ratio(F.col("passes"), F.col("passes") + F.col("rushes")).alias("team_pass_rate"),
        safe_ratio(F.col("carries"), F.col("rushes")).alias("carry_share"),
    )


def receiver_zones(levels: DataFrame) -> DataFrame:
    """``receiver_counts`` from the counted plays."""
    return levels.where("kind = 'receiver' and player_id is not null").groupBy(*KEYS).agg(F.sum("red_zone").alias("rz_targets"))


def rusher_zones(levels: DataFrame) -> DataFrame:
    """``rusher_counts`` from the counted plays."""
    counts = dict(zip(RUSH_COUNTS, ("n", "red_zone", "goal_line", "designed", "scrambled")))
    rushers = levels.where("kind = 'rusher' and player_id is not null")
    return rushers.groupBy(*KEYS).agg(*[F.sum(c).alias(out) for out, c in counts.items()])


def carry_context(levels: DataFrame) -> DataFrame:
    """Carries of each rusher next to the rushes and the pass rate of the team they carried most often for."""
    main_team = F.min(F.when(F.col("team").isNotNull(), F.struct((-F.col("n")).alias("rank"), "team")))
    player = levels.where("kind = 'rusher' and player_id is not null").groupBy(*KEYS).agg(
        F.sum("n").alias("carries"), main_team["team"].alias("posteam"))
    team = levels.where("kind <> 'receiver' and team is not null").groupBy(F.col("team").alias("posteam"), "season").agg(
        F.coalesce(_of("passer", "n"), F.lit(0)).alias("passes"), F.coalesce(_of("rusher", "n"), F.lit(0)).alias("team_rush_attempts"))
    rate = safe_ratio(F.col("passes"), F.col("passes") + F.col("team_rush_attempts"))
    return player.join(team.withColumn("team_pass_rate", rate).drop("passes"), ["posteam", "season"], "left")


def feature_table(
    seasonal: DataFrame | None = None, tracking: DataFrame | None = None, snaps: DataFrame | None = None,
    plays: DataFrame | None = None,
) -> DataFrame | None:
    """All feature frames side by side; the first frame with a column supplies it.

    Tracking, snaps and plays are group-by results, hence unique per key, and
    merge in one shuffle. Seasonal files come from outside and are joined
    without that promise.
    """
    taken = set(seasonal.columns if seasonal is not None else ()) - set(KEYS)
    grouped = [f.drop(*taken) for f in (tracking, snaps, plays) if f is not None]
    merged = outer_join_first_wins(grouped, KEYS, unique_keys=True) if grouped else None
    frames = [f for f in (seasonal, merged) if f is not None]
    return outer_join_first_wins(frames, KEYS) if frames else None


def passing_detail(levels: DataFrame) -> DataFrame:
    """Completion over expectation, depth per attempt and red-zone attempts per passer."""
    passers = levels.where("kind = 'passer' and player_id is not null")
    return passers.groupBy(*KEYS).agg(
        safe_ratio(F.sum("cpoe"), F.sum("cpoe_n")).alias("cpoe"),
        safe_ratio(sum_or_zero(F.col("air")), F.sum("n")).alias("air_yards_per_attempt"),
        F.sum("red_zone").alias("rz_pass_attempts"),
    )


def receiving_detail(levels: DataFrame) -> DataFrame:
    """Targets, depth, catch rate, yards after catch and shares of the main team's totals."""
    measures = {"targets": "n", "rz_targets": "red_zone", "_air": "air", "_caught": "caught", "_yac": "yac"}
    shares = {"target_share": "targets", "air_yards_share": "_air", "rz_target_share": "rz_targets"}
    return _shared(levels, ["receiver"], measures, shares).withColumns({
        "adot": safe_ratio(F.col("_air"), F.col("targets")),
        "catch_rate": safe_ratio(F.col("_caught"), F.col("targets")),
        "yac_per_reception": safe_ratio(F.col("_yac"), F.col("_caught")),
    }).drop("_air", "_caught", "_yac")


def rushing_detail(levels: DataFrame) -> DataFrame:
    """Carries by zone and the share of the main team's red-zone carries."""
    measures = {"carries": "n", "rz_carries": "red_zone", "goalline_carries": "goal_line"}
    return _shared(levels, ["rusher"], measures, {"rz_carry_share": "rz_carries"})


def opportunity_share(levels: DataFrame) -> DataFrame:
    """Targets plus carries as a share of the main team's."""
    return _shared(levels, ["receiver", "rusher"], {"opportunities": "n"}, {"opportunity_share": "opportunities"})


def _shared(
    levels: DataFrame, kinds: Sequence[str], measures: Mapping[str, str], shares: Mapping[str, str]
) -> DataFrame:
    """Measures per player-season and their share of the team the player appeared for most."""
    fine = levels.where(F.col("kind").isin(*kinds))
    sums = [sum_or_zero(F.col(column)).alias(name) for name, column in measures.items()]
    per_team = fine.where("player_id is not null").groupBy(*KEYS, "team").agg(F.sum("n").alias("_plays"), *sums)
    main_team = F.min(F.when(F.col("team").isNotNull(), F.struct((-F.col("_plays")).alias("rank"), "team")))
    player = per_team.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in measures], main_team["team"].alias("team")
    )
    team = fine.where("team is not null").groupBy("team", "season").agg(
        *[sum_or_zero(F.col(measures[c])).alias(f"_team_{c}") for c in sorted(set(shares.values()))]
    )
    return player.join(team, ["team", "season"], "left").select(
        *KEYS, *measures, *[safe_ratio(F.col(c), F.col(f"_team_{c}")).alias(out) for out, c in shares.items()]
    )


def pressure_to_sack_rate(plays: DataFrame, pressure: str = "was_pressure") -> DataFrame:
    """Sacks per pressure of each passer; NULL throughout where the plays have no pressure column (cleaned plays)."""
    faced = plays.withColumnsRenamed({"passer_player_id": "player_id"})
    pressures = F.sum(to_number(F.col(pressure))) if pressure in plays.columns else F.lit(None).cast("double")
    return group_present(faced, KEYS).agg(safe_ratio(F.sum("sack"), pressures).alias("pressure_to_sack_rate"))


def play_detail(plays: DataFrame) -> DataFrame:
    """The wide per-player play table: passing, receiving, rushing and combined columns, from one pass."""
    levels = play_levels(plays, detail=True)
    frames = [
        passing_detail(levels), receiving_detail(levels), rushing_detail(levels),
        opportunity_share(levels).drop("opportunities"),
    ]
    wide = outer_join_first_wins(frames, KEYS, unique_keys=True)
    return select_present(wide, shape(PLAY_FEATURES).fieldNames())
