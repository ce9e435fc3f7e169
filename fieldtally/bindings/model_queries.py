"""Regression steps and ranking metrics."""

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.group_queries import rounded
from fieldtally.bindings.registry import query
from fieldtally.bindings.tables import with_views
from fieldtally.functions.numeric import half_even
from fieldtally.operators import metrics, ordering, regression
from fieldtally.operators.aggregates import spread_stats
from fieldtally.plans import league
from fieldtally.plans import valuation as val
from fieldtally.session import scratch_path, settle
from fieldtally.sources import sinks
from fieldtally.sources.models import ModelStore

PAIR = league.MARKET_COLUMNS
NUMERIC = ("career_season", "prev_ppg", "prev_games_played", "prev_wopr", "prev_adot", "prev_efficiency",
           "prev_snap_pct", "prev_team_pass_rate", "prev_carry_share")

ROWS = """SELECT *, season <= 1999 AS is_train FROM mega WHERE ppg IS NOT NULL"""
Z = """SELECT r.player_id, r.season, r.position, r.ppg, r.is_train, (adp_overall - m1) / s1 AS z1,
              (adp_position_rank - m2) / s2 AS z2
       FROM rows r JOIN (SELECT position, avg(adp_overall) AS m1, stddev_pop(adp_overall) AS s1,
                                avg(adp_position_rank) AS m2, stddev_pop(adp_position_rank) AS s2
                         FROM rows WHERE is_train GROUP BY position) USING (position)"""
COEFS = """SELECT position, n_train, intercept, (ay * bb - ab * cy) / (aa * bb - ab * ab) AS c1,
                  (cy * aa - ab * ay) / (aa * bb - ab * ab) AS c2
           FROM (SELECT position, count(*) AS n_train, avg(ppg) AS intercept, sum(z1 * z1) + 1 AS aa,
                        sum(z2 * z2) + 1 AS bb, sum(z1 * z2) AS ab, sum(z1 * ppg) AS ay, sum(z2 * ppg) AS cy
                 FROM z WHERE is_train GROUP BY position)"""
PRICED = """SELECT player_id, season, position, is_train, ppg, intercept + c1 * z1 + c2 * z2 AS expected
            FROM z JOIN coefs USING (position)"""
STEPS = {"rows": ROWS, "z": Z, "coefs": COEFS, "priced": PRICED}
# Prediction by last season's value: exact inputs for the metrics.
GUESSES = """SELECT position, season, ppg AS y, prev_ppg AS p, CASE position WHEN 'AUTOMOBILE' THEN 8 WHEN 'MACHINERY' THEN 8
                    WHEN 'HOUSEHOLD' THEN 10 ELSE 12 END AS k
             FROM mega WHERE ppg IS NOT NULL AND prev_ppg IS NOT NULL"""


def metric_steps(group):
    """The views from guesses (group.., season, y, p, k) to the metrics per group and season."""
    ranked = f"""SELECT *, rank() OVER (PARTITION BY {group}, season ORDER BY y DESC) <= k AS actual,
                        rank() OVER (PARTITION BY {group}, season ORDER BY p DESC) <= k AS predicted,
                        count(*) OVER (PARTITION BY {group}, season) AS n FROM guesses"""
    top = f"""SELECT {group}, season, rank() OVER (PARTITION BY {group}, season ORDER BY y)
                     + (count(*) OVER (PARTITION BY {group}, season, y) - 1) / 2 AS ry,
                     rank() OVER (PARTITION BY {group}, season ORDER BY p)
                     + (count(*) OVER (PARTITION BY {group}, season, p) - 1) / 2 AS rp
              FROM ranked WHERE actual"""
    per = f"""SELECT {group}, season, count(*) FILTER (actual AND predicted) / any_value(k) AS precision_at_k,
                     avg(abs(y - p)) FILTER (actual) AS mae_at_k, any_value(rho) AS spearman_at_k
              FROM ranked LEFT JOIN (SELECT {group}, season, CASE WHEN stddev_pop(ry) > 0 AND stddev_pop(rp) > 0 THEN corr(ry, rp) END AS rho
                                     FROM top GROUP BY {group}, season)
                   USING ({group}, season)
              WHERE n >= k GROUP BY {group}, season"""
    return {"ranked": ranked, "top": top, "per": per}


def tidy_metrics(group):
    """All five metrics of guesses as (group.., metric, value)."""
    return f"""
    SELECT * FROM (SELECT {group}, round_even(mae, 3) AS mae, round_even(r, 3) AS r,
                    round_even(precision_at_k, 3) AS precision_at_k, round_even(spearman_at_k, 3) AS spearman_at_k,
                    round_even(mae_at_k, 3) AS mae_at_k
             FROM (SELECT {group}, avg(abs(y - p)) AS mae, corr(y, p) AS r FROM guesses GROUP BY {group})
             LEFT JOIN (SELECT {group}, avg(precision_at_k) AS precision_at_k, avg(spearman_at_k) AS spearman_at_k,
                          avg(mae_at_k) AS mae_at_k FROM per GROUP BY {group}) USING ({group}))
    UNPIVOT INCLUDE NULLS (value FOR metric IN (mae, r, precision_at_k, spearman_at_k, mae_at_k))"""


METRICS = {"guesses": GUESSES, **metric_steps("position")}

# The residual ridge by elimination: all features long, filled and scaled as the training rows say, the normal
# equations of every position with 10 on the diagonal, and one column cleared a step.
FEATURE_NAMES = (
    "wopr", "air_yards", "yards_after_catch", "adot", "time_to_throw", "intended_air_yards", "efficiency", "separation",
    "intended_air_yards_receiving", "offense_snaps", "snap_pct", "rz_targets", "rz_carries", "goalline_carries",
    "designed_rushes", "scrambles", "team_pass_rate", "carry_share")
FEATURES = ("career_season", "prev_ppg", "prev_games_played", "prev_fantasy_points_ppr", "prev_pass_attempts",
            *(f"prev_{x}" for x in FEATURE_NAMES))
N = len(FEATURES)
RIDGE = {
    "long_rows": f"""
        SELECT player_id, season, position, is_train, CAST(name[2:] AS INT) AS i, value FROM (
            SELECT player_id, season, position, is_train, {", ".join(f'CAST({x} AS DOUBLE) AS f{i}' for i, x in enumerate(FEATURES, 1))}
            FROM rows) UNPIVOT INCLUDE NULLS (value FOR name IN ({", ".join(f"f{i}" for i in range(1, N + 1))}))""",
    "long_filled": """
        SELECT player_id, season, position, is_train, i, CASE WHEN med IS NULL THEN 0 ELSE coalesce(value, med) END AS value
        FROM long_rows JOIN (SELECT position, i, median(value) FILTER (is_train) AS med FROM long_rows GROUP BY ALL)
             USING (position, i)""",
    "long_z": """
        SELECT player_id, season, position, is_train, i, (value - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS x
        FROM long_filled JOIN (SELECT position, i, avg(value) AS m, stddev_pop(value) AS s FROM long_filled
                               WHERE is_train GROUP BY ALL) USING (position, i)""",
    "equations": f"""
        SELECT position, a.i, b.i AS j, sum(a.x * b.x) + CASE WHEN a.i = b.i THEN 10 ELSE 0 END AS v
        FROM long_z a JOIN long_z b USING (player_id, season, position) WHERE a.is_train GROUP BY position, a.i, b.i
        UNION ALL
        SELECT position, i, {N + 1}, sum(x * (ppg - expected)) FROM long_z JOIN priced USING (player_id, season, position)
        WHERE long_z.is_train GROUP BY ALL""",
    "solved": f"""
        WITH RECURSIVE cleared AS (
            SELECT 0 AS k, position, i, j, v FROM equations UNION ALL
            SELECT k + 1, position, i, j, CASE WHEN i = k + 1 THEN line / corner ELSE v - side * line / corner END
            FROM (SELECT *, max(v) FILTER (i = k + 1) OVER (PARTITION BY position, j) AS line,
                         max(v) FILTER (j = k + 1) OVER (PARTITION BY position, i) AS side,
                         max(v) FILTER (i = k + 1 AND j = k + 1) OVER (PARTITION BY position) AS corner
                  FROM cleared WHERE k < {N}))
        SELECT position, i, v AS coef FROM cleared WHERE k = {N} AND j = {N + 1}""",
    "fitted": """
        SELECT p.player_id, p.season, p.position, any_value(ppg) AS ppg, any_value(expected) AS expected,
               any_value(expected) + any_value(base) + sum(x * coef) AS ridge
        FROM priced p JOIN long_z z USING (player_id, season, position) JOIN solved s ON z.i = s.i AND z.position = s.position
             JOIN (SELECT position, avg(ppg - expected) AS base FROM priced WHERE is_train GROUP BY position) b ON b.position = p.position
        WHERE NOT p.is_train GROUP BY ALL""",
}
SCORED = """
    SELECT position, model, season, ppg AS y, p, CASE position WHEN 'AUTOMOBILE' THEN 8 WHEN 'MACHINERY' THEN 8
           WHEN 'HOUSEHOLD' THEN 10 ELSE 12 END AS k
    FROM (SELECT position, 'market' AS model, season, ppg, expected AS p FROM fitted
          UNION ALL SELECT position, 'ridge', season, ppg, ridge FROM fitted)"""


def rows(spark, folder, cols=PAIR, wide=False):
    return val.training_rows(c.mega(spark, folder, wide), t.ALL_SEGMENTS, list(cols), t.TRAIN, t.TEST)


def priced(spark, folder):
    return val.baseline(val.scaled_rows(rows(spark, folder), PAIR))


def guesses(spark, folder):
    return c.mega(spark, folder, False).dropna(subset=["ppg", "prev_ppg"]).select(
        "player_id", "position", "season", F.col("ppg").alias("y"), F.col("prev_ppg").alias("p"))


def valued(spark, folder, boosted):
    """The whole valuation; boosted models fitted on the same files before are loaded."""
    inputs = [f"{folder}/{name}.parquet" for name in ("customer", "events", "lineitem", "orders", "part")]
    return val.valuation(c.mega(spark, folder), t.SEGMENT_K, t.TRAIN, t.TEST, boosted=boosted, store=ModelStore(spark, inputs))


def per_period(spark, folder, *cols):
    per = metrics.topk_by_period(guesses(spark, folder), "y", "p", "season", t.SEGMENT_K, ["position"], "position")
    return rounded(per.select("position", "season", *cols), *cols, places=4)


@query("a16_residual_statistics", with_views("""
    SELECT position, round(avg(ppg - expected), 1) + 0 AS mean, round(stddev_samp(ppg - expected), 1) AS std,
           round(min(ppg - expected), 1) AS min, round(max(ppg - expected), 1) AS max
    FROM priced WHERE is_train GROUP BY position""", "mega", **STEPS))
def _(spark, folder):
    stats = spread_stats(priced(spark, folder)[0].where("is_train"), "residual", ["position"])
    return stats.select("position", *[(F.round(x, 1) + 0).alias(x) for x in ("mean", "std", "min", "max")])


@query("a17_mean_absolute_error", with_views(
    "SELECT season, round(avg(abs(y - p)), 3) AS mae FROM guesses GROUP BY season", "mega", guesses=GUESSES))
def _(spark, folder):
    error = metrics.mean_absolute_error("y", "p")
    return guesses(spark, folder).groupBy("season").agg(F.round(error, 3).alias("mae"))


@query("a18_exact_median", with_views(
    " UNION ALL ".join(f"""
        SELECT position, '{x}' AS feature, round(median(CAST({x} AS DOUBLE)), 4) AS median FROM rows
        WHERE is_train AND {x} IS NOT NULL GROUP BY position""" for x in NUMERIC), "mega", rows=ROWS))
def _(spark, folder):
    train = rows(spark, folder, NUMERIC, True).where("is_train")
    return rounded(ordering.exact_medians(train, NUMERIC, ["position"]), "median", places=4)


@query("a19_mean_over_seasons", with_views("""
    SELECT position, round(avg(mae), 3) AS mae FROM (
        SELECT position, season, avg(abs(y - p)) AS mae FROM guesses GROUP BY ALL) GROUP BY position""",
    "mega", guesses=GUESSES))
def _(spark, folder):
    per = guesses(spark, folder).groupBy("position", "season").agg(metrics.mean_absolute_error("y", "p").alias("mae"))
    return per.groupBy("position").agg(F.round(F.avg("mae"), 3).alias("mae"))


@query("m1_time_split", with_views("""
    SELECT player_id, season, is_train FROM rows""", "mega", rows=ROWS))
def _(spark, folder):
    known = c.mega(spark, folder, False).dropna(subset=["ppg"]).select("player_id", "season")
    train, test = regression.time_split(known, "season", t.TRAIN, t.TEST)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("m2_median_impute", with_views("""
    SELECT r.player_id, r.season, coalesce(r.prev_ppg, m.a) AS prev_ppg, coalesce(r.prev_adot, m.b) AS prev_adot,
           CASE WHEN m.c IS NULL THEN 0 ELSE coalesce(r.prev_efficiency, m.c) END AS prev_efficiency
    FROM rows r JOIN (SELECT position, median(prev_ppg) AS a, median(prev_adot) AS b, median(prev_efficiency) AS c
                      FROM rows WHERE is_train GROUP BY position) m USING (position)""", "mega", rows=ROWS))
def _(spark, folder):
    cols = ["prev_ppg", "prev_adot", "prev_efficiency"]
    known = rows(spark, folder, cols, True)
    medians = regression.median_table(known.where("is_train"), cols, ["position"])
    return regression.impute_median(known, medians, cols, ["position"]).select("player_id", "season", *cols)


@query("m3_standardize", with_views(
    "SELECT player_id, season, round(z1, 6) + 0 AS adp_overall, round(z2, 6) + 0 AS adp_position_rank FROM z", "mega", **STEPS))
def _(spark, folder):
    known = rows(spark, folder)
    scales = regression.scale_table(known.where("is_train"), PAIR, ["position"])
    scaled = regression.standardize(known, scales, PAIR, ["position"])
    return scaled.select("player_id", "season", *[(F.round(x, 6) + 0).alias(x) for x in PAIR])


@query("m4_ridge_baseline", with_views("""
    SELECT position, round(intercept, 1) AS intercept, round(c1, 1) AS coef_adp_overall,
           round(c2, 1) AS coef_adp_position_rank, n_train FROM coefs""", "mega", **STEPS))
def _(spark, folder):
    coefs = priced(spark, folder)[1]
    shown = [F.round(x, 1).alias(x) for x in ("intercept", "coef_adp_overall", "coef_adp_position_rank")]
    return coefs.select("position", *shown, "n_train")


@query("m5_residual_target", with_views(
    "SELECT player_id, season, round(ppg - expected, 1) + 0 AS residual FROM priced", "mega", **STEPS))
def _(spark, folder):
    return priced(spark, folder)[0].select("player_id", "season", (F.round("residual", 1) + 0).alias("residual"))


@query("m6_residual_ridge", with_views("""
    SELECT player_id, season, position, ppg, round(ridge, 1) + 0 AS ridge FROM fitted""", "mega", **STEPS, **RIDGE))
def _(spark, folder):
    fitted = valued(spark, folder, False).predictions
    return fitted.select("player_id", "season", "position", "ppg", (F.round("ridge", 1) + 0).alias("ridge"))


@query("m6b_residual_ridge_coefficients", with_views(f"""
    SELECT position, i, round(coef, 1) + 0 AS coef FROM solved WHERE i <= {N}""", "mega", **STEPS, **RIDGE))
def _(spark, folder):
    ridge = valued(spark, folder, False)
    order = F.create_map(*[x for i, name in enumerate(FEATURES, 1) for x in (F.lit(name), F.lit(i))])
    named = F.arrays_zip(F.array(*map(F.lit, ridge.features)).alias("name"), F.col("coefs").alias("coef"))
    tall = ridge.residual_ridge.select("position", F.explode(named).alias("x"))
    return tall.select("position", order[F.col("x.name")].alias("i"), (F.round("x.coef", 1) + 0).alias("coef"))


@query("m7_residual_boosted")
def _(spark, folder):
    return valued(spark, folder, True).predictions.select("player_id", "season", "position", "ppg", "boosted")


# Ridge on the two market columns over all positions at once; both have mean 0 among the training rows.
POOLED = """SELECT intercept, (ay * bb - ab * cy) / (aa * bb - ab * ab) AS c1, (cy * aa - ab * ay) / (aa * bb - ab * ab) AS c2
            FROM (SELECT avg({y}) AS intercept, sum(z1 * z1) + 1 AS aa, sum(z2 * z2) + 1 AS bb, sum(z1 * z2) AS ab,
                         sum(z1 * {y}) AS ay, sum(z2 * {y}) AS cy FROM {rows} WHERE is_train)"""
LEFT = """SELECT z.*, expected, z.ppg - expected AS residual FROM z JOIN priced USING (player_id, season, position)"""


@query("m8_final_prediction", with_views("""
    SELECT player_id, season, round(expected + intercept + c1 * z1 + c2 * z2) + 0 AS final
    FROM left_over, pooled WHERE NOT is_train""", "mega", **STEPS, left_over=LEFT, pooled=POOLED.format(y="residual", rows="left_over")))
def _(spark, folder):
    ready = settle(regression.assemble(priced(spark, folder)[0], PAIR))
    model = regression.fit_ridge(ready.where("is_train"), val.RESIDUAL, 1.0)
    final = regression.add_fit(ready.where("not is_train"), model, val.EXPECTED, "final")
    return final.select("player_id", "season", (F.round("final", 0) + 0).alias("final"))


@query("m9_pooled_accuracy", with_views(
    "SELECT position, round(avg(abs(y - p)), 3) AS mae, round(corr(y, p), 6) AS r FROM guesses GROUP BY position",
    "mega", guesses=GUESSES))
def _(spark, folder):
    scores = metrics.accuracy(guesses(spark, folder), "y", "p", ["position"])
    return scores.select("position", F.round("mae", 3).alias("mae"), F.round("r", 6).alias("r"))


@query("m10_precision_at_k", with_views(
    "SELECT position, season, round(precision_at_k, 4) AS precision_at_k FROM per", "mega", **METRICS))
def _(spark, folder):
    return per_period(spark, folder, "precision_at_k")


@query("m11_spearman_at_k", with_views(
    "SELECT position, season, round(spearman_at_k, 4) AS spearman_at_k FROM per", "mega", **METRICS))
def _(spark, folder):
    return per_period(spark, folder, "spearman_at_k")


@query("m12_mae_at_k", with_views(
    "SELECT position, season, round(mae_at_k, 4) AS mae_at_k FROM per", "mega", **METRICS))
def _(spark, folder):
    return per_period(spark, folder, "mae_at_k")


@query("m13_feature_importance")
def _(spark, folder):
    return valued(spark, folder, True).importances


@query("m14_metrics_per_position", with_views(
    f"SELECT position, 'p' AS model, metric, value FROM ({tidy_metrics('position')})", "mega", **METRICS))
def _(spark, folder):
    return metrics.evaluate(guesses(spark, folder), "y", ["p"], "season", t.SEGMENT_K, ["position"], "position")


@query("m15_metrics_table")
def _(spark, folder):
    return valued(spark, folder, True).metrics()


@query("m15b_market_and_ridge_metrics", with_views(
    tidy_metrics("position, model"), "mega", **STEPS, **RIDGE, guesses=SCORED, **metric_steps("position, model")))
def _(spark, folder):
    return valued(spark, folder, False).metrics()


@query("m16_model_vs_market", with_views("""
    SELECT player_id, season, position, CAST(rank() OVER m AS INT) AS model_rank, CAST(rank() OVER a AS INT) AS market_rank,
           CAST(rank() OVER a - rank() OVER m AS INT) AS rank_gap
    FROM mega WHERE prev_ppg IS NOT NULL
    WINDOW m AS (PARTITION BY season, position ORDER BY prev_ppg DESC),
           a AS (PARTITION BY season, position ORDER BY adp_overall)""", "mega"))
def _(spark, folder):
    known = settle(c.mega(spark, folder, False).dropna(subset=["prev_ppg"]).select(
        "player_id", "season", "position", "prev_ppg", "adp_overall"))
    cols = ["player_id", "season", "position", "model_rank", "market_rank", "rank_gap"]
    return val.model_vs_market(known, "prev_ppg").select(*cols)


@query("t5_top_features")
def _(spark, folder):
    """The ten features that the residual models use most, with their place in their position."""
    return ordering.rank_min(valued(spark, folder, True).importances, ["position"], "importance", "place")


@query("s18_json_sink", with_views("""
    SELECT position, round_even(avg(abs(y - p)), 3) AS mae FROM guesses GROUP BY position""", "mega", guesses=GUESSES))
def _(spark, folder):
    path = scratch_path(spark, "metrics")
    scores = metrics.accuracy(guesses(spark, folder), "y", "p", ["position"])
    sinks.write_json(scores.select("position", half_even(F.col("mae"), 3).alias("mae")), path)
    return spark.read.schema("position string, mae double").json(path)


@query("s19_model_sink", with_views("""
    SELECT player_id, season, ppg, round(intercept + c1 * z1 + c2 * z2) + 0 AS fit FROM z, pooled WHERE NOT is_train""",
    "mega", **STEPS, pooled=POOLED.format(y="ppg", rows="z")))
def _(spark, folder):
    ready = regression.assemble(val.scaled_rows(rows(spark, folder), PAIR), PAIR)
    model = regression.fit_ridge(ready.where("is_train"), "ppg", 1.0)
    saved = sinks.write_models({"market_ridge": model}, scratch_path(spark, "models"))
    again = LinearRegressionModel.load(saved["market_ridge"])
    return again.transform(ready.where("not is_train")).select(
        "player_id", "season", "ppg", (F.round("_fit", 0) + 0).alias("fit"))


@query("q10_valuation_model")
def _(spark, folder):
    return valued(spark, folder, True).metrics()
