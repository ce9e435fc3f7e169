"""Joins with explicit rules for clashing columns, gaps, unmatched rows and shifted periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from fieldtally.functions.names import LONG_SUFFIXES, normalize_name, replace_exact, surrogate_id
from fieldtally.operators.ordering import keep_one
from fieldtally.operators.project import stack_frames


def join_with_clash(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    on_clash: str = "drop",
    suffix: str = "_right",
) -> DataFrame:
    """Equi-join in which non-key columns present on both sides are handled by ``on_clash``.

    ``drop`` removes both copies, ``left`` keeps the left one, ``suffix``
    keeps both and renames the right one.
    """
    clashes = [c for c in right.columns if c in left.columns and c not in on]
    if on_clash == "suffix":
        return left.join(right.withColumnsRenamed({c: c + suffix for c in clashes}), list(on), how)
    if on_clash not in ("drop", "left"):
        raise ValueError(f"unknown on_clash: {on_clash}")
    joined = left.join(right.drop(*clashes), list(on), how)
    return joined.drop(*clashes) if on_clash == "drop" else joined


def _merge_unique(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of frames that are unique on ``keys`` and share no other column.

    One union and one aggregate: a single shuffle for any number of frames,
    where a chain of outer joins would shuffle its result again at each step.
    """
    merged = stack_frames(frames)
    rest = [c for c in merged.columns if c not in keys]
    return merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])


def _outer(frames: Sequence[DataFrame], keys: Sequence[str], unique_keys: bool) -> DataFrame:
    if unique_keys and len(frames) > 1:
        return _merge_unique([f.dropna(subset=list(keys)) for f in frames], keys)
    return reduce(lambda a, b: a.join(b, list(keys), "outer"), frames)


def outer_join_first_wins(
    frames: Sequence[DataFrame | None], keys: Sequence[str], unique_keys: bool = False
) -> DataFrame:
    """Full outer join; a column already supplied by an earlier frame is ignored, absent frames are skipped.

    ``unique_keys=True`` promises one row per key in every frame and uses the
    single-shuffle form.
    """
    seen: set[str] = set(keys)
    trimmed = []
    for frame in (f for f in frames if f is not None):
        trimmed.append(frame.select(*keys, *[c for c in frame.columns if c not in seen]))
        seen.update(frame.columns)
    return _outer(trimmed, keys, unique_keys)


def outer_join_suffix(
    frames: Mapping[str, DataFrame], keys: Sequence[str], unique_keys: bool = False
) -> DataFrame:
    """Full outer join of named frames; a clashing column of a later frame becomes ``column_<frame>``."""
    seen: set[str] = set(keys)
    renamed = []
    for label, frame in frames.items():
        fresh = frame.withColumnsRenamed({c: f"{c}_{label}" for c in frame.columns if c in seen and c not in keys})
        renamed.append(fresh)
        seen.update(fresh.columns)
    return _outer(renamed, keys, unique_keys)


def left_join_new_columns(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join that only brings columns the left side lacks."""
    return join_with_clash(left, right, on, "left", "left")


def prior_period(df: DataFrame, entity: str, period: str, cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add each column's value from exactly one period earlier; NULL across a gap.

    For input unique in (entity, period): the row before in period order is
    the only candidate, so a window over one entity's few periods replaces a
    self-join.
    """
    timeline = Window.partitionBy(entity).orderBy(period)
    before = F.lag(F.struct(F.col(period).alias("_period"), *cols)).over(timeline)
    tagged = df.withColumn("_prior", before)
    adjacent = F.col("_prior._period") == F.col(period) - 1
    return tagged.select(
        *df.columns, *[F.when(adjacent, F.col(f"_prior.{c}")).alias(prefix + c) for c in cols]
    )


def shift_period(df: DataFrame, keys: Sequence[str], period: str, prefix: str = "prev_") -> DataFrame:
    """Rename all non-key columns and move the period one step on, ready to join as prior values."""
    rest = [c for c in df.columns if c not in keys]
    moved = {k: (F.col(k) + 1).cast(df.schema[k].dataType).alias(k) if k == period else F.col(k) for k in keys}
    return df.select(*moved.values(), *[F.col(c).alias(prefix + c) for c in rest])


def semi_relevant(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key ever appears in ``reference``."""
    return df.join(reference.select(key).distinct(), key, "left_semi")


def match_entities(
    feed: DataFrame,
    roster: DataFrame,
    name: str,
    keys: Sequence[str],
    roster_name: str = "full_name",
    entity: str = "player_id",
    fixes: Mapping[str, str] | None = None,
    suffixes: Sequence[str] = LONG_SUFFIXES,
    unmatched: str = "drop",
    prefix: str = "ds-",
) -> tuple[DataFrame, DataFrame]:
    """Attach entity ids by normalised name plus ``keys``; returns (matched, unmatched).

    Every namesake with the same keys is matched. ``unmatched="generate"``
    keeps rows without a match under an id built from their name, flagged by
    ``is_generated``. Matches come from an inner join, where a frequent name
    can be split on either side, and misses from an anti-join with the
    distinct names.
    """
    if unmatched not in ("drop", "generate"):
        raise ValueError(f"unknown unmatched rule: {unmatched}")
    on = ["name_norm", *keys]
    keyed = feed.withColumn("name_norm", normalize_name(replace_exact(F.col(name), fixes or {}), suffixes))
    people = (
        roster.select(entity, roster_name, *keys).distinct()
        .select(F.col(entity), normalize_name(F.col(roster_name), suffixes).alias("name_norm"), *keys)
        .dropna(subset=[entity])
    )
    matched = keyed.join(people, on, "inner")
    missing = keyed.join(people.select(*on).distinct(), on, "left_anti")
    if unmatched == "drop":
        return matched, missing
    generated = missing.withColumns({
        entity: surrogate_id(F.col(name), prefix), "is_generated": F.lit(True)
    })
    known = matched.withColumns({entity: F.col(entity).cast("string"), "is_generated": F.lit(False)})
    return known.unionByName(generated), generated


def ambiguous_names(
    roster: DataFrame, keys: Sequence[str], roster_name: str = "full_name", entity: str = "player_id",
    suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """Normalised names that stand for more than one entity, with the number of entities."""
    people = roster.select(entity, normalize_name(F.col(roster_name), suffixes).alias("name_norm"), *keys).distinct()
    return people.groupBy("name_norm", *keys).agg(F.count(entity).alias("entities")).where("entities > 1")


def crosswalk(df: DataFrame, external: str, entity: str, order: Sequence[str]) -> DataFrame:
    """One entity per external id, the first in ``order``; rows lacking either id are ignored."""
    pairs = df.dropna(subset=[external, entity]).select(*dict.fromkeys([external, entity, *order]))
    return keep_one(pairs, [external], order, "first").select(external, entity)


def join_crosswalk(
    df: DataFrame, xwalk: DataFrame, external: str, entity: str, weight: str | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Translate external ids and drop rows without one.

    An ``Observation`` receives the number of dropped rows (``weight`` is the
    rows each input row stands for) from the same job.
    """
    joined = df.join(xwalk, external, "left")
    if observation is not None:
        rows = F.col(weight) if weight else F.lit(1)
        lost = F.coalesce(F.sum(F.when(F.col(entity).isNull(), rows)), F.lit(0))
        joined = joined.observe(observation, lost.alias("unmatched_rows"))
    return joined.where(F.col(entity).isNotNull())
