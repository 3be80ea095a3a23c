"""Entity resolution: a cascade of exact and fuzzy tiers, and the registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.operators.groups import modal_value
from paneloom.operators.matching import fuzzy_best_match
from paneloom.runtime import store


@dataclass(frozen=True)
class Tier:
    """One step of the cascade.

    ``on`` maps column names to a pair of expressions (left, right) that must be
    equal. With ``threshold`` the names are compared by similarity, else the
    equality of ``on`` decides alone. ``names`` replaces the compared names.
    """

    name: str
    on: Mapping[str, tuple[Column, Column]] = field(default_factory=dict)
    threshold: float | None = None
    names: tuple[Column, Column] | None = None


@dataclass(frozen=True)
class Resolution:
    """Matches (scope, left id, right id, tier) and what stayed unmatched."""

    matches: DataFrame
    unmatched_left: DataFrame
    unmatched_right: DataFrame


def _narrow_side(
    df: DataFrame, position: int, scope: Sequence[str], identity: str, name: str, tiers: Sequence[Tier]
) -> DataFrame:
    """Scope, id and what the tiers compare, stored: what comes before the
    cascade runs once per side, not once per tier."""
    compared = []
    for place, tier in enumerate(tiers):
        compared += [pair[position].alias(f"_on{place}_{k}") for k, pair in tier.on.items()]
        if tier.threshold is not None:
            text = tier.names[position] if tier.names else F.col(name)
            compared.append(text.alias(f"_name{place}"))
    return store(df.select(*scope, identity, *compared))


def _one_block_each(side: DataFrame, key: Sequence[str]) -> bool:
    """Whether no id of a scope is in several blocks."""
    return side.groupBy(*key).count().filter("count > 1").isEmpty()


def _tier_matches(
    left: DataFrame,
    right: DataFrame,
    scope: Sequence[str],
    left_id: str,
    right_id: str,
    place: int,
    tier: Tier,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of a tier and the ids (per scope) that it matches on the left and on the right.

    Pairs of an exact tier are as many as the square of a block of copies: they are joined when they are read, and
    the ids that have one are found from the blocks.
    """
    block = [*scope, *[f"_on{place}_{k}" for k in tier.on]]
    if tier.threshold is None:
        a, b = left.select(*block, left_id).distinct(), right.select(*block, right_id).distinct()
        pairs = a.join(b, block).select(*scope, left_id, right_id)
        if not (_one_block_each(a, [*scope, left_id]) or _one_block_each(b, [*scope, right_id])):
            pairs = pairs.distinct()
        met = [
            side.join(other.select(*block).distinct(), block, "left_semi").select(*scope, identity).distinct()
            for side, other, identity in ((a, b, left_id), (b, a, right_id))
        ]
    else:
        text = f"_name{place}"
        a, b = left.select(*block, left_id, text), right.select(*block, right_id, text)
        pairs = fuzzy_best_match(a, b, block, left_id, text, right_id, text, tier.threshold)
        pairs = store(pairs.select(*scope, left_id, right_id).distinct())
        met = [pairs.select(*scope, identity).distinct() for identity in (left_id, right_id)]
    return pairs.withColumn("tier", F.lit(tier.name)), store(met[0]), store(met[1])


def resolve_entities(
    left: DataFrame,
    right: DataFrame,
    scope: Sequence[str],
    left_id: str,
    right_id: str,
    name: str,
    tiers: Sequence[Tier],
) -> Resolution:
    """Run the tiers in order over all scopes (seasons) at once.

    Each tier sees the ids, per scope, that no earlier tier matched on either
    side. What a tier leaves open is stored, so a later tier
    neither recomputes it nor carries its plan.
    """
    a = _narrow_side(left, 0, scope, left_id, name, tiers)
    b = _narrow_side(right, 1, scope, right_id, name, tiers)
    found = []
    for place, tier in enumerate(tiers):
        found.append(_tier_matches(a, b, scope, left_id, right_id, place, tier))
        if place + 1 < len(tiers):
            a = store(a.join(found[-1][1], [*scope, left_id], "left_anti"))
            b = store(b.join(found[-1][2], [*scope, right_id], "left_anti"))
    pairs, met_left, met_right = (reduce(DataFrame.unionByName, part) for part in zip(*found, strict=True))
    return Resolution(
        pairs,
        left.join(met_left, [*scope, left_id], "left_anti"),
        right.join(met_right, [*scope, right_id], "left_anti"),
    )


def roster_tiers(age: Column, position_group: str = "position_group") -> list[Tier]:
    """The seven tiers that match ratings with rosters.

    Both sides carry fullname, team, jerseynumber, birthdate, yearspro and the
    position group; ``age`` is the right side's age expression.
    """
    same = lambda c: (F.col(c), F.col(c))
    whole = lambda c: tuple(
        F.col(c).cast("string").try_cast("double").try_cast("int") for _ in range(2)
    )
    day = F.col("birthdate").cast("date")
    clean = F.col("fullname_clean")
    grouped = F.concat(clean, F.lit(" "), F.col(position_group))
    return [
        Tier("group_name", {"group": same(position_group), "name": same("fullname_clean")}),
        Tier(
            "team_number_name",
            {"team": same("team"), "number": whole("jerseynumber"), "name": same("fullname_clean")},
        ),
        Tier("birth_fuzzy", {"birth": (day, day)}, threshold=80),
        Tier(
            "age_fuzzy",
            {"age": (F.col("age").cast("int"), age)},
            threshold=87,
        ),
        Tier("years_fuzzy", {"years": whole("yearspro")}, threshold=80),
        Tier("name", {"name": same("fullname_clean")}),
        Tier("group_fuzzy", {}, threshold=70, names=(grouped, grouped)),
    ]


def build_registry(
    matches: DataFrame,
    left_id: str,
    right_id: str,
    manual: Mapping[str, str] | None = None,
    details: DataFrame | None = None,
) -> DataFrame:
    """One left id per right id: the most frequent, the smallest among equals;
    then one right id per left id, the smallest.

    Manual pairs are appended, told apart by ``manual``: whoever needs one pair
    per right id takes those that are not manual first. ``details`` (one row per
    right id) adds its columns to the pairs.
    """
    modal = modal_value(matches, [right_id], left_id)
    registry = modal.groupBy(left_id).agg(F.min(right_id).alias(right_id)).withColumn("manual", F.lit(False))
    if manual:
        kinds = dict(matches.dtypes)
        pairs = matches.sparkSession.createDataFrame(
            list(manual.items()), f"{left_id} {kinds[left_id]}, {right_id} {kinds[right_id]}"
        )
        registry = registry.unionByName(pairs.withColumn("manual", F.lit(True)))
    return registry if details is None else registry.join(details, right_id, "left")
