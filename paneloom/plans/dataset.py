"""The filled dataset: cleaned groups and four passes of imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.text import map_values
from paneloom.operators import columns as c
from paneloom.operators.imputation import impute_by_bin
from paneloom.operators.ordered import cumcount_fill, mean_fill
from paneloom.runtime import store

_GROUP = "position_group"


def _archetype_codes(codes: Mapping[str, Mapping[str, int]]):
    value = F.lit(None).cast("int")
    for group, table in codes.items():
        value = F.when(F.col(_GROUP) == group, map_values(F.col("archetype"), table)).otherwise(value)
    return value


def prepare(
    panel: DataFrame,
    attributes: Sequence[str],
    team_codes: Mapping[str, int],
    style_codes: Mapping[str, int],
    archetype_codes: Mapping[str, Mapping[str, int]],
    newest_first: bool = True,
) -> DataFrame:
    """Labels to codes, defaults, season means and whole-number attributes.

    Missing years of experience count an entity's rows; ``newest_first`` starts
    at its latest season.
    """
    df = panel.filter(F.col(_GROUP).isNotNull() & (F.col(_GROUP) != "NA"))
    df = c.encode(c.encode(df, "team", team_codes), "runningstyle", style_codes)
    df = df.withColumn("archetype", _archetype_codes(archetype_codes))
    season = F.col("season").desc() if newest_first else F.col("season")
    order = [season, F.col("player_id").asc_nulls_last(), F.col("team").asc_nulls_last()]
    df = cumcount_fill(df, [_GROUP, "rating_id"], order, "yearspro")
    df = c.fill_defaults(
        df,
        {
            "draft_round": fixed_values.DRAFT_ROUND_DEFAULT,
            "draft_pick": fixed_values.DRAFT_PICK_DEFAULT,
        },
    )
    df = df.withColumn("is_rookie", c.is_newcomer(F.col("yearspro")))
    present = [m for m in fixed_values.SEASON_MEAN_COLUMNS if m in df.columns]
    df = mean_fill(df, [_GROUP, "season"], present)
    return c.coerce_whole(df, attributes)


def impute_eras(
    df: DataFrame,
    general: Sequence[str],
    attributes: Sequence[str],
    last: int,
    first: int = 2001,
    attribute_era: int = 2010,
    style_era: int = 2020,
    style: Sequence[str] = fixed_values.STYLE_COLUMNS,
    metric: str = "last_season_av",
    **options,
) -> DataFrame:
    """Attributes over the recent era, then over all seasons; style columns over
    their era, then over all seasons.

    A cell filled by one pass counts as known in the next, so the rows are
    stored between passes. ``general`` holds complete numeric columns
    (season, team, metric) that take part in the regressions.
    """
    plain = [*general, *[a for a in attributes if a not in style]]
    everything = [*general, *attributes]
    options = {"flag": "_filled", **options}

    def era(rows: DataFrame, start: int, targets: Sequence[str]) -> DataFrame:
        older = rows.filter(F.col("season") < start)
        done = impute_by_bin(
            rows.withColumn("_metric", F.col(metric)), [_GROUP], "_metric", targets, "season", start, last, **options
        ).drop("_metric", "_filled")
        kinds = dict(done.dtypes)
        older = older.withColumns({t: F.col(t).cast(kinds[t]) for t in targets})
        return store(older.unionByName(done))

    def whole_range(rows: DataFrame, targets: Sequence[str]) -> DataFrame:
        return era(rows.filter(F.col("season").between(first, last)), first, targets)

    rows = era(df.filter(F.col("season") <= last), attribute_era, plain)
    rows = whole_range(rows, plain)
    rows = era(rows, style_era, everything)
    rows = whole_range(rows, everything)
    rounded = [s for s in style if s in ("archetype", "runningstyle")]
    return rows.withColumns({s: F.bround(s, 0).cast("int") for s in rounded})


def build_dataset(
    panel: DataFrame,
    attributes: Sequence[str],
    team_codes: Mapping[str, int],
    style_codes: Mapping[str, int],
    archetype_codes: Mapping[str, Mapping[str, int]],
    last: int,
    general: Sequence[str] = ("season", "team", "last_season_av"),
    missed: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Panel to the dataset the views read: ids, labels, metric, attributes.

    Ratings that no roster row was found for (``missed``) are filled along and
    take part in the regressions; columns they lack are null.
    """
    if missed is not None:
        panel = panel.unionByName(missed, allowMissingColumns=True)
    ready = prepare(panel, attributes, team_codes, style_codes, archetype_codes)
    filled = impute_eras(ready, general, attributes, last, **options)
    filled = c.decode(filled.withColumn("season", F.col("season").cast("int")), "team", team_codes)
    labels = [
        "player_id", "rating_id", "metric_id", "fullname", "high_pos_group", "position_group",
        "position", "season", "team", "last_season_av",
    ]
    return filled.select(*labels, *[a for a in attributes if a not in labels])
