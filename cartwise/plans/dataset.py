"""Training and scoring sets: candidates with all seven families, differences and selection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import named
from cartwise.operators.joins import broadcast_if_small
from cartwise.operators.measures import UCS
from cartwise.plans.families import KEYS, MAX_USER_ROWS

# Order of the families in an assembled set.
FAMILY_ORDER = ("u", "ucs", "c", "s", "uc", "us", "cs")

# Differences between two ranges of one count: fixed values (count, longer range, shorter range).
DIFFERENCES = (
    ("ucs_b1_count_in", 5, 1),
    ("ucs_b1_count_in", 7, 3),
    ("ucs_b2_count_in", 5, 1),
    ("c_b_count_in", 7, 3),
    ("us_b4_count_in", 5, 1),
    ("us_b3_count_in", 5, 1),
    ("us_b4_count_in", 7, 3),
    ("us_b3_count_in", 7, 3),
)

# Columns left out of the model: fixed values.
WEAK_COLUMNS = (
    "c_b_count_in_3", "c_b_count_in_5", "c_b_count_in_7",
    "city_level_2", "city_level_6",
    "cs_major_cate",
    "or_shop_score",
    "province_2", "province_3", "province_4", "province_9", "province_12", "province_13",
    "province_17", "province_18", "province_24", "province_25",
    "reg_time_4",
    "shop_reg_tm_5",
    "ucs_b2_count_in_1",
    "ucs_b3_count_in_3", "ucs_b3_count_in_5", "ucs_b3_count_in_7",
    "ucs_b4_count_in_3", "ucs_b4_count_in_5", "ucs_b4_count_in_7",
    "unknown",
    "us_b3_count_in_1", "us_b3_count_in_5",
    "us_b4_count_in_1", "us_b4_count_in_7",
)


def assemble(
    candidates: DataFrame, families: Mapping[str, DataFrame], rows_per_user: int | None = None, by_user: int | None = None
) -> DataFrame:
    """Left join of every family onto the candidates, in the given order of columns.

    ``rows_per_user`` is a proven bound on the candidates of one user (:attr:`Inputs.rows_per_user`). Within the
    limit, the candidates and the four user-keyed families are clustered by user_id and stay so through their
    joins (see ``session.PLAN_CONF``). ``by_user`` says that all of them already are, in as many partitions
    (:attr:`Inputs.by_user`), and then none of them is shuffled. Without a bound every join shuffles on its own keys
    and AQE splits hot users. The category and shop families are broadcast if their measured size allows; if not, they
    shuffle, and AQE splits hot categories and shops.

    The features of a family travel as one struct, so that sorts and joins copy a few columns a row and not up to 280, and
    become columns once, after the last join.
    """
    bucketed = by_user
    clustered = by_user is None and rows_per_user is not None and rows_per_user <= MAX_USER_ROWS
    by_user = (lambda df: df.repartition("user_id")) if clustered else (lambda df: df)
    features = {name: [c for c in families[name].columns if c not in KEYS[name]] for name in FAMILY_ORDER}

    def packed(name: str, df: DataFrame) -> DataFrame:
        return df.select(*KEYS[name], F.struct(*features[name]).alias(f"_family_{name}"))

    def in_bucket(df: DataFrame) -> DataFrame:
        return df if bucketed is None else df.hint("shuffle_hash")

    table = by_user(candidates)
    for name in ("u", "uc", "us", "ucs"):
        table = table.join(in_bucket(packed(name, by_user(families[name]))), list(KEYS[name]), "left")
    for name in ("c", "s", "cs"):
        table = table.join(packed(name, broadcast_if_small(families[name])), list(KEYS[name]), "left")
    rest = [c for c in candidates.columns if c not in UCS]
    return table.selectExpr(
        *[f"`{c}`" for c in (*UCS, *rest)],
        *[f"_family_{name}.`{c}` AS `{c}`" for name in FAMILY_ORDER for c in features[name]],
    )


def with_differences(df: DataFrame) -> DataFrame:
    """Count in a longer range minus the count in a shorter one."""
    return df.selectExpr("*", *named({
        f"{name}_{long}_{short}_diff": f"{name}_{long} - {name}_{short}" for name, long, short in DIFFERENCES
    }))


def drop_weak(df: DataFrame) -> DataFrame:
    """Drop the columns the model does without; a name that is absent is ignored."""
    return df.drop(*WEAK_COLUMNS)


def union_windows(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Stack the sets of several windows by column name."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: everything but the keys and the label."""
    return [c for c in df.columns if c not in (*UCS, "label")]
