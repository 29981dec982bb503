"""The seven feature families: one table per key set, one row per key seen in the candidate days."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import at_least, lit, named, one_hot, total
from cartwise.operators import blocks as B
from cartwise.operators import catalog
from cartwise.operators.joins import left_lookup
from cartwise.operators.cube import daily_cube
from cartwise.operators.log import counted_log
from cartwise.operators.measures import (
    HISTORY_DAYS, ORDER_DAYS, UCS, count_days, day_words, days_in, measure_by_user, measure_triples, recent_mask, roll_up,
    roll_words, seen_in, spine,
)
from cartwise.operators.ranks import dense_rank_in_parent
from cartwise.operators.windows import WindowSpec
from cartwise.session import new_folder
from cartwise.sources.tables import Tables, materialize

UC, US, CS = ("user_id", "cate"), ("user_id", "shop_id"), ("cate", "shop_id")
KEYS = {
    "u": ("user_id",), "ucs": UCS, "c": ("cate",), "s": ("shop_id",), "uc": UC, "us": US, "cs": CS,
}
USER_RANGES = {"u": (7,), "c": (3, 5, 7), "s": (3, 5, 7)}
SEX_NAMES = {0: "female", 1: "male", -1: "unknown"}  # fixed values

MAX_USER_ROWS = 200_000  # rows of one user in a wide table, about 2 KB each, that a single task may hold
TASK_ROWS = 100_000  # rows of the cube per task: a measure row takes some 800 bytes in each hash table of the task

#: Writes a table and returns the written copy; with a number, in so many buckets by user_id.
Keep = Callable[[str, DataFrame, int | None], DataFrame]


def _as_is(name: str, df: DataFrame, by_user: int | None = None) -> DataFrame:
    return df


class Inputs:
    """What every family of one window reads: the daily cube, its measure tables and the dimensions.

    Everything is built on first use. The cube is always written, so that no family scans the log again; it may be
    given, and then serves many windows. ``keep`` may write each measure table and return the written copy, so that all
    seven families share them; the default leaves them lazy, which suits a single family. ``cart`` selects the variant
    with the cart action and without the 10-day range.

    Tables with a user in their key are clustered by user, and bucketed if kept, if no user has too many rows: their roll-ups,
    ranks and joins, and the assembly of a data set from them, shuffle nothing. The number of tasks follows the rows of the
    cube and is not left to the bytes of a shuffle, which are far fewer than those of the measures in memory.
    """

    def __init__(
        self,
        tables: Tables,
        window: WindowSpec,
        vocabulary: dict[str, Sequence],
        cart: bool = False,
        keep: Keep = _as_is,
        log: DataFrame | None = None,
        cube: DataFrame | None = None,
    ):
        self.tables, self.spec, self.vocabulary, self.cart, self.keep = tables, window, vocabulary, cart, keep
        self._log, self._cube = log, cube

    @property
    def ranges(self) -> tuple[int, ...]:
        return (1, 3, 5, 7) if self.cart else (1, 3, 5, 7, 10)

    @cached_property
    def log(self) -> DataFrame:
        return counted_log(self.tables.actions, self.tables.products) if self._log is None else self._log

    @cached_property
    def cube(self) -> DataFrame:
        if self._cube is not None:
            return self._cube
        # The days of the labels are included; features stop at the window's end.
        cube = daily_cube(self.log.where(f"action_time <= {lit(self.spec.label_end)}"))
        if self.keep is not _as_is:
            return self.keep("cube", cube, None)
        spark = cube.sparkSession
        return materialize(spark, new_folder(spark, "cube"), lambda: cube)

    @property
    def triples(self) -> DataFrame:
        """The cube's rows per triple and day, from which candidates and labels are made; clustered as the kept tables are."""
        rows = self.cube.where("by_product = 0")
        return rows if self.by_user is None else rows.repartition(self.by_user, "user_id")

    @cached_property
    def by_user(self) -> int | None:
        """Number of partitions by user of the tables with a user in their key, or None if they are not clustered by user."""
        return self.tasks if self.rows_per_user <= MAX_USER_ROWS else None

    @cached_property
    def tasks(self) -> int:
        """Number of tasks that share the rows of triples: enough that one holds about ``TASK_ROWS`` of them."""
        spark = self.cube.sparkSession
        least = (
            spark.sparkContext.defaultParallelism if self.keep is _as_is
            else int(spark.conf.get("spark.sql.shuffle.partitions"))
        )
        return max(least, -(-self._triple_rows[0] // TASK_ROWS))

    @cached_property
    def _triple_rows(self) -> tuple[int, int]:
        """Rows of the cube per triple and day, and the most of one user; a null user counts as one."""
        per_user = self.cube.where("by_product = 0").groupBy("user_id").agg(F.count("*").alias("n"))
        rows, most = per_user.agg(F.sum("n"), F.max("n")).first()
        return rows or 0, most or 0

    @cached_property
    def rows_per_user(self) -> int:
        """Upper bound on the keys of one user: its rows in the cube, or the catalogue's pairs where those are too many."""
        most = self._triple_rows[1]
        return most if most <= MAX_USER_ROWS else min(most, self.pairs)

    @cached_property
    def users(self) -> DataFrame:
        """The user table, clustered as the kept tables are."""
        if self.by_user is None:
            return self.tables.users
        return self.keep("users_bucketed", self.tables.users.repartition(self.by_user, "user_id"), self.by_user)

    @cached_property
    def ucs(self) -> DataFrame:
        return self.keep("measures_ucs", measure_triples(self.cube, self.spec, self.by_user, self.tasks), self.by_user)

    @cached_property
    def uc(self) -> DataFrame:
        return self.keep("measures_uc", self._user_pairs(UC), self.by_user)

    @cached_property
    def us(self) -> DataFrame:
        return self.keep("measures_us", self._user_pairs(US), self.by_user)

    def _user_pairs(self, keys: Sequence[str]) -> DataFrame:
        if self.by_user is None:
            return roll_up(self.ucs, self.spec, keys)
        return measure_by_user(self.cube, self.spec, keys, self.by_user)

    @cached_property
    def words(self) -> dict[str, DataFrame]:
        """Day words of (user, category), (user, shop) and user, over all days of the cube."""
        found = {
            name: self.keep(f"days_{name}", day_words(self.cube, KEYS[name], self.by_user), self.by_user) for name in ("uc", "us")
        }
        return {**found, "u": self.keep("days_u", roll_words(found["uc"], KEYS["u"]), self.by_user)}

    @cached_property
    def product_comments(self) -> DataFrame:
        """Weighted comment counts per product, from which the category and the shop family are summed."""
        return self.keep("product_comments", catalog.product_comments(self.cube, self.tables.comments, self.spec), None)

    @cached_property
    def pairs(self) -> int:
        """Upper bound on the keys one shop (or user) can have: the pairs the catalogue offers."""
        return self.tables.products.select(*CS).distinct().count()


def fit_vocabulary(users: DataFrame, max_levels: int = 1000) -> dict[str, list]:
    """Distinct values of the profile columns, sorted, to be shared by training and scoring."""
    found = {}
    for c in ("user_reg_time", "age", "sex", "city_level", "province"):
        values = [r[0] for r in users.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()]
        if len(values) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} values and cannot be one-hot encoded")
        found[c] = sorted(int(v) if isinstance(v, float) and v.is_integer() else v for v in values)
    return found


# ---- blocks over the measure tables ----------------------------------------------------------------


def user_blocks(x: Inputs) -> dict[str, B.Block]:
    return {
        "order_rhythm": B.order_rhythm(x.spec, "ac_nunique", "u_jiange_mean", "u_b2_last_day"),
        "activity": {
            "u_cate_counts": "cates",
            "u_shop_counts": "shops",
            "u_active_days_in_all": HISTORY_DAYS,
            "u_b_count_in_7": B.range_total("n", 7),
            "u_b1_count_in_7": "n1_7",
            "u_b2_count_in_7": "n2_7",
            "u_active_days_in_7": days_in(recent_mask(7)),
        },
    }


def ucs_blocks(x: Inputs) -> dict[str, B.Block]:
    rhythm = B.order_rhythm(x.spec, "ucs_ac_nunique", "ucs_jiange_mean", "ucs_b2_last_day")
    one_day = B.code_counts("ucs", "n", (1, 2, 5) if x.cart else (1, 2), [1])
    return {
        "conversion": B.conversion("", "n", "hist", "ucs_b2_rate"),
        "counts": B.range_counts("ucs", "n", x.ranges, [1] if x.cart else []),
        "type_counts": {**one_day, **B.code_counts("ucs", "n", (1, 2, 3, 4), x.ranges[1:])},
        "browse_to_order": {
            "ucs_ac_nunique": rhythm["ucs_ac_nunique"],
            **B.browse_to_order("ucs_b2_diff_day"),
        },
        "last_browse": B.last_browse(x.spec, "ucs_b1_last_min_day", "ucs_b1_last_max_day"),
        "active_days": B.active_days(x.spec, "ucs_active_days"),
        "rank_in_user": {name: name for name in B.rank_counts("ucs", x.cart)},
        "order_rhythm": rhythm,
    }


def _crowd_blocks(x: Inputs, p: str, scope: str) -> dict[str, B.Block]:
    """Blocks that categories and shops share."""
    return {
        "conversion": B.conversion(f"{p}_", "d", scope, f"{p}_b2_rate"),
        "user_counts": {f"{p}_u_count_in_{n}": f"users_{n}" for n in USER_RANGES[p]},
        "type_counts": {
            **B.code_counts(p, "d", [5 if x.cart else 1], [1]),
            **B.code_counts(p, "d", (1, 2, 3, 4), (3, 5, 7)),
        },
        "counts": B.range_counts(p, "d", (3, 5, 7)),
    }


def cate_blocks(x: Inputs) -> dict[str, B.Block]:
    return {**_crowd_blocks(x, "c", "hist"), "orders": {"c_b2_count": "n2_hist"}}


def shop_blocks(x: Inputs) -> dict[str, B.Block]:
    delay = B.BROWSE_TO_ORDER
    return {
        **_crowd_blocks(x, "s", "cand"),
        "browse_to_order": {
            "s_b_count": f"if({B.BOTH_SEEN}, d2_hist, 0L)",
            "s_b2_diff_all_day": f"if({B.BOTH_SEEN}, {delay}, 0)",
            "s_b2_diff_day": f"if({B.BOTH_SEEN}, {delay} / d2_hist, 0D)",
        },
    }


def _user_pair_blocks(x: Inputs, p: str) -> dict[str, B.Block]:
    """Blocks that (user, category) and (user, shop) share."""
    return {
        "recency": B.recency(p, x.spec, (1, 2, 5) if x.cart else (1, 2, 3)),
        "browse_to_order": {
            **B.order_days_after_browse(f"{p}_ac_nunique"),
            **B.browse_to_order(f"{p}_b2_diff_day"),
        },
        "rank_in_user": {name: name for name in B.rank_counts(p, x.cart)},
        "conversion": B.conversion(f"{p}_", "d", "hist", f"{p}_b2_rate"),
        "active_days": B.active_days(x.spec, f"{p}_active_days"),
    }


def user_cate_blocks(x: Inputs) -> dict[str, B.Block]:
    by_code = (
        {**B.code_counts("uc", "n", [5], [1]), **B.code_counts("uc", "n", (1, 2, 3, 4), (3, 5, 7))}
        if x.cart else B.code_counts("uc", "n", (1, 2, 3, 4), x.ranges)
    )
    return {
        **_user_pair_blocks(x, "uc"),
        "counts": B.range_counts("uc", "n", x.ranges[1:] if x.cart else x.ranges),
        "type_counts": by_code,
    }


def user_shop_blocks(x: Inputs) -> dict[str, B.Block]:
    cart_column = B.code_counts("us", "n", [5], [1]) if x.cart else {}
    return {
        **_user_pair_blocks(x, "us"),
        "counts": B.range_counts("us", "n", x.ranges),
        "type_counts": {**B.code_counts("us", "n", (1, 2, 3, 4), x.ranges), **cart_column},
    }


def cate_shop_blocks(x: Inputs) -> dict[str, B.Block]:
    return {
        "row_rank": {"cs_u_rank_in_s": "cs_u_rank_in_s"},
        "orders": {"cs_b2_count": "d2_hist"},
        "action_rank": {"cs_b_rank_in_s": "cs_b_rank_in_s"},
        "order_rank": {"cs_b2_rank_in_s": "cs_b2_rank_in_s"},
        "conversion": B.conversion("cs_", "d", "hist", "cs_b2_rate"),
        "active_days": B.active_days(x.spec, "cs_active_days"),
    }


# ---- measure table of each family ------------------------------------------------------------------


def _seen(*ranges: int) -> list[str]:
    return [f"count_if({seen_in(n)}) AS users_{n}" for n in ranges]


def _user_rows(x: Inputs) -> DataFrame:
    users = roll_up(x.uc, x.spec, ["user_id"], "count(*) AS cates")
    shops = x.us.groupBy("user_id").agg(F.count("*").alias("shops"))
    return spine(users).join(shops, "user_id")


def _cate_rows(x: Inputs) -> DataFrame:
    return spine(roll_up(x.uc, x.spec, ["cate"], *_seen(*USER_RANGES["c"])))


def _shop_rows(x: Inputs) -> DataFrame:
    return spine(roll_up(x.us, x.spec, ["shop_id"], *_seen(*USER_RANGES["s"])))


def _ranked(rows: DataFrame, x: Inputs, prefix: str) -> DataFrame:
    return dense_rank_in_parent(spine(rows), ["user_id"], B.rank_counts(prefix, x.cart), x.rows_per_user)


def _cate_shop_rows(x: Inputs) -> DataFrame:
    codes = (1, 2, 3, 4, 5) if x.cart else (1, 2, 3, 4)
    counts = {
        "cs_u_rank_in_s": "d_cand",
        "cs_b_rank_in_s": total(f"d{c}_cand" for c in codes),
        "cs_b2_rank_in_s": "d2_cand",
    }
    return dense_rank_in_parent(spine(roll_up(x.ucs, x.spec, CS)), ["shop_id"], counts, x.pairs)


ROWS: dict[str, Callable[[Inputs], DataFrame]] = {
    "u": _user_rows,
    "ucs": lambda x: _ranked(x.ucs, x, "ucs"),
    "c": _cate_rows,
    "s": _shop_rows,
    "uc": lambda x: _ranked(x.uc, x, "uc"),
    "us": lambda x: _ranked(x.us, x, "us"),
    "cs": _cate_shop_rows,
}
BLOCKS: dict[str, Callable[[Inputs], dict[str, B.Block]]] = {
    "u": user_blocks, "ucs": ucs_blocks, "c": cate_blocks, "s": shop_blocks,
    "uc": user_cate_blocks, "us": user_shop_blocks, "cs": cate_shop_blocks,
}


# ---- blocks that come from a dimension table -------------------------------------------------------


def user_profile(x: Inputs) -> DataFrame:
    """One-hot profile of each user; the cart variant adds two flags for a recent registration."""
    v, spec = x.vocabulary, x.spec
    columns = {
        **one_hot("user_reg_time", v["user_reg_time"], "reg_time"),
        **one_hot("age", v["age"]),
        **one_hot("sex", v["sex"], names={s: SEX_NAMES.get(s, f"sex_{s}") for s in v["sex"]}),
        **one_hot("city_level", v["city_level"]),
        **one_hot("province", v["province"]),
    }
    if x.cart:
        first, end = lit(spec.recent(7)), lit(spec.end)
        columns["reg_tm_last_day"] = f"int(user_reg_tm <=> {end})"
        columns["reg_tm_7_day"] = f"int(coalesce(user_reg_tm BETWEEN {first} AND {end}, false))"
    return x.users.selectExpr("user_id", *named(columns))


def shop_profile(x: Inputs) -> DataFrame:
    """Attributes of each shop, its opening bucket one-hot, and whether it has a score."""
    return x.tables.shops.selectExpr(
        "shop_id", "fans_num", "vip_num", "shop_score",
        *named(one_hot("shop_reg_time", (1, 2, 3, 4, 5), "shop_reg_tm")),
        *named({"or_shop_score": at_least("shop_score", 0)}),
    )


def major_cate(x: Inputs) -> DataFrame:
    """Pairs whose category is the declared main one of the shop."""
    return x.tables.shops.where("cate IS NOT NULL").selectExpr(*CS, "1 AS cs_major_cate")


def _comments(p: str) -> Callable[[Inputs], DataFrame]:
    return lambda x: catalog.comment_sums(x.product_comments, KEYS[p], p)


def _launches(p: str) -> Callable[[Inputs], DataFrame]:
    return lambda x: catalog.launch_buckets(x.tables.products, KEYS[p], p)


def _counts(p: str, **columns: str) -> Callable[[Inputs], DataFrame]:
    return lambda x: catalog.distinct_counts(x.tables.products, KEYS[p], columns)


LOOKUPS: dict[str, dict[str, Callable[[Inputs], DataFrame]]] = {
    "u": {"onehot": user_profile},
    "ucs": {},
    "c": {
        "catalog_counts": _counts("c", c_item_count="sku_id", c_brand_count="brand", c_shop_count="shop_id"),
        "new_items": _launches("c"),
        "comments": _comments("c"),
    },
    "s": {
        "catalog_counts": _counts("s", s_item_count="sku_id", s_cate_count="cate"),
        "new_items": _launches("s"),
        "comments": _comments("s"),
        "profile": shop_profile,
    },
    "uc": {},
    "us": {},
    "cs": {
        "item_count": _counts("cs", cs_item_count="sku_id"),
        "new_items": _launches("cs"),
        "major": major_cate,
    },
}


# ---- families --------------------------------------------------------------------------------------


def block(x: Inputs, family: str, name: str) -> DataFrame:
    """One block of a family: its keys and the block's columns."""
    return _build(x, family, [name])


def family(x: Inputs, name: str) -> DataFrame:
    """All blocks of a family."""
    return _build(x, name, None)


def _build(x: Inputs, name: str, only: list[str] | None) -> DataFrame:
    keys = KEYS[name]
    columns: B.Block = {}
    for block_name, exprs in BLOCKS[name](x).items():
        if only is None or block_name in only:
            columns.update(exprs)
    rows = ROWS[name](x)
    # Distinct days of the whole history, only where a wanted column uses them; triples have theirs.
    if name != "ucs" and any(days in expr for expr in columns.values() for days in (ORDER_DAYS, HISTORY_DAYS)):
        days = count_days(x.words[name], x.spec, keys)
        if "user_id" in keys and x.by_user is not None and x.keep is not _as_is:
            days = days.hint("shuffle_hash")  # four narrow columns of a bucket; no measure row is sorted
        rows = left_lookup(rows, days, keys, {ORDER_DAYS: 0, HISTORY_DAYS: 0})
    table = rows.selectExpr(*keys, *named(columns))
    for block_name, lookup in LOOKUPS[name].items():
        if only is None or block_name in only:
            side = lookup(x)
            added = [c for c in side.columns if c not in keys]
            table = left_lookup(table, side, keys, {c: 0 for c in added})
    return table


def all_families(x: Inputs, parallel: int = 3) -> dict[str, DataFrame]:
    """All seven families, ready to be joined onto candidates.

    The category and shop families are small and go through ``keep``, side by side, so that their size can
    be measured. The user families stay lazy: their measure tables are clustered by user_id, and their ranks and the joins
    that follow use that clustering, so their wide rows are neither written nor shuffled again.
    """
    small = ("c", "s", "cs")
    x.tables.products, x.tables.shops, x.by_user, x.cube  # shared, so they are built before any thread asks for them
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(lambda build: build(), (lambda: x.ucs, lambda: x.words, lambda: x.users, lambda: x.product_comments)))
        list(pool.map(lambda build: build(), (lambda: x.uc, lambda: x.us)))
        kept = dict(zip(small, pool.map(lambda name: x.keep(f"features_{name}", family(x, name), None), small)))
    return {name: kept[name] if name in small else family(x, name) for name in KEYS}
