"""The registered queries as SQL, written block by block over the plain log.

Deliberately naive: every block filters the log, groups it and is joined back onto the keys of the
candidate days. Nothing here shares the measure tables or day sets of the library.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from checks.spark_queries import BLOCK_KEYS, CART_BLOCKS, SWEEP
from cartwise.sources import fixtures as X

# Thresholds, differences and dropped columns, stated again so that a wrong one in the library is seen: fixed values.
THRESHOLDS = {"1": 0.076, "2": 0.057, "3": 0.076, "a": 0.083, "23": 0.073}
DIFFERENCES = (
    ("ucs_b1_count_in", 5, 1), ("ucs_b1_count_in", 7, 3), ("ucs_b2_count_in", 5, 1), ("c_b_count_in", 7, 3),
    ("us_b4_count_in", 5, 1), ("us_b3_count_in", 5, 1), ("us_b4_count_in", 7, 3), ("us_b3_count_in", 7, 3),
)
WEAK_COLUMNS = """
    c_b_count_in_3 c_b_count_in_5 c_b_count_in_7 city_level_2 city_level_6 cs_major_cate or_shop_score
    province_2 province_3 province_4 province_9 province_12 province_13 province_17 province_18 province_24 province_25
    reg_time_4 shop_reg_tm_5 ucs_b2_count_in_1 ucs_b3_count_in_3 ucs_b3_count_in_5 ucs_b3_count_in_7
    ucs_b4_count_in_3 ucs_b4_count_in_5 ucs_b4_count_in_7 unknown us_b3_count_in_1 us_b3_count_in_5
    us_b4_count_in_1 us_b4_count_in_7
""".split()
FAMILY_ORDER = ("u", "ucs", "c", "s", "uc", "us", "cs")

KEYS = {
    "u": ["user_id"], "ucs": ["user_id", "cate", "shop_id"], "c": ["cate"], "s": ["shop_id"],
    "uc": ["user_id", "cate"], "us": ["user_id", "shop_id"], "cs": ["cate", "shop_id"],
}
UCS = "user_id, cate, shop_id"


def _day(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _bucket(column: str, bounds: list[dt.date], open_start: bool = True) -> str:
    bounds = sorted(bounds)
    k = len(bounds)
    parts = [f"WHEN {column} < {_day(bounds[0])} THEN {k + 1 if open_start else 'NULL'}"]
    parts += [f"WHEN {column} < {_day(b)} THEN {k + 1 - i}" for i, b in enumerate(bounds) if i]
    return f"CAST(CASE {' '.join(parts)} WHEN {column} IS NOT NULL THEN 1 END AS INTEGER)"


def _mode(table: str, column: str) -> str:
    return (
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


TABLES = f"""
action AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id, CAST(ts AS DATE) AS action_time,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3
                              WHEN 'error' THEN 4 WHEN 'click' THEN 5 END AS INTEGER) AS type
  FROM events),
product_raw AS (
  SELECT p_partkey AS sku_id, p_brand AS brand, shop_id, p_type AS cate,
         CASE WHEN p_partkey % 23 <> 0 THEN launch END AS market_time
  FROM part LEFT JOIN (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS launch,
                              arg_min(l_suppkey, l_orderkey * 100 + l_linenumber) AS shop_id
                       FROM lineitem GROUP BY l_partkey)
       ON l_partkey = p_partkey),
product AS (
  SELECT sku_id, brand, shop_id, cate, market_time, {_bucket('market_time', X.MARKET_BOUNDS)} AS market_tm
  FROM (SELECT * REPLACE (coalesce(market_time, {_mode('product_raw', 'market_time')}) AS market_time)
        FROM product_raw)),
users_raw AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 17 <> 0 THEN CAST(floor(c_acctbal / 2000) AS INTEGER) END AS age,
         CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 3 - 1 AS INTEGER) END AS sex,
         c_mktsegment AS city_level,
         CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS province,
         CASE WHEN c_custkey % 19 <> 0 THEN first_order END AS user_reg_tm
  FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order
                           FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey),
users AS (
  SELECT *, {_bucket('user_reg_tm', X.USER_REG_BOUNDS)} AS user_reg_time FROM (
    SELECT user_id, CAST(coalesce(age, (SELECT median(age) FROM users_raw)) AS DOUBLE) AS age,
           coalesce(sex, {_mode('users_raw', 'sex')}) AS sex,
           coalesce(city_level, {_mode('users_raw', 'city_level')}) AS city_level,
           coalesce(province, {_mode('users_raw', 'province')}) AS province,
           coalesce(user_reg_tm, {_mode('users_raw', 'user_reg_tm')}) AS user_reg_tm
    FROM users_raw)),
shop_raw AS (
  SELECT s_suppkey AS shop_id, CASE WHEN s_suppkey % 10 <> 9 THEN p_type END AS cate,
         CAST(s_nationkey AS BIGINT) AS fans_num, CAST(s_nationkey % 7 AS BIGINT) AS vip_num,
         CASE WHEN s_suppkey % 4 <> 3 THEN s_acctbal / 1000 END AS shop_score,
         CASE WHEN s_suppkey % 10 <> 6 THEN opened END AS shop_reg_tm
  FROM supplier
  LEFT JOIN (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS opened FROM lineitem GROUP BY l_suppkey)
       ON l_suppkey = s_suppkey
  LEFT JOIN part ON p_partkey = s_suppkey),
shop AS (
  SELECT *, {_bucket('shop_reg_tm', X.SHOP_REG_BOUNDS, False)} AS shop_reg_time
  FROM (SELECT * REPLACE (coalesce(shop_reg_tm, {_mode('shop_raw', 'shop_reg_tm')}) AS shop_reg_tm) FROM shop_raw)),
comment AS (
  SELECT action_day AS dt, sku_id, count(*) AS comments, count(*) FILTER (WHERE value >= 50) AS good_comments,
         count(*) FILTER (WHERE value < 5) AS bad_comments
  FROM (SELECT CAST(ts AS DATE) AS action_day, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id, value
        FROM events) GROUP BY action_day, sku_id)"""

LOG = "SELECT user_id, sku_id, action_time, type, cate, shop_id FROM action JOIN product USING (sku_id)"
ORDER_LOG = """SELECT o_custkey AS user_id, l_partkey AS sku_id, CAST(o_orderdate AS DATE) AS action_time,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 2 WHEN l_linestatus = 'F' THEN 3
                   ELSE 4 END AS INTEGER) AS type,
         p_type AS cate, l_suppkey AS shop_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""


def query(body: str, more: str = "", log: str = LOG) -> str:
    return f"WITH {TABLES},\nlog AS ({log}){more}\n{body}"


@dataclass
class Block:
    """A sub-select with its keys and columns, and what a missing key gets."""

    sql: str
    defaults: dict[str, str]
    doubles: set[str] = field(default_factory=set)


class Window:
    """Blocks of one window, as SQL."""

    def __init__(self, spec, cart: bool = False):
        self.spec, self.cart = spec, cart
        self.end, self.start = _day(spec.end), _day(spec.start)
        self.label_start, self.label_end = _day(spec.label_start), _day(spec.label_end)
        self.ranges = (1, 3, 5, 7) if cart else (1, 3, 5, 7, 10)
        self.blocks = {f: self._family(f) for f in KEYS}

    def rows(self, scope: str, distinct: bool) -> str:
        where = f"action_time <= {self.end}"
        if scope == "cand":
            where += f" AND action_time >= {self.start}"
        elif scope != "hist":
            where += f" AND action_time >= {_day(self.spec.recent(int(scope)))}"
        return f"(SELECT {'DISTINCT ' if distinct else ''}* FROM log WHERE {where})"

    def spine(self, f: str) -> str:
        return f"(SELECT DISTINCT {', '.join(KEYS[f])} FROM {self.rows('cand', False)})"

    # -- primitives --

    def conversion(self, f: str, p: str, rate: str, scope: str, distinct: bool) -> Block:
        k = ", ".join(KEYS[f])
        n = {c: f"count(*) FILTER (WHERE type = {c})" for c in (1, 2, 3, 4)}
        sql = f"""SELECT {k},
          ln(1 + n2) - ln(1 + n1) AS {p}type_1_ratio, ln(1 + n2) - ln(1 + n3) AS {p}type_3_ratio,
          ln(1 + n4) - ln(1 + n2) AS {p}type_2_ratio,
          n2 / CASE WHEN n1 + n2 + n3 + n4 = 0 THEN 1 ELSE n1 + n2 + n3 + n4 END AS {rate}
          FROM (SELECT {k}, {', '.join(f'{e} AS n{c}' for c, e in n.items())}
                FROM {self.rows(scope, distinct)} GROUP BY {k})"""
        names = [f"{p}type_1_ratio", f"{p}type_3_ratio", f"{p}type_2_ratio", rate]
        return Block(sql, {c: "0" for c in names}, set(names))

    def counts(self, f: str, columns: dict[str, tuple[str, tuple[int, ...]]], distinct: bool) -> Block:
        """columns: name -> (range, codes); one filtered sub-select per range."""
        k = KEYS[f]
        by_range: dict[str, list[str]] = {}
        for name, (scope, codes) in columns.items():
            by_range.setdefault(scope, []).append(
                f"count(*) FILTER (WHERE type IN ({', '.join(map(str, codes))})) AS {name}"
            )
        source = self.spine(f)
        for scope, exprs in by_range.items():
            part = f"(SELECT {', '.join(k)}, {', '.join(exprs)} FROM {self.rows(scope, distinct)} GROUP BY {', '.join(k)})"
            source = f"{source} LEFT JOIN {part} USING ({', '.join(k)})"
        cols = ", ".join(f"coalesce({c}, 0) AS {c}" for c in columns)
        return Block(f"SELECT {', '.join(k)}, {cols} FROM {source}", {c: "0" for c in columns})

    def type_counts(self, f: str, plan: list[tuple[int, tuple[int, ...]]], distinct: bool) -> Block:
        return self.counts(
            f, {f"{f}_b{c}_count_in_{n}": (str(n), (c,)) for n, codes in plan for c in codes}, distinct
        )

    def range_counts(self, f: str, ranges, distinct: bool, cart_ranges=()) -> Block:
        return self.counts(
            f,
            {f"{f}_b_count_in_{n}": (str(n), (1, 2, 3, 4, 5) if n in cart_ranges else (1, 2, 3, 4)) for n in ranges},
            distinct,
        )

    def rhythm(self, f: str, days: str, gap: str, last: str) -> Block:
        k = ", ".join(KEYS[f])
        sql = f"""SELECT {k}, {days}, coalesce(CASE WHEN {days} >= 2 THEN mean_gap END, 60) AS {gap},
          CAST({self.label_start} - last_day AS INTEGER) AS {last}_start,
          CAST({self.label_end} - last_day AS INTEGER) AS {last}_end
          FROM (SELECT {k}, count(DISTINCT action_time) AS {days}, avg(gap) AS mean_gap, max(action_time) AS last_day
                FROM (SELECT {k}, action_time,
                             action_time - lag(action_time) OVER (PARTITION BY {k} ORDER BY action_time) AS gap
                      FROM {self.rows('hist', False)} WHERE type = 2) GROUP BY {k})"""
        return Block(sql, {days: "0", gap: "60", f"{last}_start": "75", f"{last}_end": "75"}, {gap})

    def diff(self, f: str, days: str, name: str, both: bool = True) -> Block:
        k = ", ".join(KEYS[f])
        sql = f"""SELECT {k}, {days}, (last_order - first_browse) / order_days AS {name} FROM (
          SELECT {k}, order_days, {'CASE WHEN first_browse IS NOT NULL THEN order_days END' if both else 'order_days'} AS {days},
                 last_order, first_browse
          FROM (SELECT {k}, max(action_time) AS last_order, count(DISTINCT action_time) AS order_days
                FROM {self.rows('hist', False)} WHERE type = 2 GROUP BY {k})
          LEFT JOIN (SELECT {k}, min(action_time) AS first_browse
                FROM {self.rows('hist', False)} WHERE type = 1 GROUP BY {k}) USING ({k}))"""
        return Block(sql, {days: "0", name: "60"}, {name})

    def recency(self, f: str, columns: dict[str, tuple[int, str]]) -> Block:
        k = ", ".join(KEYS[f])
        cols = ", ".join(
            f"CAST({day} - max(action_time) FILTER (WHERE type = {code}) AS INTEGER) AS {name}"
            for name, (code, day) in columns.items()
        )
        return Block(
            f"SELECT {k}, {cols} FROM {self.rows('cand', False)} GROUP BY {k}", {c: "60" for c in columns}
        )

    def active(self, f: str) -> Block:
        k = ", ".join(KEYS[f])
        name = f"{f}_active_days"
        return Block(
            f"SELECT {k}, count(DISTINCT action_time) AS {name} FROM {self.rows('cand', False)} GROUP BY {k}",
            {name: "0"},
        )

    def ranks(self, f: str) -> Block:
        k = KEYS[f]
        source, names = self.spine(f), []
        for n in (1, 3, 5, 7):
            codes = "1, 2, 3, 4, 5" if self.cart and n == 1 else "1, 2, 3, 4"
            name = f"{f}_b_count_rank_in_{n}_in_u"
            names.append(name)
            part = f"""(SELECT {', '.join(k)}, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY total DESC) AS INTEGER) AS {name}
              FROM (SELECT {', '.join(k)}, count(*) FILTER (WHERE type IN ({codes})) AS total
                    FROM {self.rows(str(n), False)} GROUP BY {', '.join(k)}))"""
            source = f"{source} LEFT JOIN {part} USING ({', '.join(k)})"
        cols = ", ".join(f"coalesce({c}, 1000) AS {c}" for c in names)
        return Block(f"SELECT {', '.join(k)}, {cols} FROM {source}", {c: "1000" for c in names})

    def rank_in_shop(self, name: str, condition: str) -> Block:
        sql = f"""SELECT cate, shop_id, CAST(dense_rank() OVER (PARTITION BY shop_id ORDER BY total DESC) AS INTEGER) AS {name}
          FROM (SELECT cate, shop_id, count(*) FILTER (WHERE {condition}) AS total
                FROM {self.rows('cand', True)} GROUP BY cate, shop_id)"""
        return Block(sql, {name: "1000"})

    def catalog(self, f: str, columns: dict[str, str]) -> Block:
        k = ", ".join(KEYS[f])
        cols = ", ".join(f"count(DISTINCT {c}) AS {name}" for name, c in columns.items())
        return Block(f"SELECT {k}, {cols} FROM product GROUP BY {k}", {c: "0" for c in columns})

    def launches(self, f: str) -> Block:
        k = ", ".join(KEYS[f])
        names = {f"{f}_market_tm_{b}": b for b in range(1, 7)}
        cols = ", ".join(f"count(*) FILTER (WHERE market_tm = {b}) AS {name}" for name, b in names.items())
        return Block(f"SELECT {k}, {cols} FROM product GROUP BY {k}", {c: "0" for c in names})

    def users(self, f: str) -> Block:
        k = KEYS[f]
        source, names = self.spine(f), []
        for n in (3, 5, 7):
            name = f"{f}_u_count_in_{n}"
            names.append(name)
            part = f"(SELECT {k[0]}, count(DISTINCT user_id) AS {name} FROM {self.rows(str(n), False)} GROUP BY {k[0]})"
            source = f"{source} LEFT JOIN {part} USING ({k[0]})"
        cols = ", ".join(f"coalesce({c}, 0) AS {c}" for c in names)
        return Block(f"SELECT {k[0]}, {cols} FROM {source}", {c: "0" for c in names})

    def comments(self, f: str) -> Block:
        k = KEYS[f][0]
        names = ["comments", "good_comments", "bad_comments"]
        inner = ", ".join(f"sum({c}) AS {c}" for c in names)
        cols = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {f}_{c}" for c in names)
        sql = f"""SELECT {k}, {cols} FROM {self.rows('hist', False)} LEFT JOIN
          (SELECT sku_id, {inner} FROM comment WHERE dt BETWEEN {self.start} AND {self.end} GROUP BY sku_id)
          USING (sku_id) GROUP BY {k}"""
        return Block(sql, {f"{f}_{c}": "0" for c in names})

    def profile(self) -> Block:
        v = X.USER_VOCABULARY
        sex = {0: "female", 1: "male", -1: "unknown"}
        cols = {f"reg_time_{x}": f"user_reg_time = {x}" for x in v["user_reg_time"]}
        cols |= {f"age_{x}": f"age = {x}" for x in v["age"]}
        cols |= {sex[x]: f"sex = {x}" for x in v["sex"]}
        cols |= {f"city_level_{x}": f"city_level = '{x}'" for x in v["city_level"]}
        cols |= {f"province_{x}": f"province = {x}" for x in v["province"]}
        if self.cart:
            cols["reg_tm_last_day"] = f"user_reg_tm = {self.end}"
            cols["reg_tm_7_day"] = f"user_reg_tm BETWEEN {_day(self.spec.recent(7))} AND {self.end}"
        exprs = ", ".join(f'CASE WHEN {e} THEN 1 ELSE 0 END AS "{name}"' for name, e in cols.items())
        return Block(f"SELECT user_id, {exprs} FROM users", {c: "0" for c in cols})

    def activity(self) -> Block:
        sql = f"""SELECT user_id, u_cate_counts, u_shop_counts, u_active_days_in_all,
            coalesce(b, 0) AS u_b_count_in_7, coalesce(b1, 0) AS u_b1_count_in_7, coalesce(b2, 0) AS u_b2_count_in_7,
            coalesce(days, 0) AS u_active_days_in_7
          FROM (SELECT user_id, count(DISTINCT cate) AS u_cate_counts, count(DISTINCT shop_id) AS u_shop_counts,
                       count(DISTINCT action_time) AS u_active_days_in_all
                FROM {self.rows('hist', False)} GROUP BY user_id)
          LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE type <= 4) AS b, count(*) FILTER (WHERE type = 1) AS b1,
                            count(*) FILTER (WHERE type = 2) AS b2, count(DISTINCT action_time) AS days
                     FROM {self.rows('7', False)} GROUP BY user_id) USING (user_id)"""
        names = [
            "u_cate_counts", "u_shop_counts", "u_active_days_in_all", "u_b_count_in_7", "u_b1_count_in_7",
            "u_b2_count_in_7", "u_active_days_in_7",
        ]
        return Block(sql, {c: "0" for c in names})

    def shop_delay(self) -> Block:
        sql = f"""SELECT shop_id, s_b_count, CAST(last_order - first_browse AS INTEGER) AS s_b2_diff_all_day,
            (last_order - first_browse) / s_b_count AS s_b2_diff_day
          FROM (SELECT shop_id, count(*) AS s_b_count, max(action_time) AS last_order
                FROM {self.rows('hist', True)} WHERE type = 2 GROUP BY shop_id)
          JOIN (SELECT shop_id, min(action_time) AS first_browse
                FROM {self.rows('hist', True)} WHERE type = 1 GROUP BY shop_id) USING (shop_id)"""
        return Block(
            sql, {"s_b_count": "0", "s_b2_diff_all_day": "0", "s_b2_diff_day": "0"}, {"s_b2_diff_day"}
        )

    def shop_profile(self) -> Block:
        flags = ", ".join(
            f"CASE WHEN shop_reg_time = {b} THEN 1 ELSE 0 END AS shop_reg_tm_{b}" for b in range(1, 6)
        )
        sql = f"""SELECT shop_id, fans_num, vip_num, shop_score, {flags},
            CASE WHEN shop_score >= 0 THEN 1 ELSE 0 END AS or_shop_score FROM shop"""
        names = ["fans_num", "vip_num", "shop_score", *[f"shop_reg_tm_{b}" for b in range(1, 6)], "or_shop_score"]
        return Block(sql, {c: "0" for c in names}, {"shop_score"})

    def order_rows(self, f: str, name: str, distinct: bool) -> Block:
        return self.counts(f, {name: ("hist", (2,))}, distinct)

    # -- families --

    def _family(self, f: str) -> dict[str, Block]:
        r, cart, later = self.ranges, self.cart, self.ranges[1:]
        four = (1, 2, 3, 4)
        if f == "u":
            return {
                "order_rhythm": self.rhythm("u", "ac_nunique", "u_jiange_mean", "u_b2_last_day"),
                "activity": self.activity(),
                "onehot": self.profile(),
            }
        if f == "ucs":
            return {
                "conversion": self.conversion("ucs", "", "ucs_b2_rate", "hist", False),
                "counts": self.range_counts("ucs", r, False, [1] if cart else []),
                "type_counts": self.type_counts(
                    "ucs", [(1, (1, 2, 5) if cart else (1, 2)), *[(n, four) for n in later]], False
                ),
                "browse_to_order": self.diff("ucs", "ucs_ac_nunique", "ucs_b2_diff_day", both=False),
                "last_browse": self.recency(
                    "ucs",
                    {"ucs_b1_last_min_day": (1, self.label_start), "ucs_b1_last_max_day": (1, self.label_end)},
                ),
                "active_days": self.active("ucs"),
                "rank_in_user": self.ranks("ucs"),
                "order_rhythm": self.rhythm("ucs", "ucs_ac_nunique", "ucs_jiange_mean", "ucs_b2_last_day"),
            }
        if f in ("c", "s"):
            shared = {
                "conversion": self.conversion(f, f"{f}_", f"{f}_b2_rate", "hist" if f == "c" else "cand", True),
                "user_counts": self.users(f),
                "type_counts": self.type_counts(f, [(1, (5,) if cart else (1,)), *[(n, four) for n in (3, 5, 7)]], True),
                "counts": self.range_counts(f, (3, 5, 7), True),
                "new_items": self.launches(f),
                "comments": self.comments(f),
            }
            if f == "c":
                return {
                    **shared,
                    "orders": self.order_rows("c", "c_b2_count", False),
                    "catalog_counts": self.catalog(
                        "c", {"c_item_count": "sku_id", "c_brand_count": "brand", "c_shop_count": "shop_id"}
                    ),
                }
            return {
                **shared,
                "browse_to_order": self.shop_delay(),
                "catalog_counts": self.catalog("s", {"s_item_count": "sku_id", "s_cate_count": "cate"}),
                "profile": self.shop_profile(),
            }
        if f in ("uc", "us"):
            codes = (1, 2, 5) if cart else (1, 2, 3)
            if not cart:
                plan = [(n, four) for n in r]
            elif f == "uc":
                plan = [(1, (5,)), *[(n, four) for n in later]]
            else:
                plan = [(1, (1, 2, 3, 4, 5)), *[(n, four) for n in later]]
            return {
                "recency": self.recency(f, {f"{f}_b{c}_last_day": (c, self.label_start) for c in codes}),
                "browse_to_order": self.diff(f, f"{f}_ac_nunique", f"{f}_b2_diff_day"),
                "rank_in_user": self.ranks(f),
                "conversion": self.conversion(f, f"{f}_", f"{f}_b2_rate", "hist", True),
                "active_days": self.active(f),
                "counts": self.range_counts(f, later if cart and f == "uc" else r, False),
                "type_counts": self.type_counts(f, plan, False),
            }
        codes = "1, 2, 3, 4, 5" if cart else "1, 2, 3, 4"
        return {
            "row_rank": self.rank_in_shop("cs_u_rank_in_s", "true"),
            "orders": self.order_rows("cs", "cs_b2_count", True),
            "action_rank": self.rank_in_shop("cs_b_rank_in_s", f"type IN ({codes})"),
            "order_rank": self.rank_in_shop("cs_b2_rank_in_s", "type = 2"),
            "conversion": self.conversion("cs", "cs_", "cs_b2_rate", "hist", True),
            "active_days": self.active("cs"),
            "item_count": self.catalog("cs", {"cs_item_count": "sku_id"}),
            "new_items": self.launches("cs"),
            "major": Block(
                "SELECT cate, shop_id, 1 AS cs_major_cate FROM shop WHERE cate IS NOT NULL", {"cs_major_cate": "0"}
            ),
        }

    # -- statements --

    def family(self, f: str, only: list[str] | None = None) -> tuple[str, dict[str, bool]]:
        """Sub-select of a family, and its columns with whether they are doubles."""
        k = ", ".join(KEYS[f])
        source, exprs, columns = self.spine(f), [], {}
        for name, block in self.blocks[f].items():
            if only is not None and name not in only:
                continue
            fresh = [c for c in block.defaults if c not in columns]
            alias = f"b_{name}"
            quoted = ", ".join(f'"{c}"' for c in fresh)
            source += f"\n LEFT JOIN (SELECT {k}, {quoted} FROM ({block.sql})) AS {alias} USING ({k})"
            for c in fresh:
                value = f'coalesce({alias}."{c}", {block.defaults[c]})'
                if c in block.doubles:
                    value = f"round(CAST({value} AS DOUBLE), 9)"
                exprs.append(f'{value} AS "{c}"')
                columns[c] = c in block.doubles
        return f"SELECT {k}, {', '.join(exprs)} FROM {source}", columns

    def labelled(self) -> str:
        return f"""SELECT {UCS}, CAST(coalesce(bought, 0) AS INTEGER) AS label FROM {self.spine('ucs')}
          LEFT JOIN (SELECT DISTINCT {UCS}, 1 AS bought FROM log
                     WHERE type = 2 AND action_time BETWEEN {self.label_start} AND {self.label_end}) USING ({UCS})"""

    def dataset(self, labelled: bool) -> tuple[str, list[str]]:
        """Sub-select of the assembled set, and its feature columns in order."""
        source = f"({self.labelled() if labelled else 'SELECT * FROM ' + self.spine('ucs')}) AS base"
        names: list[str] = []
        for f in FAMILY_ORDER:
            sql, columns = self.family(f)
            source += f"\nLEFT JOIN ({sql}) AS f_{f} USING ({', '.join(KEYS[f])})"
            names += columns
        head = f"{UCS}, label" if labelled else UCS
        quoted = ", ".join(f'"{c}"' for c in names)
        return f"SELECT {head}, {quoted} FROM {source}", names


W3 = X.WINDOWS["w3"]


def _score_ctes() -> str:
    """The deterministic scores, as relations score_1, score_2, score_3, score_a and score_23."""
    sql, _ = Window(W3).family("ucs", ["counts", "type_counts", "active_days"])
    probs = {
        "1": "ucs_b2_count_in_7 / (1 + ucs_b_count_in_7)",
        "2": "ucs_b1_count_in_10 / (4 + ucs_b_count_in_10 * 2)",
        "3": "(ucs_b1_count_in_3 + ucs_b2_count_in_3) / (1 + ucs_b_count_in_10)",
        "a": "ucs_active_days / 20",
        "23": "ucs_b_count_in_5 / (10 + ucs_b_count_in_10)",
    }
    ctes = f",\nucs_counts AS ({sql})"
    for m, p in probs.items():
        ctes += f",\nscore_{m} AS (SELECT {UCS}, {p} AS prob FROM ucs_counts)"
    return ctes


def _majority() -> str:
    votes = " + ".join(
        f"CASE WHEN s{m}.prob >= {t} THEN 1 ELSE 0 END" for m, t in THRESHOLDS.items()
    )
    names = list(THRESHOLDS)
    joins = f"score_{names[0]} AS s{names[0]} " + " ".join(
        f"JOIN score_{m} AS s{m} USING ({UCS})" for m in names[1:]
    )
    return f"SELECT {UCS} FROM {joins} WHERE {votes} >= 3"


def _bought(spec) -> str:
    return (
        f"SELECT DISTINCT {UCS} FROM log WHERE type = 2 "
        f"AND action_time BETWEEN {_day(spec.label_start)} AND {_day(spec.label_end)}"
    )


def _level(keys: str, name: str) -> str:
    return f"""{name} AS (
      SELECT (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM chosen)) AS predicted,
             (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM bought)) AS actual,
             (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM chosen) JOIN (SELECT DISTINCT {keys} FROM bought)
                                   USING ({keys})) AS hits),
    {name}_pr AS (SELECT *, hits / greatest(predicted, 1) AS p, hits / greatest(actual, 1) AS r FROM {name}),
    {name}_f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM {name}_pr)"""


def plain() -> dict[str, str]:
    """Queries outside the feature families."""
    w3, test = Window(W3), Window(X.WINDOWS["test"])
    out: dict[str, str] = {}
    out["src_csv_roundtrip"] = query("SELECT * FROM action")
    out["src_materialize_reuse"] = query(f"SELECT * FROM {test.spine('ucs')}")
    out["clean_day_truncate"] = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"
    out["clean_impute_mode"] = query("SELECT user_id, user_reg_tm, sex, city_level, province FROM users")
    out["clean_impute_median"] = query("SELECT user_id, age FROM users")
    out["clean_bucket_user_reg"] = query("SELECT user_id, user_reg_tm, user_reg_time FROM users")
    out["clean_bucket_shop_reg"] = query("SELECT shop_id, shop_reg_tm, shop_reg_time FROM shop")
    out["clean_bucket_market"] = query("SELECT sku_id, market_time, market_tm FROM product")
    out["clean_null_profile"] = query(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS filled FROM users_raw"
        for c in ("user_id", "age", "sex", "city_level", "province", "user_reg_tm")
    ))
    out["flt_candidate_window"] = query(
        f"SELECT * FROM action WHERE action_time >= {w3.start} AND action_time <= {w3.end}"
    )
    out["join_action_product"] = query("SELECT * FROM log")
    out["join_left_fill_default"] = query(f"""
      SELECT user_id, coalesce(orders, 0) AS orders, coalesce(days_ago, 75) AS days_ago
      FROM (SELECT DISTINCT user_id FROM action)
      LEFT JOIN (SELECT user_id, count(*) AS orders, CAST({w3.label_start} - max(action_time) AS INTEGER) AS days_ago
                 FROM action WHERE type = 2 GROUP BY user_id) USING (user_id)""")
    out["agg_group_count"] = query('SELECT cate, shop_id, count(*) AS "rows" FROM log GROUP BY cate, shop_id')
    out["agg_group_sum"] = query("""
      SELECT sku_id, CAST(sum(comments) AS BIGINT) AS comments, CAST(sum(good_comments) AS BIGINT) AS good_comments,
             CAST(sum(bad_comments) AS BIGINT) AS bad_comments FROM comment GROUP BY sku_id""")
    cells = ", ".join(
        f"count(*) FILTER (WHERE type = {c} AND action_time >= {_day(W3.recent(n))}) AS n{c}_{n}"
        for n in (1, 3, 5, 7, 10) for c in (1, 2, 3, 4)
    )
    out["agg_windowed_counts"] = query(f"SELECT {UCS}, {cells} FROM log WHERE action_time <= {w3.end} GROUP BY {UCS}")
    out["agg_distinct_counts"] = query("""
      SELECT user_id, count(DISTINCT cate) AS cates, count(DISTINCT shop_id) AS shops,
             count(DISTINCT action_time) AS days FROM log GROUP BY user_id""")
    out["agg_distinct_keys"] = query("SELECT DISTINCT user_id, cate FROM log")
    out["agg_log_dedup"] = query("SELECT *, count(*) AS n FROM log GROUP BY ALL")
    out["win_dense_rank_in_parent"] = query("""
      SELECT shop_id, cate, "rows", CAST(dense_rank() OVER (PARTITION BY shop_id ORDER BY "rows" DESC) AS INTEGER) AS "rank"
      FROM (SELECT shop_id, cate, count(*) AS "rows" FROM log GROUP BY shop_id, cate)""")
    out["win_order_gap_lag"] = query("""
      SELECT user_id, CAST(sum(gap) AS BIGINT) AS gap_days, count(gap) AS gaps FROM (
        SELECT user_id, action_time - lag(action_time) OVER (PARTITION BY user_id ORDER BY action_time) AS gap
        FROM log WHERE type = 2)
      GROUP BY user_id HAVING count(*) > 1 AND sum(gap) > 0""")
    out["win_latest_per_key"] = query("""
      SELECT user_id, cate, action_time, sku_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, cate ORDER BY action_time DESC, sku_id DESC) AS rn
        FROM log WHERE type = 2) WHERE rn = 1""")
    per_user = ", ".join(f"count(*) FILTER (WHERE type = {c}) AS b{c}" for c in (1, 2, 3, 4, 5))
    types = f"(SELECT user_id, {per_user} FROM action GROUP BY user_id)"
    out["pivot_action_type"] = query(f"SELECT * FROM {types}")
    out["sc_log_ratio"] = query(f"SELECT user_id, round(ln(1 + b2) - ln(1 + b1), 9) AS log_ratio FROM {types}")
    out["sc_safe_rate"] = query(
        f"SELECT user_id, round(b2 / CASE WHEN b1 + b2 = 0 THEN 1 ELSE b1 + b2 END, 9) AS rate FROM {types}"
    )
    out["sc_day_diff"] = query(f"""
      SELECT user_id, sku_id, action_time, CAST({w3.label_start} - action_time AS INTEGER) AS days FROM action""")
    out["label_train_set"] = query(w3.labelled())
    out["label_test_set"] = query(f"SELECT * FROM {test.spine('ucs')}")
    out["model_train"] = query(f"SELECT label, count(*) AS triples, true AS scored, true AS learned FROM ({w3.labelled()}) GROUP BY label")
    out["model_score"] = query(f"SELECT {UCS}, true AS scored, true AS differ, true AS learned FROM {test.spine('ucs')}")
    out["model_reload"] = query(f"SELECT {UCS}, true AS same FROM {test.spine('ucs')}")
    out["model_importance"] = "SELECT true AS few, true AS in_order, true AS shares, true AS whole, true AS learned"
    out["model_gain_shares"] = """
      SELECT p_brand || ' ' || p_type AS feature,
             round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem JOIN part ON p_partkey = l_partkey), 9) AS fscore
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY feature ORDER BY fscore DESC, feature LIMIT 20"""
    parts = [
        f"SELECT '{name}' AS \"window\", {UCS}, label FROM ({Window(spec).labelled()})"
        for name, spec in X.WINDOWS.items() if name != "test"
    ]
    parts.append(f"SELECT 'test' AS \"window\", {UCS}, CAST(NULL AS INTEGER) AS label FROM {test.spine('ucs')}")
    out["label_all_windows"] = query(" UNION ALL ".join(parts))
    reg = X.REGISTRATION_WINDOW
    out["feat_u_reg_recency"] = query(f"""
      SELECT user_id, CASE WHEN user_reg_tm = {_day(reg.end)} THEN 1 ELSE 0 END AS reg_tm_last_day,
             CASE WHEN user_reg_tm BETWEEN {_day(reg.recent(7))} AND {_day(reg.end)} THEN 1 ELSE 0 END AS reg_tm_7_day
      FROM users""")

    scores = _score_ctes()
    out["vote_threshold"] = query(
        f"SELECT {UCS}, round(prob, 9) AS prob, CASE WHEN prob >= {THRESHOLDS['1']} THEN 1 ELSE 0 END AS label FROM score_1",
        scores,
    )
    out["vote_majority"] = query(_majority(), scores)
    out["eval_two_level"] = query(
        """SELECT c.predicted AS cate_predicted, c.actual AS cate_actual, c.hits AS cate_hits,
                  s.predicted AS shop_predicted, s.actual AS shop_actual, s.hits AS shop_hits,
                  round(c.p, 9) AS cate_precision, round(c.r, 9) AS cate_recall, round(c.f1, 9) AS cate_f1,
                  round(s.p, 9) AS shop_precision, round(s.r, 9) AS shop_recall, round(s.f1, 9) AS shop_f1,
                  round(0.5 * c.f1 + 0.5 * s.f1, 9) AS score
           FROM lv_cate_f AS c, lv_shop_f AS s""",
        scores + f",\nchosen AS ({_majority()}),\nbought AS ({_bought(W3)}),\n"
        + _level("user_id, cate", "lv_cate") + ",\n" + _level(UCS, "lv_shop"),
    )
    bounds = ", ".join(f"({b}::DOUBLE)" for b in SWEEP)
    out["eval_threshold_sweep"] = query(
        """SELECT threshold, predicted, hits, actual, round(p, 9) AS "precision", round(r, 9) AS recall,
                  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1
           FROM (SELECT *, hits / greatest(predicted, 1) AS p, hits / greatest(actual, 1) AS r
                 FROM (SELECT threshold, count(*) FILTER (WHERE prob >= threshold) AS predicted,
                              count(*) FILTER (WHERE prob >= threshold AND label = 1) AS hits,
                              count(*) FILTER (WHERE label = 1) AS actual
                       FROM labelled, bounds GROUP BY threshold))""",
        scores + f",\nlabelled AS (SELECT prob, label FROM score_3 JOIN ({w3.labelled()}) USING ({UCS})),\n"
        f"bounds AS (SELECT threshold FROM (VALUES {bounds}) AS b(threshold))",
    )
    steady = (
        scores + f",\nlabelled AS (SELECT round(prob, 9) AS threshold, label FROM score_3 JOIN ({w3.labelled()}) USING ({UCS})),\n"
        """curve AS (SELECT DISTINCT threshold, count(*) OVER up AS predicted, count(*) FILTER (WHERE label = 1) OVER up AS hits,
                    count(*) FILTER (WHERE label = 1) OVER () AS actual
             FROM labelled WINDOW up AS (ORDER BY threshold DESC RANGE UNBOUNDED PRECEDING)),
        rates AS (SELECT *, hits / greatest(predicted, 1) AS p, hits / greatest(actual, 1) AS r FROM curve),
        rated AS (SELECT threshold, predicted, hits, actual, round(p, 9) AS "precision", round(r, 9) AS recall,
                    round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM rates)"""
    )
    out["eval_exact_curve"] = query("SELECT * FROM rated", steady)
    out["eval_best_submission"] = query("SELECT * FROM rated ORDER BY f1 DESC, predicted LIMIT 1", steady)
    out["clean_impute_many_values"] = """
      WITH known AS (SELECT o_totalprice AS x FROM orders WHERE o_orderkey % 7 <> 0)
      SELECT o_orderkey,
        round(CASE WHEN o_orderkey % 7 = 0 THEN (SELECT median(x) FROM known) ELSE o_totalprice END, 9) AS by_median,
        round(CASE WHEN o_orderkey % 7 = 0 THEN (SELECT x FROM known GROUP BY x ORDER BY count(*) DESC, x LIMIT 1)
          ELSE o_totalprice END, 9) AS by_mode
      FROM orders"""
    return out


def data_sets() -> dict[str, str]:
    standard, cart, test = Window(W3), Window(W3, True), Window(X.WINDOWS["test"])
    out = {"ds_assemble": query(standard.dataset(True)[0]), "ds_assemble_cart": query(cart.dataset(True)[0])}
    out["ds_assemble_test"] = query(test.dataset(False)[0])
    out["ds_assemble_test_cart"] = query(Window(X.WINDOWS["test"], True).dataset(False)[0])
    sql, names = standard.dataset(True)
    diffs = ", ".join(
        f"{n}_{a} - {n}_{b} AS {n}_{a}_{b}_diff" for n, a, b in DIFFERENCES
    )
    out["feat_window_diffs"] = query(f"SELECT {UCS}, {diffs} FROM ({sql})")
    weak = ", ".join(c for c in WEAK_COLUMNS if c in names)
    out["ds_feature_select"] = query(f"SELECT * EXCLUDE ({weak}), {diffs} FROM ({sql})")
    two = [Window(X.WINDOWS[w]).dataset(True)[0] for w in ("w2", "w3")]
    out["ds_union_windows"] = query(f"SELECT * FROM ({two[0]}) UNION ALL BY NAME SELECT * FROM ({two[1]})")
    return out


def statements() -> dict[str, str]:
    standard, cart = Window(W3), Window(W3, True)
    out = plain()
    for key, (f, block) in BLOCK_KEYS.items():
        out[key] = query(standard.family(f, [block])[0])
        if key in CART_BLOCKS:
            out[f"{key}_cart"] = query(cart.family(f, [block])[0])
    for f in KEYS:
        out[f"family_{f}"] = query(standard.family(f)[0])
        out[f"family_{f}_cart"] = query(cart.family(f)[0])
    long = Window(X.ORDER_LOG_WINDOW)
    out["order_log_labels"] = query(long.labelled(), log=ORDER_LOG)
    for f in ("u", "ucs", "uc", "us"):
        out[f"order_log_family_{f}"] = query(long.family(f)[0], log=ORDER_LOG)
    out.update(data_sets())
    return out
