"""Declared schemas of the five input tables, the candidates and the scores."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LONG, INT, DOUBLE, DATE = T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType()

ACTION = _schema(("user_id", LONG), ("sku_id", LONG), ("action_time", DATE), ("type", INT))
USER = _schema(
    ("user_id", LONG), ("age", INT), ("sex", INT), ("user_reg_tm", DATE),
    ("city_level", INT), ("province", INT), ("city", INT), ("county", INT),
)
SHOP = _schema(
    ("shop_id", LONG), ("cate", INT), ("fans_num", LONG), ("vip_num", LONG),
    ("shop_score", DOUBLE), ("shop_reg_tm", DATE),
)
PRODUCT = _schema(
    ("sku_id", LONG), ("brand", INT), ("shop_id", LONG), ("cate", INT), ("market_time", DATE),
)
COMMENT = _schema(
    ("dt", DATE), ("sku_id", LONG), ("comments", LONG), ("good_comments", LONG), ("bad_comments", LONG),
)
CANDIDATE = _schema(("user_id", LONG), ("cate", INT), ("shop_id", LONG), ("label", INT))
SCORE = _schema(("user_id", LONG), ("cate", INT), ("shop_id", LONG), ("prob", DOUBLE))

SCHEMAS = {
    "action": ACTION, "user": USER, "shop": SHOP, "product": PRODUCT, "comment": COMMENT,
    "candidate": CANDIDATE, "score": SCORE,
}

# Action codes in the log: fixed values.
BROWSE, ORDER, FOLLOW, COMMENTED, CART = 1, 2, 3, 4, 5
ACTION_CODES = 5
