"""Hand-made logs with results worked out on paper."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.functions import scalars as S
from cartwise.operators import clean, measures, ranks
from cartwise.operators.log import counted_log
from cartwise.operators.windows import WindowSpec
from cartwise.plans import evaluate, families, labels, vote
from cartwise.sources.tables import Tables
from tests.conftest import day, rows

END = day(25)
VOCABULARY = {"user_reg_time": [1, 2, 3, 4], "age": [1, 2], "sex": [0, 1, -1], "city_level": [1], "province": [1]}

PRODUCTS = [
    (1, 10, 100, 7, dt.date(2016, 5, 1)),
    (2, 11, 100, 7, dt.date(2018, 1, 1)),
    (3, 10, 101, 7, None),
    (4, 12, 100, 8, dt.date(2011, 12, 31)),
]
USERS = [
    (1, 1, 0, dt.date(2018, 3, 25), 1, 1, 1, 1),
    (2, None, None, None, None, None, None, None),
    (3, 2, 0, dt.date(2007, 12, 31), 1, 2, 1, 1),
]
SHOPS = [
    (100, 7, 5, 1, 9.5, dt.date(2009, 12, 31)),
    (101, None, 6, 2, None, dt.date(2012, 1, 1)),
]
COMMENTS = [(day(20), 1, 5, 4, 1), (day(26), 1, 50, 40, 10), (day(20), 4, 1, 1, 0)]
ACTIONS = [
    # user 1: browse, two orders on one day, one order five days later
    (1, 1, day(15), 1), (1, 1, day(15), 1), (1, 1, day(18), 2), (1, 1, day(18), 2), (1, 2, day(23), 2),
    # user 1, other triple: the browse comes after the order
    (1, 4, day(20), 2), (1, 4, day(25), 1),
    # user 2: only a cart action on the last day; user 9 has no profile
    (2, 3, day(25), 5), (9, 3, day(24), 1), (9, 4, day(24), 1), (9, 1, day(24), 3),
    # outside the candidate days, and after the end
    (1, 3, day(1), 2), (2, 3, day(27), 2), (5, 1, day(26), 2),
    # a product that does not exist
    (1, 99, day(20), 2),
]


def tables(make, actions=ACTIONS):
    raw = Tables(
        actions=make("action", actions), users=make("user", USERS), shops=make("shop", SHOPS),
        products=make("product", PRODUCTS), comments=make("comment", COMMENTS),
    )
    return clean.clean_tables(raw)


@pytest.fixture
def inputs(make):
    return families.Inputs(tables(make), WindowSpec(END), VOCABULARY)


@pytest.fixture
def cart_inputs(make):
    return families.Inputs(tables(make), WindowSpec(END), VOCABULARY, cart=True)


def test_window_bounds():
    spec = WindowSpec(END)
    assert (spec.start, spec.recent(1), spec.recent(10)) == (day(12), END, day(16))
    assert (spec.label_start, spec.label_end) == (day(26), dt.date(2018, 4, 1))


def test_order_rhythm_counts_repeats_as_zero_gaps(inputs):
    ucs = rows(families.block(inputs, "ucs", "order_rhythm"), "user_id", "cate", "shop_id")
    first = ucs[1, 7, 100]
    assert first["ucs_ac_nunique"] == 2
    assert first["ucs_jiange_mean"] == pytest.approx((0 + 5) / 2)
    assert (first["ucs_b2_last_day_start"], first["ucs_b2_last_day_end"]) == (3, 9)
    single = ucs[1, 8, 100]
    assert (single["ucs_ac_nunique"], single["ucs_jiange_mean"]) == (1, 60.0)
    none = ucs[9, 7, 101]
    assert [none[c] for c in none][3:] == [0, 60.0, 75, 75]


def test_browse_to_order_may_be_negative(inputs):
    ucs = rows(families.block(inputs, "ucs", "browse_to_order"), "user_id", "cate", "shop_id")
    assert ucs[1, 7, 100]["ucs_b2_diff_day"] == pytest.approx(8 / 2)
    assert ucs[1, 8, 100]["ucs_b2_diff_day"] == pytest.approx(-5)
    assert ucs[9, 7, 101]["ucs_b2_diff_day"] == 60.0


def test_history_reaches_before_the_candidate_days(inputs):
    u = rows(families.block(inputs, "u", "activity"), "user_id")[1,]
    assert (u["u_cate_counts"], u["u_shop_counts"], u["u_active_days_in_all"]) == (2, 2, 6)
    assert (u["u_b_count_in_7"], u["u_active_days_in_7"]) == (3, 3)
    keys = rows(families.block(inputs, "us", "counts"), "user_id", "shop_id")
    assert (1, 101) not in keys and (5, 100) not in keys


def test_rates_of_keys_without_actions_are_zero(inputs):
    ucs = rows(families.block(inputs, "ucs", "conversion"), "user_id", "cate", "shop_id")
    assert [v for k, v in ucs[2, 7, 101].items()][3:] == [0.0, 0.0, 0.0, 0.0]


def test_repeats_count_once_where_the_log_is_deduplicated(inputs):
    c = rows(families.family(inputs, "c"), "cate")[7,]
    assert c["c_b2_count"] == 4  # raw: two on the 18th, one on the 23rd, one on the 1st
    cs = rows(families.family(inputs, "cs"), "cate", "shop_id")[7, 100]
    assert cs["cs_b2_count"] == 2
    assert cs["cs_active_days"] == 4


def test_rank_ties_absent_keys_and_cart_rows(inputs, cart_inputs):
    us = rows(families.block(inputs, "us", "rank_in_user"), "user_id", "shop_id")
    assert us[9, 100]["us_b_count_rank_in_3_in_u"] == 1 and us[9, 101]["us_b_count_rank_in_3_in_u"] == 2
    assert us[9, 100]["us_b_count_rank_in_1_in_u"] == 1000
    ucs = rows(families.block(inputs, "ucs", "rank_in_user"), "user_id", "cate", "shop_id")
    assert {ucs[k]["ucs_b_count_rank_in_3_in_u"] for k in ucs if k[0] == 9} == {1}
    # a cart action is a row, so the key is ranked; it only counts in the cart variant
    assert ucs[2, 7, 101]["ucs_b_count_rank_in_1_in_u"] == 1
    cart = rows(families.block(cart_inputs, "ucs", "counts"), "user_id", "cate", "shop_id")
    assert cart[2, 7, 101]["ucs_b_count_in_1"] == 1 and cart[2, 7, 101]["ucs_b_count_in_3"] == 0
    assert "ucs_b_count_in_10" not in cart[2, 7, 101]


def test_comments_are_weighted_by_rows_up_to_the_end(inputs):
    c = rows(families.block(inputs, "c", "comments"), "cate")
    # product 1: two browses, two orders, one follow up to the end; later comments do not count
    assert (c[7,]["c_comments"], c[7,]["c_good_comments"], c[7,]["c_bad_comments"]) == (25, 20, 5)
    assert c[8,]["c_comments"] == 3


def test_profile_of_missing_users_and_imputed_users(inputs, cart_inputs):
    u = rows(families.block(inputs, "u", "onehot"), "user_id")
    assert sum(v for k, v in u[9,].items() if k != "user_id") == 0
    # mode of sex is 0, median of age 1.5 matches no value, earliest of two tied registration days
    assert (u[2,]["female"], u[2,]["age_1"], u[2,]["age_2"], u[2,]["reg_time_4"]) == (1, 0, 0, 1)
    cart = rows(families.block(cart_inputs, "u", "onehot"), "user_id")
    assert (cart[1,]["reg_tm_last_day"], cart[1,]["reg_tm_7_day"]) == (1, 1)
    assert (cart[2,]["reg_tm_last_day"], cart[2,]["reg_tm_7_day"]) == (0, 0)


def test_shop_profile_and_null_bucket(inputs):
    s = rows(families.block(inputs, "s", "profile"), "shop_id")
    assert sum(s[100,][f"shop_reg_tm_{b}"] for b in range(1, 6)) == 0
    assert (s[101,]["shop_reg_tm_5"], s[101,]["or_shop_score"], s[101,]["shop_score"]) == (1, 0, 0.0)
    assert s[100,]["or_shop_score"] == 1


def test_shop_delay_needs_browse_and_order(inputs):
    s = rows(families.block(inputs, "s", "browse_to_order"), "shop_id")
    assert (s[100,]["s_b_count"], s[100,]["s_b2_diff_all_day"]) == (3, 8)
    assert s[100,]["s_b2_diff_day"] == pytest.approx(8 / 3)
    # shop 101: order on the 1st, first browse on the 24th
    assert (s[101,]["s_b_count"], s[101,]["s_b2_diff_all_day"]) == (1, -23)


def test_major_category(inputs):
    cs = rows(families.block(inputs, "cs", "major"), "cate", "shop_id")
    assert (cs[7, 100]["cs_major_cate"], cs[8, 100]["cs_major_cate"], cs[7, 101]["cs_major_cate"]) == (1, 0, 0)


def test_launch_buckets(inputs):
    c = rows(families.block(inputs, "c", "new_items"), "cate")
    # the null launch day becomes the smallest mode, 2011-12-31
    assert [c[7,][f"c_market_tm_{b}"] for b in range(1, 7)] == [1, 0, 1, 0, 0, 1]
    assert [c[8,][f"c_market_tm_{b}"] for b in range(1, 7)] == [0, 0, 0, 0, 0, 1]


def test_labels(inputs, make):
    got = rows(labels.train_labels(inputs.log, WindowSpec(END)), "user_id", "cate", "shop_id")
    assert {k: v["label"] for k, v in got.items() if v["label"]} == {(2, 7, 101): 1}
    assert (5, 7, 100) not in got  # ordered in the label days, never seen before
    assert len(got) == 6


def test_all_windows_equals_single_windows(inputs):
    training = {"a": WindowSpec(END), "b": WindowSpec(day(20))}
    scoring = {"t": WindowSpec(day(27))}
    stacked = labels.all_windows(inputs.log, training, scoring).collect()
    for name, spec in training.items():
        single = {tuple(r) for r in labels.train_labels(inputs.log, spec).collect()}
        assert single == {tuple(r)[1:] for r in stacked if r["window"] == name}
    single = {tuple(r) for r in labels.scoring_candidates(inputs.log, scoring["t"]).collect()}
    assert single == {tuple(r)[1:4] for r in stacked if r["window"] == "t"}


def test_measures_do_not_widen_with_the_history():
    short, long = (WindowSpec(END, history_start=d) for d in (day(1), dt.date(1900, 1, 1)))
    assert [m.name for m in measures.measures(short)] == [m.name for m in measures.measures(long)]


def test_candidate_days_may_span_more_than_one_word(make):
    old = [(1, 1, END - dt.timedelta(days=80), 1), (1, 1, END - dt.timedelta(days=64), 1)]
    x = families.Inputs(tables(make, ACTIONS + old), WindowSpec(END, days=90), VOCABULARY)
    one = rows(families.block(x, "uc", "active_days"), "user_id", "cate")
    x = families.Inputs(tables(make, ACTIONS), WindowSpec(END, days=90), VOCABULARY)
    two = rows(families.block(x, "uc", "active_days"), "user_id", "cate")
    key = next(k for k in one if k[0] == 1 and one[k] != two.get(k))
    assert one[key]["uc_active_days"] == two[key]["uc_active_days"] + 2


def test_a_row_of_1900_counts(make):
    old = [(1, 1, dt.date(1900, 1, 1), 2)]
    x = families.Inputs(tables(make, ACTIONS + old), WindowSpec(END), VOCABULARY)
    y = families.Inputs(tables(make, ACTIONS), WindowSpec(END), VOCABULARY)
    a, b = (rows(families.family(i, "u"), "user_id")[1,] for i in (x, y))
    assert a["ac_nunique"] == b["ac_nunique"] + 1 and a["u_active_days_in_all"] == b["u_active_days_in_all"] + 1


def test_long_history_counts_every_day(make):
    old = [(1, 1, dt.date(2017, 1, 1), 2), (1, 1, dt.date(2017, 9, 9), 2), (1, 1, dt.date(2017, 9, 9), 1)]
    x = families.Inputs(tables(make, ACTIONS + old), WindowSpec(END), VOCABULARY)
    u = rows(families.family(x, "u"), "user_id")[1,]
    assert u["ac_nunique"] == 6  # 1 January, 9 September, 1, 18, 20 and 23 March
    assert u["u_active_days_in_all"] == 8
    span = (day(23) - dt.date(2017, 1, 1)).days
    assert u["u_jiange_mean"] == pytest.approx(span / 6)  # seven order rows


def test_buckets():
    assert "NULL" in S.date_bucket("d", clean.SHOP_REG_BOUNDS, open_start=False)


@pytest.mark.parametrize("text,user,shop,item", [
    ("2007-12-31", 4, None, 6), ("2008-01-01", 3, None, 6), ("2010-01-01", 3, 5, 6), ("2012-12-31", 3, 5, 5),
    ("2013-01-01", 3, 4, 5), ("2015-01-01", 2, 3, 4), ("2016-06-01", 2, 3, 3), ("2017-01-01", 2, 2, 2),
    ("2018-01-01", 1, 1, 1),
])
def test_bucket_boundaries(spark, text, user, shop, item):
    d = spark.createDataFrame([(text,)], "d string").select(F.to_date("d").alias("d"))
    got = d.selectExpr(
        S.date_bucket("d", clean.USER_REG_BOUNDS),
        S.date_bucket("d", clean.SHOP_REG_BOUNDS, open_start=False),
        S.date_bucket("d", clean.MARKET_BOUNDS),
    ).first()
    assert tuple(got) == (user, shop, item)


def test_counted_log_keeps_the_number_of_rows(make):
    log = counted_log(make("action", ACTIONS), make("product", PRODUCTS))
    assert log.agg(F.sum("n")).first()[0] == len(ACTIONS) - 1
    assert log.count() == len(set(ACTIONS)) - 1


def test_order_gap_lag_agrees_with_the_closed_form(make, inputs):
    orders = counted_log(make("action", ACTIONS), make("product", PRODUCTS)).where("type = 2")
    gaps = ranks.order_gaps(orders, ["user_id"]).groupBy("user_id").agg(F.sum("gap"), F.sum("n") - 1).collect()
    by_user = {r[0]: r[1] / r[2] for r in gaps if r[1] is not None}
    upto = rows(families.block(inputs, "u", "order_rhythm"), "user_id")
    assert by_user[1] == pytest.approx(upto[1,]["u_jiange_mean"])


def test_majority_needs_every_model_and_three_votes(make):
    def scores(**prob):
        return make("score", [(int(k[1:]), 7, 100, v) for k, v in prob.items()])

    sets = {
        "1": scores(u1=0.9, u2=0.9, u3=0.076), "2": scores(u1=0.9, u2=0.9, u3=0.057),
        "3": scores(u1=0.9, u2=0.0, u3=0.076), "a": scores(u1=0.0, u2=0.0, u3=0.0), "23": scores(u2=0.0, u3=0.0),
    }
    # user 1 has three votes but one model did not score it; user 2 has two votes
    assert sorted(r.user_id for r in vote.majority(sets).collect()) == [3]


def test_two_level_score(make):
    predicted = make("candidate", [(1, 7, 100, 1), (1, 7, 100, 1), (2, 7, 100, 1), (3, 8, 100, 1)])
    truth = make("candidate", [(1, 7, 101, 1), (2, 7, 100, 1), (4, 7, 100, 1)])
    got = evaluate.two_level(predicted, truth, 0.4, 0.6).first()
    assert (got.cate_predicted, got.cate_actual, got.cate_hits) == (3, 3, 2)
    assert (got.shop_predicted, got.shop_actual, got.shop_hits) == (3, 3, 1)
    assert got.score == pytest.approx(0.4 * 2 / 3 + 0.6 / 3)


def test_two_level_score_of_nothing(make):
    got = evaluate.two_level(make("candidate", []), make("candidate", [])).first()
    assert got.score == 0 and got.cate_predicted == 0
