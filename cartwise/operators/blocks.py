"""Feature blocks as expressions over a measure table: column name -> SQL."""

from __future__ import annotations

from collections.abc import Iterable

from cartwise.functions.scalars import days_until, log_ratio, safe_rate, total
from cartwise.operators.measures import HISTORY_DAYS, ORDER_DAYS, candidate_words, days_in, seen_in
from cartwise.operators.windows import WindowSpec

Block = dict[str, str]

# Values for keys without the event: fixed values.
NO_GAP, NO_ORDER, NO_RECENT = 60, 75, 60

BOTH_SEEN = "(browse_first IS NOT NULL AND order_last IS NOT NULL)"
BROWSE_TO_ORDER = "datediff(order_last, browse_first)"


def conversion(prefix: str, kind: str, scope: str, rate: str) -> Block:
    """Log ratios of order to browse, order to follow, comment to order, and the share of orders."""
    browse, order, follow, comment = (f"{kind}{code}_{scope}" for code in (1, 2, 3, 4))
    return {
        f"{prefix}type_1_ratio": log_ratio(order, browse),
        f"{prefix}type_3_ratio": log_ratio(order, follow),
        f"{prefix}type_2_ratio": log_ratio(comment, order),
        rate: safe_rate(order, f"{browse} + {order} + {follow} + {comment}"),
    }


def code_counts(prefix: str, kind: str, codes: Iterable[int], ranges: Iterable[int]) -> Block:
    """Counts by action code and n-day range."""
    ranges = list(ranges)
    return {f"{prefix}_b{c}_count_in_{n}": f"{kind}{c}_{n}" for c in codes for n in ranges}


def range_total(kind: str, n: int, cart: bool = False) -> str:
    """All actions of codes 1 to 4, and 5 with ``cart``, in the last n days."""
    return total(f"{kind}{c}_{n}" for c in ((1, 2, 3, 4, 5) if cart else (1, 2, 3, 4)))


def range_counts(prefix: str, kind: str, ranges: Iterable[int], cart_ranges: Iterable[int] = ()) -> Block:
    cart_ranges = set(cart_ranges)
    return {f"{prefix}_b_count_in_{n}": range_total(kind, n, n in cart_ranges) for n in ranges}


def rank_counts(prefix: str, cart: bool) -> Block:
    """Counts to be ranked inside the user; null where the key has no row in the range."""
    return {
        f"{prefix}_b_count_rank_in_{n}_in_u": f"if({seen_in(n)}, {range_total('n', n, cart and n == 1)}, NULL)"
        for n in (1, 3, 5, 7)
    }


def order_rhythm(spec: WindowSpec, days: str, gap: str, last: str) -> Block:
    """Order days, mean gap between order rows, days from the last order to both ends of the label range.

    The gaps between consecutive rows add up to last - first, so their mean needs no sort.
    """
    mean_gap = "datediff(order_last, order_first) / (n2_hist - 1)"
    return {
        days: ORDER_DAYS,
        gap: f"if(order_last > order_first, {mean_gap}, {float(NO_GAP)}D)",
        f"{last}_start": f"coalesce({days_until(spec.label_start, 'order_last')}, {NO_ORDER})",
        f"{last}_end": f"coalesce({days_until(spec.label_end, 'order_last')}, {NO_ORDER})",
    }


def recency(prefix: str, spec: WindowSpec, codes: Iterable[int]) -> Block:
    """Days from the last action of each code in the candidate days to the label start."""
    return {
        f"{prefix}_b{c}_last_day": f"coalesce({days_until(spec.label_start, f'recent_{c}')}, {NO_RECENT})"
        for c in codes
    }


def last_browse(spec: WindowSpec, to_start: str, to_end: str) -> Block:
    """Days from the last browse in the candidate days to both ends of the label range."""
    return {
        to_start: f"coalesce({days_until(spec.label_start, 'recent_1')}, {NO_RECENT})",
        to_end: f"coalesce({days_until(spec.label_end, 'recent_1')}, {NO_RECENT})",
    }


def browse_to_order(diff: str) -> Block:
    """Days from the first browse to the last order per order day; negative if the browse came later."""
    # A row with a null in its key finds no day count.
    per_day = f"{BROWSE_TO_ORDER} / nullif({ORDER_DAYS}, 0)"
    return {diff: f"coalesce(if({BOTH_SEEN}, {per_day}, NULL), {float(NO_RECENT)}D)"}


def order_days_after_browse(name: str) -> Block:
    """Order days of keys that were also browsed."""
    return {name: f"if({BOTH_SEEN}, {ORDER_DAYS}, 0L)"}


def active_days(spec: WindowSpec, name: str) -> Block:
    """Distinct active days among the candidate days."""
    return {name: days_in(*candidate_words(spec))}
