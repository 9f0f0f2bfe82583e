"""Click cap per (user, ad): pass the first ``cap`` clicks of each period,
drop the rest, and raise exactly one alert per key and period, on the
first dropped click. The period resets at the next UTC midnight (a
parameter). Batch form; the streaming form is
``streaming.stateful.ClickCap``.

Batch takes the period from event time: processing time cannot be
replayed. One pass tags every kept row ``pass`` or ``alert`` so both
outputs come from the same job (the side output of the original).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.timefns import duration_micros, floor_to, from_micros, to_micros
from .topn import top_n_per_group

# Fixed value: the alert text is this prefix, the cap, then this suffix.
ALERT_PREFIX = "点击超过"
ALERT_SUFFIX = " 次"

def alert_message(cap: int) -> str:
    return f"{ALERT_PREFIX}{cap}{ALERT_SUFFIX}"


def click_cap(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
              cap: int = 100, period: str = "1 day") -> DataFrame:
    """Rows that passed or raised the alert, with ``tag`` and ``period_start``.

    Rank inside (keys, period) by ``ts`` then ``order``; rank <= cap passes,
    rank == cap + 1 is the alert; all later rows are dropped. The ranking is a
    top-(cap + 1) per group, cut in every task before the exchange, so no key is
    gathered whole.
    """
    keys = list(keys)
    step = duration_micros(period)
    with_period = df.withColumn("period_start", from_micros(floor_to(to_micros(ts), step)))
    ranked = top_n_per_group(with_period, [*keys, "period_start"], [ts, *order], cap + 1,
                             rank_col="_rank")
    return (ranked.withColumn("tag", F.when(F.col("_rank") <= cap, F.lit("pass"))
                              .otherwise(F.lit("alert")))
            .drop("_rank"))


def click_pass(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
               cap: int = 100, period: str = "1 day") -> DataFrame:
    """The clicks that pass the cap (input columns)."""
    return (click_cap(df, keys, ts, order, cap, period)
            .where(F.col("tag") == "pass").drop("tag", "period_start"))


def click_alerts(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                 cap: int = 100, period: str = "1 day") -> DataFrame:
    """One row per (keys, period) that went over the cap: ``keys, period_start, message``."""
    return (click_cap(df, keys, ts, order, cap, period)
            .where(F.col("tag") == "alert")
            .select(*keys, "period_start", F.lit(alert_message(cap)).alias("message")))
