"""Host-level quality rules.

Rules look at each whole text; their failures are counted by host, each host's failure
rates are shrunk towards all hosts' by a Beta prior fitted to the hosts themselves, and
the host's verdict is joined back to its documents.

Defined results: a null or blank text has no words and fails ``too_short``; documents
of a null host form a host of their own; repeated rows count each time; an empty table
gives an empty result; columns of the names written here are replaced, others pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .textkit import Texts, repeated_lines, words_in_repeats

SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: rule -> its failing condition over STATS; the first two reject a document by themselves
RULES = {
    "too_short": "n_words < 20",
    "repetitive": "100 * n_repeat_words > 30 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "dup_lines": "20 * n_dup_lines > n_words",
}
BASE_RULES = ("too_short", "repetitive")

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_HEAD = (np.arange(256) & 0xC0) != 0x80


def text_stats(t: Texts) -> list[np.ndarray]:
    """STATS of each text."""
    return [t.n_words.astype(np.int64), t.count(_HEAD[t.data] & ~t.is_space), t.count(_IS_SYMBOL[t.data]), repeated_lines(t), words_in_repeats(t, 8)]


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns STATS."""
    return store.append_text_columns(docs, text, text_stats, [(c, T.LongType()) for c in STATS])


def host_rates(stats: DataFrame, host: str) -> DataFrame:
    """(host, n, one failure count per rule): one partial aggregate per task and host is shuffled."""
    return stats.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.expr(cond).cast("long")).alias(rule) for rule, cond in RULES.items()))


def beta_prior(rule: str) -> tuple[Column, Column]:
    """(mean, strength) of the Beta prior that fits the hosts' rates of ``rule`` by moments.

    The strength is ``m (1 - m) / v - 1`` with v the variance between hosts in excess of
    the binomial one; hosts that differ no more than chance get a strong prior.
    """
    n, k = F.sum("n"), F.sum(rule)
    m = F.coalesce((k + F.lit(0.5)) / (n + F.lit(1.0)), F.lit(0.5))
    spread = F.avg(F.pow(F.col(rule) / F.col("n"), F.lit(2))) - F.pow(F.avg(F.col(rule) / F.col("n")), F.lit(2))
    noise = m * (1 - m) * F.avg(1 / F.col("n"))
    v = F.greatest(F.coalesce(spread - noise, F.lit(0.0)), F.lit(1e-6))
    return m, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1e4))


def host_verdicts(rates: DataFrame, max_rate: float) -> DataFrame:
    """(host, host_n, host_worst_rate, host_kept): kept while no shrunk failure rate passes ``max_rate``."""
    prior = rates.agg(*(c.alias(f"{rule}_{part}") for rule in RULES for part, c in zip("ms", beta_prior(rule), strict=True))).first()
    shrunk = {r: (F.col(r) + prior[f"{r}_m"] * prior[f"{r}_s"]) / (F.col("n") + prior[f"{r}_s"]) for r in RULES}
    worst = F.greatest(*shrunk.values())
    return rates.select("host", F.col("n").alias("host_n"), worst.alias("host_worst_rate"), (worst <= max_rate).alias("host_kept"))


def assess(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """docs with STATS, base_failed, host_worst_rate and kept.

    The texts are read twice: once for the hosts' counts and once for the documents'
    verdicts, so that no text is shuffled or stored while the hosts' table is small
    enough for the planner to broadcast; a larger one is joined by host, where adaptive
    execution splits a hot host.
    """
    rates = store.written(host_rates(with_stats(docs.select(host, text), text), host), "host-rates")
    verdicts = host_verdicts(rates, max_rate)
    base = F.expr(" OR ".join(f"({RULES[r]})" for r in BASE_RULES))
    names = [c for c in docs.columns if c not in {*STATS, "base_failed", "host_worst_rate", "kept"}]
    d, v = with_stats(docs, text).alias("d"), verdicts.alias("v")
    joined = d.join(v, F.col(f"d.{host}").eqNullSafe(F.col("v.host")), "left")
    return joined.select(*(F.col(f"d.`{c}`") for c in [*names, *STATS]), base.alias("base_failed"), F.col("v.host_worst_rate"), (~base & F.coalesce(F.col("v.host_kept"), F.lit(True))).alias("kept"))
