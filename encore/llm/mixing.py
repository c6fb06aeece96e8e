"""Mixing to target weights by iterative proportional fitting.

The corpus is summed to cells (source, language, topic) of token counts.
Raking scales the cells so that the token share of every source, language and
topic meets its target: one marginal after the other, until all agree.  A
document is sampled with the probability of its cell, the fitted tokens over
the corpus tokens, scaled to the token budget and at most 1, if a hash of its
id, uniform in [0, 1), falls below it.  Choices are independent of order and
partitioning, and repeatable.

Where a probability would pass 1 the fit is made under that bound: a cell's
probability is the product of one factor per source, language and topic, at
most 1, and the factors are fitted in turn, so that what full cells cannot
give comes from the others of the same value.  A budget may still be too large
for the targets (a value has fewer tokens than its share of the budget); with
``targets_first`` the largest budget up to ``budget`` at which every target is
met to within MET is taken.  Else the budget is kept: values that have too
little are sampled whole, and what they lack is spread over the other values of
their marginal in proportion to the targets; where the marginals still
contradict each other, the fit with the least sum of differences from the
targets is taken, never one further off than plain raking.  Either way each row tells the
wanted and the reached share of its values.

The targets are configuration: a share per listed value of each marginal.
Values not listed (or null) form one further value, ``(other)``, that keeps
its share of the corpus.  The cell table that the driver rakes is bounded by
the targets (the product of their lengths, at most MAX_CELLS), not by the
corpus.  A listed value without a document cannot be met; its share is spread
over the others in proportion.

Costs: one scan for tokens and topics, one aggregation with map-side sums
(a hot source is a handful of partial rows), one broadcast of the cells.

Defined cases: a null or empty text has no token, weight of its cell, and is
sampled by it; an empty table gives no row; rows with a null id are sampled by
the hash of the null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import WS, Workspace

OTHER = "(other)"
MAX_CELLS = 1_000_000
MARGINALS = ("source", "lang", "topic")
#: Largest difference of a reached share from its target that counts as met.
MET = 1e-3
ROUNDS = 400


def topic_of(text: Column) -> Column:
    """A coarse content class from the whole text, where a corpus carries no
    topic: by the share of symbols, of capitals, of digits, and by length."""
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda rx: F.regexp_count(text, F.lit(rx)) / n
    return (F.when(share(r"[#*$%&|<>]") > 0.05, "markup").when(share("[A-Z]") > 0.3, "capitals")
            .when(share("[0-9]") > 0.05, "figures").when(F.length(text) < 1000, "short").when(F.length(text) < 5000, "article")
            .otherwise("long"))


def n_tokens(text: Column) -> Column:
    """Words of the whole text."""
    return F.regexp_count(text, F.lit(f"[^{WS}]+")).cast("long")


def wanted_shares(index: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray]) -> list[np.ndarray]:
    """The targets, scaled to the values that occur."""
    out = []
    for k, share in enumerate(targets):
        have = np.bincount(index[:, k], tokens, len(share))
        scaled = np.where(have > 0, share, 0.0)
        out.append(scaled / scaled.sum() if scaled.sum() > 0 else have / max(tokens.sum(), 1.0))
    return out


def reached_shares(index: np.ndarray, sampled: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return [np.bincount(index[:, k], sampled, n) / max(sampled.sum(), 1e-300) for k, n in enumerate(sizes)]


def attainable(have: np.ndarray, share: np.ndarray, budget: float) -> np.ndarray:
    """The shares of the budget nearest to ``share`` that the tokens of the
    values allow: values with too few are taken whole, the others share the
    rest in proportion."""
    whole = np.zeros(len(have), dtype=bool)
    while True:
        left = np.where(whole, 0.0, share).sum()
        want = np.where(whole, have, (budget - have[whole].sum()) * share / left if left > 0 else have)
        short = ~whole & (share > 0) & (want > have)
        if not short.any():
            return want / max(want.sum(), 1e-300)
        whole |= short


def _factors(ratio: np.ndarray, tokens: np.ndarray, value: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Per value the a at which tokens * min(1, a * ratio) sum to ``want``;
    where they cannot, the a at which all its cells are full."""
    n = len(want)
    factor, full = np.zeros(n), np.zeros(len(ratio), dtype=bool)
    while True:
        rest = np.bincount(value, np.where(full, 0.0, tokens * ratio), n)
        given = np.bincount(value, np.where(full, tokens, 0.0), n)
        factor = np.where(rest > 0, np.divide(want - given, rest, out=np.zeros(n), where=rest > 0), factor)
        now = full | (factor[value] * ratio >= 1)
        if (now == full).all():
            break
        full = now
    least = np.full(n, np.inf)
    np.minimum.at(least, value, np.where(ratio > 0, ratio, np.inf))
    return np.where((rest <= 0) & np.isfinite(least), np.maximum(factor, 1 / least), factor)


def bounded(index: np.ndarray, tokens: np.ndarray, wanted: list[np.ndarray], budget: float) -> tuple[np.ndarray, float]:
    """Probabilities of at most 1 whose expected tokens per value are the
    wanted shares of the budget, as far as they can be; and the largest
    difference of a share of the budget from the wanted one."""
    ratio, off = (tokens > 0).astype(np.float64), np.inf
    for _ in range(ROUNDS):
        for k, want in enumerate(wanted):
            ratio = np.clip(ratio * _factors(ratio, tokens, index[:, k], budget * want)[index[:, k]], 0.0, 1e200)
        sampled = np.minimum(1, ratio) * tokens
        before, off = off, max(float(np.abs(np.bincount(index[:, k], sampled, len(w)) - budget * w).max()) / budget for k, w in enumerate(wanted))
        if off <= MET / 100 or abs(before - off) < 1e-12:
            break
    return np.minimum(1, ratio), off


def largest_budget(index: np.ndarray, tokens: np.ndarray, wanted: list[np.ndarray], budget: float) -> float:
    """The largest budget up to ``budget`` that meets the wanted shares (to a
    thousandth of it); 0 if the cells that occur allow none."""
    have = [np.bincount(index[:, k], tokens, len(w)) for k, w in enumerate(wanted)]
    high = min(budget, *(float((h[w > 0] / w[w > 0]).min(initial=np.inf)) for h, w in zip(have, wanted, strict=True)))
    if bounded(index, tokens, wanted, high)[1] <= MET:
        return high
    low = 0.0
    while high - low > high / 1000 and high > tokens.sum() * 1e-6:
        mid = (low + high) / 2
        low, high = (mid, high) if bounded(index, tokens, wanted, mid)[1] <= MET else (low, mid)
    return low


def rake(index: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray], rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Fitted tokens per cell: index has one column of value numbers per
    marginal, targets the share per value (they are scaled to the values that
    occur).  Stops when no marginal is off by more than ``tolerance``."""
    total = tokens.sum()
    fitted = tokens.astype(np.float64).copy()
    if total == 0:
        return fitted
    wanted = [total * w for w in wanted_shares(index, tokens, targets)]
    for _ in range(rounds):
        off = 0.0
        for k, want in enumerate(wanted):
            have = np.bincount(index[:, k], fitted, len(want))
            factor = np.divide(want, have, out=np.ones_like(have), where=have > 0)
            off = max(off, float(np.abs(have - want)[have > 0].max(initial=0)) / total)
            fitted *= factor[index[:, k]]
        if off <= tolerance:
            break
    return fitted


def to_probabilities(fitted: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """min(1, s * fitted / tokens) with the scale s at which the expected
    tokens are the budget (all cells at 1 if the budget exceeds the corpus)."""
    ratio = np.divide(fitted, tokens, out=np.zeros_like(fitted), where=tokens > 0)
    if budget >= tokens[ratio > 0].sum():
        return np.where(ratio > 0, 1.0, 0.0)
    low, high = 0.0, 1.0
    while (np.minimum(1, high * ratio) * tokens).sum() < budget:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if (np.minimum(1, mid * ratio) * tokens).sum() < budget else (low, mid)
    return np.minimum(1, high * ratio)


def fit(index: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray], budget: float, targets_first: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """(probability per cell, wanted share per value)."""
    wanted = wanted_shares(index, tokens, targets)
    most = budget * tokens.sum()
    if not most:
        return np.zeros(len(tokens)), wanted
    if targets_first and (held := largest_budget(index, tokens, wanted, min(most, tokens.sum()))) > 0:
        return bounded(index, tokens, wanted, held)[0], wanted
    most = min(most, tokens.sum())
    given = [attainable(np.bincount(index[:, k], tokens, len(w)), w, most) for k, w in enumerate(wanted)]
    p, off = bounded(index, tokens, given, most)
    met = all(np.abs(g - w).max() <= MET for g, w in zip(given, wanted, strict=True))
    if off <= MET / 100 and met:
        return p, wanted
    # marginals that contradict each other: of three fits that fill the budget, the nearest
    fits = [to_probabilities(x, tokens, most) for x in (p * tokens, bounded(index, tokens, wanted, most)[0] * tokens, rake(index, tokens, targets))]

    def away(p):
        reached = reached_shares(index, p * tokens, [len(w) for w in wanted])
        return sum(float(np.abs(r - w).sum()) for r, w in zip(reached, wanted, strict=True))

    return min(fits, key=away), wanted


def uniform(id_col: str, seed: str) -> Column:
    """A number in [0, 1) per id, from its MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix(docs: DataFrame, targets: dict[str, dict[str, float]], budget: float = 0.5, seed: str = "mix", topic: Column | None = None,
        tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text", targets_first: bool = False) -> DataFrame:
    """Returns (id_col, source, lang, topic, n_tokens, weight, probability,
    sampled, and per marginal m: m_wanted, m_reached) per row.  ``budget``:
    share of the corpus tokens to sample, with ``targets_first`` at most;
    ``weight``: fitted over corpus tokens of the row's cell; ``m_wanted``,
    ``m_reached``: share of the row's value in the targets and among the
    expected sampled tokens."""
    if np.prod([len(targets[m]) + 1 for m in MARGINALS]) > MAX_CELLS:
        raise ValueError("the targets span too many cells; list fewer values")
    spark = docs.sparkSession
    ws = Workspace(spark, "mix")
    text = F.coalesce(F.col(text_col), F.lit(""))

    def listed(m: str, value: Column) -> Column:
        return F.when(value.isin(list(targets[m])), value).otherwise(OTHER) if targets[m] else F.lit(OTHER)

    value = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(text) if topic is None else topic}
    rows = ws.put(docs.select(
        F.col(id_col).cast("long").alias(id_col), *[listed(m, value[m]).alias(m) for m in MARGINALS],
        (n_tokens(text) if tokens is None else tokens).alias("n_tokens")))
    cells = rows.groupBy(*MARGINALS).agg(F.sum("n_tokens").alias("tokens")).toPandas()  # bounded by the targets
    if cells.empty:
        return spark.createDataFrame([], f"{id_col} long, source string, lang string, topic string, n_tokens long, weight double, probability double, sampled boolean, "
                                     + ", ".join(f"{m}_wanted double, {m}_reached double" for m in MARGINALS))

    cells = cells.sort_values(list(MARGINALS)).reset_index(drop=True)
    have = cells["tokens"].to_numpy(dtype=np.float64)
    index, shares = [], []
    for m in MARGINALS:
        names = [*targets[m], OTHER]
        at = {name: i for i, name in enumerate(names)}
        index.append(cells[m].map(at).to_numpy(dtype=np.int64))
        other = have[cells[m] == OTHER].sum() / max(have.sum(), 1.0)
        given = np.array(list(targets[m].values()), dtype=np.float64)
        shares.append(np.append(given / given.sum() * (1 - other) if given.sum() else given, other))
    index = np.stack(index, axis=1)
    fitted = rake(index, have, shares)
    cells["weight"] = np.divide(fitted, have, out=np.zeros_like(have), where=have > 0)
    cells["probability"], wanted = fit(index, have, shares, budget, targets_first)
    reached = reached_shares(index, cells["probability"].to_numpy() * have, [len(w) for w in wanted])
    told = [f"{m}_{x}" for m in MARGINALS for x in ("wanted", "reached")]
    for k, m in enumerate(MARGINALS):
        cells[f"{m}_wanted"], cells[f"{m}_reached"] = wanted[k][index[:, k]], reached[k][index[:, k]]
    table = spark.createDataFrame(cells[[*MARGINALS, "weight", "probability", *told]])
    out = rows.join(F.broadcast(table), list(MARGINALS))  # bounded by the targets
    out = out.withColumn("sampled", uniform(id_col, seed) < F.col("probability"))
    return out.select(id_col, *MARGINALS, "n_tokens", "weight", "probability", "sampled", *told)
