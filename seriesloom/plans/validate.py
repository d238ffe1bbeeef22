"""Rolling-origin and holdout validation, grid and box search.

Every fold of every candidate comes from one pass over the series: a model's state at a fold's
origin is read off running sums or recursion states, so no prefix is fitted again.  Test rows then
meet origin states in a join on ``(k, origin)``.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..models import holt_winters, smoothing
from ..models.registry import NAMES
from ..operators.forecast import Z, point
from ..operators.layout import chunk_rows, in_chunk, one_chunk, with_halo, with_totals
from ..operators.windows import train_rows
from ..session import materialize

# Default grids and defaults without search.
GRIDS = {
    "sma": {"window": [24, 48, 168]},
    "lr": {},
    "ses": {"alpha": [0.1, 0.2, 0.3]},
    "holt": {"alpha": [0.1, 0.2], "beta": [0.05, 0.1]},
    "holt_hw_add": {"seasonal_periods": [24]},
    "holt_hw_mul": {"seasonal_periods": [24]},
}
DEFAULTS = {
    "sma": {"window": 24}, "lr": {}, "ses": {"alpha": 0.2}, "holt": {"alpha": 0.2, "beta": 0.1},
    "holt_hw_add": {"seasonal_periods": 24}, "holt_hw_mul": {"seasonal_periods": 24},
}


LONG = 4096  # rows of a test part from which its errors are summed by chunk first


class Folds:
    """Where folds start and how long they are, as columns over the series length ``n``."""

    def __init__(self, first: Column, step: Column, horizon: Column, long: bool = False):
        self.first, self.step, self.horizon, self.long = first, step, horizon, long  # long: a test part may span many chunks

    @classmethod
    def rolling(cls, initial_ratio: float = 0.5, initial_size: int | None = None, horizon: int = 24, step: int = 24):
        n = F.col("n")
        first = F.greatest(F.lit(2), F.floor(n * float(initial_ratio))) if initial_size is None else F.lit(int(initial_size))
        return cls(first.cast("long"), F.lit(int(step)).cast("long"), F.lit(int(horizon)).cast("long"), int(horizon) > LONG)

    @classmethod
    def holdout(cls, train_ratio: float = 0.8):
        n = F.col("n")
        cut = train_rows(n, train_ratio)
        return cls(cut, F.greatest(n, F.lit(1)).cast("long"), n - cut, True)


def expand_grid(grid: dict[str, list]) -> list[dict]:
    """Cartesian product in the given order; an empty grid gives one empty set."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def sized(df: DataFrame) -> DataFrame:
    return with_totals(df.select("k", "t", "v", "i", "chunk").withColumn("one", F.lit(1)), n=("sum", "one"), total=("sum", "v")).drop("one")


def test_rows(df: DataFrame, folds: Folds) -> DataFrame:
    """``(k, origin, s, actual, t, chunk)``: test rows with their fold; ``s`` counts from 1 after the origin.

    ``s = 0`` marks the last training row of the fold.  Fold numbers follow from the row number by
    arithmetic, so there is no range join.
    """
    i, first, step, horizon = F.col("i"), folds.first, folds.step, folds.horizon
    lo = F.greatest(F.lit(0), F.ceil((i - first - horizon + 1) / step))
    hi = F.floor((i + 1 - first) / step)
    late = sized(df).filter(i + 1 >= first)
    spread = late.withColumn("fold", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    return spread.withColumn("origin", first + F.col("fold") * step).filter(F.col("origin") < F.col("n")).select(
        "k", "origin", (i - F.col("origin") + 1).alias("s"), F.col("v").alias("actual"), "t", "chunk")


def _sums_at_origins(df: DataFrame, sums: dict[str, Column], keep: list[str], folds: Folds) -> DataFrame:
    """Running sums over the whole prefix, at the last row of each training set.

    Sums run inside chunks; the rows wanted and the chunk ends are stored, and chunk ends give each
    chunk the total before it. Series of one chunk need neither.
    """
    rows = chunk_rows(df)
    upto = in_chunk("i").rowsBetween(Window.unboundedPreceding, 0)
    origin = F.col("i") + 1
    at = (origin >= folds.first) & (origin < F.col("n")) & (F.pmod(origin - folds.first, folds.step) == 0)
    end = (F.pmod(origin, F.lit(rows)) == 0) | (origin == F.col("n"))
    summed = df.select("k", "chunk", *keep, at.alias("is_origin"), end.alias("is_end"), origin.alias("origin"),
                       *[F.sum(c).over(upto).alias(name) for name, c in sums.items()])
    if one_chunk(df):
        return summed.filter("is_origin").select("k", "origin", *keep, *[(F.col(c) + F.lit(0.0)).alias(c) for c in sums])
    picked = materialize(summed.filter("is_origin or is_end"), "prefix")
    before = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = picked.filter("is_end").select("k", "chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"_{c}") for c in sums])
    whole = picked.filter("is_origin").join(carry, ["k", "chunk"])
    return whole.select("k", "origin", *keep, *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums])


def sma_origins(df: DataFrame, windows: list[int], folds: Folds) -> DataFrame:
    """Moving averages with partial windows: last fitted value and residual spread per origin.

    All windows are differences of one running sum inside the chunk and its halo, so their cost does
    not grow with the window.  The sum runs over centred values to keep its digits.
    """
    base = with_halo(sized(df), before=max(windows) - 1)
    w = in_chunk("i")
    mean = F.col("total") / F.col("n")
    running = base.withColumn("mean", mean).withColumn("c", F.sum(F.col("v") - mean).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    averaged = running.select("k", "chunk", "i", "n", "v", "home", *[
        (F.col("mean") + (F.col("c") - F.coalesce(F.lag("c", x).over(w), F.lit(0.0))) / F.least(F.col("i") + 1, F.lit(x))).alias(f"m{j}")
        for j, x in enumerate(windows)]).filter("home")
    sums = {}
    for j in range(len(windows)):
        e = F.col("v") - F.col(f"m{j}")
        sums[f"e{j}"], sums[f"q{j}"] = e, e * e
    at = _sums_at_origins(averaged, sums, ["n", *[f"m{j}" for j in range(len(windows))]], folds)
    cells = F.explode(F.array(*[
        F.struct(F.lit(j).alias("cand"), F.col(f"m{j}").alias("level"), F.col(f"e{j}").alias("e"), F.col(f"q{j}").alias("q"))
        for j in range(len(windows))])).alias("c")
    mean_e = F.col("c.e") / F.col("origin")
    return at.select("k", "origin", cells).select(
        "k", "c.cand", "origin", "c.level", F.lit(0.0).alias("slope"), F.lit(None).cast("array<double>").alias("season"),
        F.sqrt(F.greatest(F.col("c.q") / F.col("origin") - mean_e * mean_e, F.lit(0.0))).alias("resid_std"))


def linear_origins(df: DataFrame, folds: Folds) -> DataFrame:
    """Least squares line of every training set from running sums of the centred values."""
    base = sized(df)
    y = F.col("v") - F.col("total") / F.col("n")
    centred = base.withColumn("mean", F.col("total") / F.col("n")).withColumn("y", y)
    sums = {"sy": F.col("y"), "siy": F.col("i") * F.col("y"), "syy": F.col("y") * F.col("y")}
    at = _sums_at_origins(centred, sums, ["mean"], folds)
    n = F.col("origin").cast("double")
    mid = (n - 1) / 2
    sxx = n * (n * n - 1) / 12
    sxy = F.col("siy") - mid * F.col("sy")
    slope = sxy / F.nullif(sxx, F.lit(0.0))
    sse = F.greatest(F.col("syy") - F.col("sy") * F.col("sy") / n - slope * sxy, F.lit(0.0))
    return at.select("k", F.lit(0).alias("cand"), "origin", (F.col("mean") + F.col("sy") / n + slope * (n - 1 - mid)).alias("level"),
                     slope.alias("slope"), F.lit(None).cast("array<double>").alias("season"), F.sqrt(sse / n).alias("resid_std"))


def origin_states(df: DataFrame, code: str, candidates: list[dict], folds: Folds, hw_grid=None) -> DataFrame:
    """``(k, cand, origin, level, slope, season, kind, resid_std)`` for every fold and candidate."""
    if code == "sma":
        states = sma_origins(df, [int(c.get("window", 24)) for c in candidates], folds)
    elif code == "lr":
        states = linear_origins(df, folds)
    elif code in ("ses", "holt"):
        weights = [(c.get("alpha", smoothing.ALPHA), c.get("beta", smoothing.BETA)) for c in candidates]
        states = smoothing.smoothing_origins(df, code, weights, folds.first, folds.step)
    elif code in ("holt_hw_add", "holt_hw_mul"):
        per = [holt_winters.holt_winters_origins(df, int(c.get("seasonal_periods", 24)), code[-3:], folds.first, folds.step, hw_grid)
               .withColumn("cand", F.lit(j)) for j, c in enumerate(candidates)]
        states = per[0]
        for other in per[1:]:
            states = states.unionByName(other)
    else:
        raise ValueError(f"unknown model code {code!r}; known: {sorted(NAMES)}")
    return states.withColumn("kind", F.lit(code[-3:] if code.startswith("holt_hw") else None).cast("string"))


def validate(df: DataFrame, code: str, candidates: list[dict], folds: Folds, hw_grid=None) -> DataFrame:
    """``(k, model, cand, origin, train_end, mse, coverage)``; a failed fold has NULL mse and coverage 0."""
    states = origin_states(df, code, candidates, folds, hw_grid)
    tests = test_rows(df, folds)
    # one row per (series, origin) on both sides of the join; candidates unfold after it
    fields = ("level", "slope", "season", "kind", "resid_std")
    packed = states.groupBy("k", "origin").agg(F.map_from_entries(F.collect_list(F.struct("cand", F.struct(*fields)))).alias("by_cand"))
    met = _meet_by_chunk(tests, packed) if folds.long else tests.join(packed, ["k", "origin"], "left")
    each = met.withColumn("cand", F.explode(F.array(*[F.lit(j) for j in range(len(candidates))])))
    each = each.withColumn("st", F.try_element_at("by_cand", F.col("cand"))).select(
        "k", "origin", "cand", "chunk", "s", "actual", "t", *[F.col(f"st.{c}").alias(c) for c in fields])
    tested = F.col("s") > 0
    error = F.when(tested, F.col("actual") - point(F.col("s")))
    inside = F.when(error.isNotNull(), (F.abs(error) <= Z * F.col("resid_std")).cast("double"))
    keys = ["k", "origin", "cand"]
    sums = each.groupBy(*keys, *(["chunk"] if folds.long else [])).agg(
        F.sum(error * error).alias("sse"), F.count(error).alias("n"), F.sum(inside).alias("hits"), F.count(inside).alias("n_bands"),
        F.max(F.when(~tested, F.col("t"))).alias("train_end"))
    if folds.long:
        sums = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("sse", "n", "hits", "n_bands")], F.max("train_end").alias("train_end"))
    scored = sums.select(*keys, "train_end", F.try_divide("sse", "n").alias("mse"), F.coalesce(F.try_divide("hits", "n_bands"), F.lit(0.0)).alias("coverage"))
    finite = F.col("mse") < float("inf")
    return scored.select("k", F.lit(code).alias("model"), "cand", "origin", "train_end",
                         F.when(finite, F.col("mse")).alias("mse"), "coverage")


def _meet_by_chunk(tests: DataFrame, packed: DataFrame) -> DataFrame:
    """Test rows with their origin's states, joined on chunks too: a holdout part may be a fifth of all rows in one series."""
    spots = tests.select("k", "origin", "chunk").distinct().join(packed, ["k", "origin"], "left")
    return tests.join(spots, ["k", "origin", "chunk"])


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population spread of the fold errors that exist."""
    return folds.groupBy("k", "model", "cand").agg(
        F.avg("mse").alias("mean_mse"), F.stddev_pop("mse").alias("std_mse"), F.avg("coverage").alias("mean_coverage"),
        F.count(F.lit(1)).alias("n_folds"), F.count_if(F.col("mse").isNull()).alias("n_failed"))


def with_every_series(summary: DataFrame, df: DataFrame, code: str, n_candidates: int) -> DataFrame:
    """The summary with a row for every series and candidate: without a fold, ``n_folds`` is 0 and the errors are NULL."""
    keys = df.select("k").distinct().withColumn("cand", F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))))
    out = keys.join(summary.drop("model"), ["k", "cand"], "left")
    return out.select("k", F.lit(code).alias("model"), "cand", "mean_mse", "std_mse", "mean_coverage",
                      F.coalesce("n_folds", F.lit(0)).alias("n_folds"), F.coalesce("n_failed", F.lit(0)).alias("n_failed"))


def best_candidate(tested: DataFrame) -> DataFrame:
    """Smallest mean error per series and model; failed candidates last, the first one on ties."""
    order = F.struct(F.col("mean_mse").isNull(), F.col("mean_mse"), F.col("cand"))
    picked = tested.groupBy("k", "model").agg(F.min_by(F.struct("cand", "params", "mean_mse", "std_mse"), order).alias("b"))
    return picked.select("k", "model", "b.*")


def _with_params(tested: DataFrame, candidates: list[dict]) -> DataFrame:
    texts = F.array(*[F.map_from_arrays(F.array(*[F.lit(str(n)) for n in c]).cast("array<string>"),
                                        F.array(*[F.lit(float(x)) for x in c.values()]).cast("array<double>")) for c in candidates])
    return tested.withColumn("params", F.get(texts, F.col("cand")))


def grid_search(df: DataFrame, code: str, grid: dict[str, list] | None = None, folds: Folds | None = None, hw_grid=None) -> DataFrame:
    """Every candidate's scores per series; ``best_candidate`` picks from it."""
    candidates = expand_grid(GRIDS[code] if grid is None else grid)
    return score_candidates(df, code, candidates, folds, hw_grid)


def score_candidates(df, code, candidates, folds=None, hw_grid=None) -> DataFrame:
    summary = cv_summary(validate(df, code, candidates, folds or Folds.rolling(), hw_grid))
    return _with_params(with_every_series(summary, df, code, len(candidates)), candidates)


def _halton(index: int, base: int) -> float:
    value, scale = 0.0, 1.0
    while index:
        scale /= base
        index, digit = divmod(index, base)
        value += digit * scale
    return value


def box_candidates(space: dict[str, tuple], calls: int = 25, seed: int = 0) -> list[dict]:
    """Space-filling points of a box of ``name: (low, high, 'real' | 'int')``, the same for a seed."""
    primes = [p for p in range(2, 20 * len(space) + 10) if all(p % q for q in range(2, int(p**0.5) + 1))]
    points = []
    for j in range(1, int(calls) + 1):
        point_ = {}
        for d, (name, (low, high, kind)) in enumerate(space.items()):
            u = _halton(j + 20 * seed, primes[d])
            point_[name] = min(int(high), int(low) + int(u * (int(high) - int(low) + 1))) if kind == "int" else low + u * (high - low)
        if point_ not in points:
            points.append(point_)
    return points


def box_search(df: DataFrame, code: str, space: dict[str, tuple], calls: int = 25, seed: int = 0,
               folds: Folds | None = None, hw_grid=None) -> DataFrame:
    """Best point of a box under rolling-origin validation; all points are scored in one job."""
    candidates = box_candidates(space, calls, seed) if space else [{}]
    return best_candidate(score_candidates(df, code, candidates, folds, hw_grid))


def validation_run(df: DataFrame, grids: dict[str, dict] | None = None, folds: Folds | None = None, hw_grid=None,
                   search: bool = True) -> DataFrame:
    """All six models: the best candidate of each, with its mean error as ``mse``."""
    out = None
    for code in NAMES:
        grid = (grids or GRIDS)[code] if search else {k: [v] for k, v in DEFAULTS[code].items()}
        best = best_candidate(grid_search(df, code, grid, folds, hw_grid))
        out = best if out is None else out.unionByName(best)
    return out.withColumnRenamed("mean_mse", "mse")
