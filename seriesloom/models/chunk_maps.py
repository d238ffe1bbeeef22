"""States before the chunks of a series, when each chunk maps the state before it to the one after.

``scan_states`` follows affine maps: they compose associatively, so groups of chunks are composed side by
side, and one row a group goes through the scan by series. ``settle`` solves maps that are not affine by
Newton's method on the chunk borders: every chunk is run from a guessed state and gives its exit and its
derivative there; these affine maps are scanned for better guesses; only chunks whose guess
moved run again. The chunk after an exact state is exact in the next round, so the rounds end at the result of the
recursion in order, and where chunks forget their entry they need a few only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import materialize
from .blocks import chunk_runs

FAN = 512  # chunks of a scan group
STILL = 1e-13  # relative change below which a state stands still
_NEAR = "k string, grp long, turn long, start array<double>, jac array<double>, off array<double>"


def _apply(jac, off: np.ndarray, state: np.ndarray) -> np.ndarray:
    """``jac`` times ``state`` plus ``off``; no ``jac`` means that the state before is forgotten."""
    if jac is None:
        return off
    with np.errstate(all="ignore"):
        return (np.asarray(jac).reshape(*off.shape, off.shape[-1]) @ state[..., None])[..., 0] + off


def _compose_groups(dim: int):
    """Maps from the entry of each group to the exit of each of its chunks."""

    def run(batches):
        held: dict = {}
        for part in chunk_runs(batches, "turn"):
            jacs, offs = [], []
            for k, grp, jac, off in zip(part["k"], part["grp"], part["jac"], part["off"]):
                b = np.asarray(off).reshape(-1, dim)
                first_jac, first_off = held.get((k, grp), ("none", None))
                a = None if jac is None else np.asarray(jac).reshape(*b.shape, dim)
                if first_off is not None:
                    b = _apply(a, b, first_off)
                    a = None if a is None or first_jac is None else a @ first_jac
                held[k, grp] = (a, b)
                jacs.append(None if a is None else a.ravel())
                offs.append(b.ravel())
            yield part[["k", "grp", "turn", "start"]].assign(jac=jacs, off=offs)

    return run


def _follow(dim: int):
    """State after each row, in order, from the start of the series."""

    def run(batches):
        held: dict = {}
        for part in chunk_runs(batches, "turn"):
            out = []
            for k, start, jac, off in zip(part["k"], part["start"], part["jac"], part["off"]):
                b = np.asarray(off).reshape(-1, dim)
                state = _apply(jac, b, held[k] if k in held else np.tile(np.asarray(start), (len(b), 1)))
                held[k] = state
                out.append(state.ravel())
            yield pd.DataFrame({"k": part["k"], "turn": part["turn"], "state": out})

    return run


def _from_groups(dim: int):
    def run(batches):
        for part in batches:
            out = []
            for start, far, jac, off in zip(part["start"], part["far"], part["jac"], part["off"]):
                b = np.asarray(off).reshape(-1, dim)
                out.append(_apply(jac, b, np.tile(np.asarray(start), (len(b), 1)) if far is None else np.asarray(far).reshape(b.shape)).ravel())
            yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"], "state": out})

    return run


def scan_states(maps: DataFrame, dim: int, fan: int = FAN) -> DataFrame:
    """``(k, chunk, state)`` before every chunk after the first, from ``(k, chunk, start, jac, off)`` of the chunks before it.

    ``off`` and ``state`` hold ``dim`` values for each candidate, ``start`` those that all candidates have in
    common, ``jac`` a matrix for each, or NULL where the chunk forgets its entry.
    """
    rows = maps.select("k", F.floor(F.col("chunk") / fan).alias("grp"), F.pmod(F.col("chunk"), F.lit(fan)).alias("turn"), "start", "jac", "off")
    near = rows.repartition("k", "grp").sortWithinPartitions("turn", "k").mapInPandas(_compose_groups(dim), _NEAR)
    far = F.lit(None).cast("array<double>")
    if (maps.agg(F.max("chunk")).first()[0] or 0) >= fan:
        near = materialize(near, "group-maps")
        ends = near.filter(F.col("turn") == fan - 1).select("k", F.col("grp").alias("turn"), "start", "jac", "off")
        after = ends.repartition("k").sortWithinPartitions("turn", "k").mapInPandas(_follow(dim), "k string, turn long, state array<double>")
        near = near.join(after.select("k", (F.col("turn") + 1).alias("grp"), F.col("state").alias("far")), ["k", "grp"], "left")
        far = F.col("far")
    spots = near.select("k", (F.col("grp") * fan + F.col("turn") + 1).cast("long").alias("chunk"), "start", "jac", "off", far.alias("far"))
    return spots.mapInPandas(_from_groups(dim), "k string, chunk long, state array<double>")


def _moved(dim: int):
    """Whether a state is another one; the first two values of it are measured by the size of the level, the others by their own."""

    @pandas_udf("boolean")
    def moved(new: pd.Series, old: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(new, old):
            if y is None:
                out.append(True)
                continue
            a, b = (np.asarray(v).reshape(-1, dim) for v in (x, y))
            size = np.abs(a)
            size[:, :2] = size[:, :1]
            with np.errstate(all="ignore"):
                same = (np.abs(a - b) <= STILL * size) | (~np.isfinite(a) & ~np.isfinite(b))
            out.append(not same.all())
        return pd.Series(out, dtype=bool)

    return moved


def settle(chunks: DataFrame, dim: int, run: Callable, fan: int = FAN, rounds: int = 60) -> tuple[DataFrame, int]:
    """States before every chunk after the first, and the rounds taken; ``run`` maps ``chunks`` with ``state`` to ``(k, chunk, start, jac, off)``.

    ``state`` is NULL in the first round and for first chunks. Chunks that still move after all ``rounds`` stop the run.
    """
    schema = "k string, chunk long, start array<double>, jac array<double>, off array<double>"
    guess = F.lit(None).cast("array<double>")
    maps = materialize(chunks.withColumn("state", guess).mapInPandas(run, schema), "chunk-maps")
    states = materialize(scan_states(maps, dim, fan).withColumn("moved", F.lit(True)), "states")
    for turn in range(1, rounds + 1):
        again = chunks.join(states.filter("moved").drop("moved"), ["k", "chunk"])
        again = materialize(again.mapInPandas(run, schema), "chunk-maps")
        kept = maps.join(again.select("k", "chunk"), ["k", "chunk"], "left_anti")
        maps = materialize(kept.unionByName(again), "chunk-maps")
        new = scan_states(maps, dim, fan).join(states.select("k", "chunk", F.col("state").alias("old")), ["k", "chunk"])
        states = materialize(new.select("k", "chunk", "state", _moved(dim)("state", "old").alias("moved")), "states")
        if states.filter("moved").isEmpty():
            return states.drop("moved"), turn
    raise ValueError("chunk states do not settle; use longer chunks")
