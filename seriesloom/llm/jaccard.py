"""Exact self-join of documents by the Jaccard similarity of their word n-grams.

Universe partition and pigeonhole: n-grams are hashed into segments. If two sets of sizes in a band
can differ in at most ``h`` n-grams, ``h + 1`` segments cannot all differ, so a linked pair agrees in
one of them. A segment may instead count double, if its set is indexed together with every set that
lacks one of its n-grams: then it also finds pairs that differ there by one. And a segment may count
nothing: a set that differs from any set it can be linked with by ``d`` n-grams at most agrees with
it in all but ``d`` segments, so the ``d + 1`` segments with the most n-grams (ties by hash) of each of
the two have one in common, and the weaker ones, which unrelated texts share, are left out. For each
size band the numbers of single and double segments and of segments to spare are chosen by cost:
signatures to be shuffled, against the pairs that weak segments (empty, or doubles with one n-gram at
most) would bring together by chance, from the number of documents in the band. Every pair that
shares a signature is a candidate; candidates are verified exactly on their whole sets.

Documents with equal sets are one class from the start, so copies are never paired. Candidate pairs
are not listed either: classes that share a signature are joined to stars, by the band that the
signature is of, and the stars to candidate components. The sets of one component meet in a task,
which verifies each class against the later ones of other groups and returns a spanning set of the
links it found; so a group of near copies moves its sets once, and no link between components is
lost. A component may also be a long chain of stars that unrelated texts form by a passage they
share. If it is larger than a block, its sets therefore meet star by star, where all that share a
signature are together, and only a star that is itself larger is cut into blocks.

N-grams and sets are compared by 64-bit hashes (two for a class).

Defined cases: a null or empty text, or one without words, has an empty set and is linked with
nothing; its component is itself. A text of fewer words than an n-gram is one n-gram. Rows that are
repeated share a component. A row without doc_id takes part, but lends its component no id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import WORD, filled, free_name, map_rows, release
from seriesloom.llm.components import components
from seriesloom.llm.sieve import free
from seriesloom.llm.words import mix, slices
from seriesloom.session import materialize

_U = np.uint64
FILTER_BITS = 24  # size of the bitmap that keeps texts without a candidate from being hashed into sets again
PAIR_COST = 20.0  # of a pair brought together by chance, in signatures
BLOCK_TOKENS = 1 << 18  # n-grams of one component or star that meet in a task at most, from each side
BAND_BITS = 7  # of a signature that hold its band


@dataclass(frozen=True)
class Scheme:
    """Segments for pairs whose larger set lies in a size band."""

    singles: int
    doubles: int
    slack: int = 0  # single segments to spare, so that weak ones can be left out
    most: int = 0  # size of the largest sets

    @property
    def units(self) -> int:
        return self.singles + 2 * self.doubles


def band_starts(most: int, over: int, under: int) -> np.ndarray:
    """First sizes of the bands: linked sets (ratio ``over / under``) lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * under // over)))
    return np.array(starts, np.int64)


def allocate(least: int, most: int, docs: int, over: int, under: int) -> Scheme | None:
    """The cheapest segments for sets of ``least`` to ``most`` n-grams; None if linked sets must be equal."""
    h = 2 * most * (under - over) // (under + over)
    if h == 0:
        return None
    best = None
    for doubles in sorted({0, 1, 2, 4, (h + 1) // 4, (h + 2) // 2}):
        needed = max(0, h + 1 - 2 * doubles)
        if needed == 0 and 2 * doubles > h + 2:
            continue
        for slack in sorted({math.ceil(needed * x / 10) for x in (4, 6, 8)}) if needed else (0,):
            singles = needed + slack
            share = least / (singles + 2 * doubles)  # n-grams in a single segment
            signatures = docs * (singles + doubles * (1 + 2 * share))
            empty = singles * math.exp(-share)
            # Sets with more empty segments than the slack, and how often one of them shows a given segment empty.
            left = docs * above(slack, empty) * (slack + 1) / max(singles, 1)
            chance = singles * left**2 / 2 + doubles * (docs * (1 + 2 * share) * math.exp(-2 * share)) ** 2 / 2
            if best is None or signatures + PAIR_COST * chance < best[0]:
                best = (signatures + PAIR_COST * chance, Scheme(singles, doubles, slack, most))
    return best[1]


def above(k: int, mean: float) -> float:
    """Probability that a Poisson number of this mean is above ``k``."""
    term = below = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        below += term
    return max(0.0, 1 - below)


def text_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, n-grams, bounds) for slices: the different n-grams of each text, sorted."""
    for a, b, words in slices(texts):
        grams, text = words.shingles(width)
        bounds = np.searchsorted(text, np.arange(b - a + 1))
        for i in range(b - a):
            grams[bounds[i] : bounds[i + 1]].sort()
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        yield a, b, grams[keep], np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=b - a))]).astype(np.int64)


def class_keys(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set, from two sums over hashes of its n-grams and its size."""
    def sums(values):
        total = np.concatenate([[_U(0)], np.cumsum(values, dtype=_U)])
        return total[bounds[1:]] - total[bounds[:-1]]

    one, two = sums(mix(grams)), sums(mix(grams ^ _U(0x5851F42D4C957F2D)))
    return mix(mix(one + np.diff(bounds).astype(_U)) + two).astype(np.int64)


def signatures(grams: np.ndarray, bounds: np.ndarray, bands: np.ndarray, schemes: list[Scheme | None], over: int, under: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text) of all sets: under the scheme of their own band and of the next, in the lowest ``BAND_BITS`` bits."""
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    band = np.searchsorted(bands, sizes, "right") - 1
    low, high = (grams & _U(0xFFFFFFFF)).astype(np.float64), (grams >> _U(32)).astype(np.float64)
    known = [s or Scheme(0, 0) for s in schemes] + [Scheme(0, 0)]
    singles, doubles, largest = (np.array([getattr(s, f) for s in known]) for f in ("singles", "doubles", "most"))
    out_sig, out_text = [], []
    for more in (0, 1):
        scheme = np.minimum(np.maximum(band, 0) + more, len(known) - 1)
        s, d = singles[scheme], doubles[scheme]
        segments = np.where(sizes > 0, s + d, 0)
        first = np.concatenate([[0], np.cumsum(segments)])
        if not first[-1]:
            continue
        use = segments[text] > 0
        of = text[use]
        unit = (mix(grams[use] + _U(0x2545F4914F6CDD1D)) % (s + 2 * d)[of].astype(_U)).astype(np.int64)
        segment = np.where(unit < s[of], unit, s[of] + (unit - s[of]) // 2)
        at = first[of] + segment
        # Sums of halves are exact in doubles.
        lows, highs = np.bincount(at, low[use], first[-1]), np.bincount(at, high[use], first[-1])
        owner = np.repeat(np.arange(len(sizes)), segments)
        place = np.arange(first[-1]) - first[owner]
        salt = mix((scheme[owner] * 1_000_003 + place).astype(_U))

        def sign(lo, hi, own, band):
            h = mix(mix(lo.astype(_U) + own) + hi.astype(_U) * _U(0x9E3779B97F4A7C15))
            return h >> _U(BAND_BITS) << _U(BAND_BITS) | (band.astype(_U) & _U((1 << BAND_BITS) - 1))

        signed = sign(lows, highs, salt, scheme[owner])
        # Without doubles, a set shows as many of its strongest segments as it can differ from a linked set, and one more.
        differ = (under - over) * (sizes + np.minimum(largest[scheme], sizes * under // over)) // (under + over)
        order = np.lexsort((signed, -np.bincount(at, minlength=first[-1]), owner))
        rank = np.empty(first[-1], np.int64)
        rank[order] = place  # owners are in order already
        shown = (d > 0)[owner] | (rank <= differ[owner])
        out_sig.append(signed[shown])
        out_text.append(owner[shown])
        lacking = np.flatnonzero(segment >= s[of])
        if len(lacking):
            k = at[lacking]
            out_sig.append(sign(lows[k] - low[use][lacking], highs[k] - high[use][lacking], salt[k], scheme[of[lacking]]))
            out_text.append(of[lacking])
    if not out_sig:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_text)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Bits of each set: where an odd number of its n-grams fall. Two sets differ in as many n-grams as bits, or more."""
    sizes = np.array([len(x) for x in sets], np.int64)
    words = 1 << max(0, int(sizes.mean()) >> 5).bit_length()
    bit = mix(np.concatenate(sets) ^ _U(0x2545F4914F6CDD1D)) % _U(64 * words)
    out = np.zeros(len(sets) * words, _U)
    np.bitwise_xor.at(out, np.repeat(np.arange(len(sets)) * words, sizes) + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return out.reshape(len(sets), words)


def linked(sets: list[np.ndarray], side: np.ndarray, over: int, under: int) -> list[tuple[int, int]]:
    """A spanning set of the links between ``sets`` (smallest first): every linked pair is connected by the result.

    ``side``: 0 and 1 for the two blocks of a component, whose sets are only compared across (links
    within a block are found where the block meets itself), or all 0. Only sets whose sizes and
    sketches let them be linked are compared by their n-grams.
    """
    n = len(sets)
    across = bool(side.any())
    sizes = np.array([len(x) for x in sets], np.int64)
    sketch = sketches(sets)
    ends = np.searchsorted(sizes, sizes * under // over, "right")
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(flat.max() + 1, bool)
    group = np.arange(n)
    out = []
    for x in range(n - 1):
        end = ends[x]
        other = group[x + 1 : end] != group[x]
        if across:
            other &= side[x + 1 : end] != side[x]
        rest = np.flatnonzero(other) + x + 1
        if not len(rest):
            continue
        differ = np.bitwise_count(sketch[rest] ^ sketch[x]).sum(axis=1, dtype=np.int64)
        rest = rest[differ * (under + over) <= (sizes[x] + sizes[rest]) * (under - over)]
        if not len(rest):
            continue
        first = np.concatenate([[0], np.cumsum(sizes[rest])])
        at = np.arange(first[-1]) + np.repeat(starts[rest] - first[:-1], sizes[rest])
        own = flat[starts[x] : starts[x + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[flat[at]], first[:-1], dtype=np.int64)
        mark[own] = False
        hits = rest[under * both >= over * (sizes[x] + sizes[rest] - both)]
        for y in hits:
            if group[y] != group[x]:
                group[group == group[y]] = group[x]
                out.append((x, int(y)))
    return out


def classes(docs: DataFrame, width: int, keep: list[str] = ["doc_id"]) -> DataFrame:
    """``keep``, n_shingles and c (key of the set) of each row."""

    def make():
        def work(texts: pa.Array) -> list:
            sizes, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, grams, bounds in text_sets(texts, width):
                sizes.append(np.diff(bounds))
                keys.append(class_keys(grams, bounds))
            return [pa.array(np.concatenate(sizes)), pa.array(np.concatenate(keys))]

        return work

    return map_rows(docs, keep, make, [T.StructField("n_shingles", T.LongType()), T.StructField("c", T.LongType())])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def _signed(docs: DataFrame, width: int, bands: np.ndarray, schemes: list[Scheme | None], over: int, under: int) -> DataFrame:
    """(s, c): signatures of the classes; a class that a task has met before is not signed again."""

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for _, _, grams, bounds in text_sets(filled(batch.column(0)), width):
                keys = class_keys(grams, bounds)
                new = np.zeros(len(keys), bool)
                for i, k in enumerate(keys.tolist()):
                    if k not in met:
                        met.add(k)
                        new[i] = bounds[i + 1] > bounds[i]
                sig, text = signatures(grams, bounds, bands, schemes, over, under)
                chosen = new[text]
                yield pa.RecordBatch.from_arrays([pa.array(sig[chosen].astype(np.int64)), pa.array(keys[text[chosen]])], names=["s", "c"])
            del batch
            release()

    return _texts(docs).mapInArrow(run, "s long, c long")


def _sets(docs: DataFrame, width: int, bitmap: np.ndarray) -> DataFrame:
    """(c, n, grams as bytes) of the classes that the bitmap lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2 ** FILTER_BITS bits

    def run(batches):
        met: set[int] = set()
        bits = shared.value
        for batch in batches:
            for _, _, grams, bounds in text_sets(filled(batch.column(0)), width):
                keys = class_keys(grams, bounds)
                slot = keys & ((1 << FILTER_BITS) - 1)
                rows = []
                for i in np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).tolist():
                    k = int(keys[i])
                    if k not in met:
                        met.add(k)
                        rows.append((k, int(bounds[i + 1] - bounds[i]), grams[bounds[i] : bounds[i + 1]].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=["c", "n", "grams"])
            del batch
            release()

    return _texts(docs).mapInArrow(run, "c long, n long, grams binary")


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """Bits of the low part of each node; a bitmap of fixed size, whatever the number of nodes."""
    slot = F.col("node").bitwiseAND((1 << FILTER_BITS) - 1)
    rows = nodes.groupBy(F.shiftright(slot, 5).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(node & 31 as int))")).alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().astype(np.uint32)
    return words.view(np.uint8)


def _verified(grouped: DataFrame, over: int, under: int) -> DataFrame:
    """Links (a, b) from rows (g, band, x, y, side, c, grams) of which those of a (g, band, x, y) meet."""

    def run(batches):
        held, keys, sides, sets = None, [], [], []

        def close():
            if len(keys) > 1:
                order = np.argsort(np.array([len(s) for s in sets]), kind="stable")
                found = linked([sets[i] for i in order], np.array([sides[i] for i in order]), over, under)
                if found:
                    a, b = zip(*[(keys[order[i]], keys[order[j]]) for i, j in found])
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            gs, bands, xs, ys, side, cs = (batch.column(i).to_pylist() for i in range(6))
            grams = batch.column(6)
            for i in range(batch.num_rows):
                at = (gs[i], bands[i], xs[i], ys[i])
                if at != held:
                    yield from close()
                    held, keys, sides, sets = at, [], [], []
                keys.append(cs[i])
                sides.append(side[i])
                sets.append(np.frombuffer(grams[i].as_buffer(), _U))
        yield from close()

    return grouped.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, counted: DataFrame, width: int, over: int, under: int) -> DataFrame:
    """Links (a, b) between classes that connect all classes with ``under * common >= over * union``.

    ``counted``: the written result of ``classes``.
    """
    most = counted.agg(F.coalesce(F.max("n_shingles"), F.lit(0))).head()[0]
    bands = band_starts(most, over, under)
    # One row for each band: their number grows with the logarithm of the longest text.
    band = F.lit(0)
    for i, start in enumerate(bands.tolist()):
        band = F.when(F.col("n_shingles") >= start, i).otherwise(band)
    rows = counted.filter("n_shingles > 0").groupBy("c").agg(F.first("n_shingles").alias("n_shingles")).groupBy(band.alias("band")).count().collect()
    filling = {r["band"]: r["count"] for r in rows}
    schemes = []
    for i in range(len(bands)):
        end = int(bands[i + 1]) - 1 if i + 1 < len(bands) else int(bands[i])
        least = -(-int(bands[i]) * over // under)
        schemes.append(allocate(least, end, filling.get(i, 0) + filling.get(i - 1, 0), over, under) if filling.get(i) else None)
    signed = _signed(docs, width, bands, schemes, over, under)
    from pyspark.sql import Window as W

    star = signed.withColumn("m", F.min("c").over(W.partitionBy("s"))).filter(F.col("c") != F.col("m"))
    star = materialize(star.select("c", "m", F.col("s").bitwiseAND((1 << BAND_BITS) - 1).cast("int").alias("band")).distinct(), "stars")
    del signed
    free(docs.sparkSession)
    reach = materialize(components(star.select(F.col("c").alias("a"), F.col("m").alias("b"))), "candidates")
    members = meeting(star, counted, reach)
    sets = _sets(docs, width, _bitmap(reach)).dropDuplicates(["c"]).select("c", "grams")
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("x"), F.greatest("own", o).alias("y"), (F.col("own") > o).cast("int").alias("side")))
    spread = sets.join(members, "c").withColumn("own", own).select("g", "band", F.inline(pairs), "c", "grams")
    met = ["g", "band", "x", "y"]
    grouped = spread.repartition(*met).sortWithinPartitions(*met).select(*met, "side", "c", "grams")
    found = materialize(_verified(grouped, over, under), "links")
    del sets, spread, grouped
    free(docs.sparkSession)
    return found


def meeting(star: DataFrame, counted: DataFrame, reach: DataFrame) -> DataFrame:
    """(g, band, c, blocks): the classes that meet in a group (g, band), which is cut into ``blocks``.

    Groups are candidate components (band -1); of those larger than a block, the stars (c, m, band) in them.
    """
    known = counted.filter("n_shingles > 0").groupBy("c").agg(F.first("n_shingles").alias("n"))
    nodes = materialize(known.join(reach, known["c"] == reach["node"]).select("c", "root", "n"), "candidate-sizes")
    # Tables of what is larger than a block have at most a row for each block of the corpus.
    tokens = F.sum("n").alias("tokens")
    large = materialize(nodes.groupBy(F.col("root").alias("of")).agg(tokens).filter(F.col("tokens") > BLOCK_TOKENS).select("of"), "large-components")
    placed = nodes.join(large, F.col("root") == F.col("of"), "left")
    whole = placed.filter(F.col("of").isNull()).select(F.col("root").alias("g"), F.lit(-1).alias("band"), "c", "n")
    inside = placed.filter(F.col("of").isNotNull()).select("c", "n")
    spokes = star.join(inside, "c").select(F.col("m").alias("g"), "band", "c", "n")
    hubs = star.select(F.col("m").alias("c"), "band").distinct().join(inside, "c").select(F.col("c").alias("g"), "band", "c", "n")
    members = materialize(whole.unionByName(spokes).unionByName(hubs), "candidate-groups")
    cut = members.groupBy(F.col("g").alias("of"), F.col("band").alias("at")).agg(tokens).filter(F.col("tokens") > BLOCK_TOKENS)
    cut = materialize(cut.select("of", "at", F.ceil(F.col("tokens") / BLOCK_TOKENS).cast("int").alias("cut")), "large-groups")
    placed = members.join(cut, (F.col("g") == F.col("of")) & (F.col("band") == F.col("at")), "left")
    return placed.select("g", "band", "c", F.coalesce("cut", F.lit(1)).alias("blocks"))


def class_roots(docs: DataFrame, counted: DataFrame, width: int, over: int, under: int) -> DataFrame:
    """(c, root) of every class with words: classes with one root are connected by links."""
    roots = components(links(docs, counted, width, over, under))
    known = counted.filter("n_shingles > 0").select("c").distinct()
    found = materialize(known.join(roots, known["c"] == roots["node"], "left").select("c", F.coalesce("root", "c").alias("root")), "class-roots")
    del roots, known
    free(docs.sparkSession)
    return found


def near_duplicates(docs: DataFrame, width: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id linked, itself included)."""
    counted = materialize(classes(docs, width), "shingle-classes")
    roots = class_roots(docs, counted, width, over, under)
    first = counted.filter("n_shingles > 0").groupBy("c").agg(F.min("doc_id").alias("first")).join(roots, "c")
    ids = first.groupBy("root").agg(F.min("first").alias("component_id"))
    out = counted.join(roots.join(ids, "root").select("c", "component_id"), "c", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, width: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id. Rows without words all stay."""
    hashed, of, none = (free_name(docs, c) for c in ("_text", "_of", "_none"))
    keyed = docs.withColumn(hashed, F.xxhash64(F.col("text").cast("string")))
    counted = materialize(classes(keyed.select("doc_id", "text", F.col(hashed).alias("t")), width, ["doc_id", "t"]), "shingle-classes")
    roots = class_roots(docs, counted, width, over, under)
    chosen = counted.filter("n_shingles > 0").groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("row")).join(roots, "c")
    row = F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias("_d"), F.col("row.none").alias("_n"), F.col("row.t").alias("_t")
    chosen = materialize(chosen.groupBy("root").agg(F.min("row").alias("row")).select(*row), "representatives")
    free(docs.sparkSession)
    has_words = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    # The join and the removal of repeated rows go by the same columns, none of them null, so texts move once.
    keyed = keyed.withColumns({of: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), none: F.col("doc_id").isNull()})
    kept = keyed.filter(has_words).join(chosen, (keyed[of] == chosen["_d"]) & (keyed[none] == chosen["_n"]) & (keyed[hashed] == chosen["_t"]), "left_semi")
    return kept.dropDuplicates([of, none, hashed]).select(*docs.columns).unionByName(docs.filter(~has_words))
