"""Scores of texts by a probabilistic suffix tree over words.

The root is the add-one unigram distribution of the training tokens (words in lower case and one end
per text; everything unknown is one more token). The tree grows level by level: the contexts of d words
are those that occur ``Settings.least`` times, and each becomes a state if its next words differ from
those of its longest suffix: the divergence over the next words that follow it ``least`` times and
the rest, times its count, must beat a penalty of half a log count for each such word. Growth ends at
the first level without a state. A state gives its next words their discounted share and leaves
the rest to its suffix, in that one's proportions, so every state is a distribution over all tokens.
A token is scored in the longest state that its text ends in there.

All counts cover all training texts and no share of the corpus limits them: least counts are absolute.
Each level is a distributed count of n-grams, and states and entries are tables keyed by n-gram hash.
For scoring, each part of the texts asks for its own different n-grams and gets them back in one
task, so that a hot n-gram is asked for once a part. N-grams travel as packed arrays, a row for each
range of hashes; parts are scored in ``WAVES`` turns, so that only one turn's asks, answers and texts are
on disk at once. Two things are broadcast and change no result: the
most frequent words, states and entries (the head, bounded by the shares in ``Settings``), and bits of
hashes (at most 2^``bits``), which spare counting or asking for n-grams that are surely not there.

Words are compared by 64-bit hashes. Defined cases: a null or empty text is one end token. Repeated
rows count and are scored each. Without training texts every token has probability 1.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import filled, release
from seriesloom.llm.words import Words, slices
from seriesloom.session import materialize

_U = np.uint64
END = _U(0x1D8AF066F5B3C9E7)
SHIFT = 24  # of a context's number in keys of context and word
FLUSH = 1_000_000  # tokens counted together in a task
STEP = _U(0x9E3779B97F4A7C15)  # an n-gram's hash is that of its first n - 1 words times this, plus its last word's
PART = 12  # bits of the row number within a part
WAVES = 8  # turns in which texts are scored, of at least WAVE_PARTS parts
WAVE_PARTS = 2


@dataclass(frozen=True)
class Settings:
    head_share: float = 5e-7  # words from this share of all tokens are broadcast
    word_share: float = 1e-5  # not used any more
    context_share: float = 5e-5  # not used any more
    entry_share: float = 2e-6  # states and entries from this share of all tokens are broadcast
    least: int = 16  # count below which no context or entry is kept
    discount: float = 0.5
    bits: int = 28  # of the hash that are kept to spare needless n-grams


@dataclass(frozen=True)
class Tree:
    tokens: int  # in training
    kinds: int
    depth: int  # words of the longest state
    head: np.ndarray  # sorted hashes of the head words, and
    head_counts: np.ndarray
    hot: np.ndarray  # sorted hashes of the frequent n-grams that are states or entries
    hot_share: np.ndarray  # discounted share in the state of all words but the last; 0 if that is none
    hot_rest: np.ndarray  # what the n-gram leaves to its suffix as a state; 1 if it is none
    sieve: np.ndarray  # bits of all states and entries
    nodes: DataFrame | None = None  # (key, n, share, rest) of all states and entries; not broadcast

    @property
    def words(self) -> np.ndarray:
        return self.head

    def _under(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the context, number of the word, share) of the frequent entries of ``contexts``."""
        found = [], [], []
        for number in range(len(contexts)):
            at = find(self.hot, contexts[number : number + 1] * STEP + self.head)
            ids = np.flatnonzero(at >= 0)
            ids = ids[self.hot_share[at[ids]] > 0]
            for f, v in zip(found, (np.full(len(ids), number), ids, self.hot_share[at[ids]])):
                f.append(v)
        return tuple(np.concatenate([np.zeros(0), *f]) for f in found)

    # The frequent states of one and two words, by numbers of head words.
    @cached_property
    def rest1(self) -> np.ndarray:
        at = find(self.hot, self.head)
        return np.where(at >= 0, self.hot_rest[at] if len(self.hot) else 1.0, 1.0)

    @cached_property
    def _one(self) -> tuple[np.ndarray, np.ndarray]:
        states = np.flatnonzero(self.rest1 < 1)
        of, ids, share = self._under(self.head[states])
        return (states[of.astype(int)] << SHIFT) | ids.astype(int), share

    keys1 = property(lambda self: self._one[0])
    shares1 = property(lambda self: self._one[1])

    @cached_property
    def _two(self) -> tuple[np.ndarray, ...]:
        found = []
        for first in range(len(self.head)):
            at = find(self.hot, self.head[first : first + 1] * STEP + self.head)
            second = np.flatnonzero(at >= 0)
            found.append((first << SHIFT) | second[self.hot_rest[at[second]] < 1])
        states = np.concatenate([np.zeros(0, np.int64), *found])
        hashes = self.head[states >> SHIFT] * STEP + self.head[states & ((1 << SHIFT) - 1)]
        of, ids, share = self._under(hashes)
        return states, self.hot_rest[find(self.hot, hashes)], (of.astype(int) << SHIFT) | ids.astype(int), share

    pairs = property(lambda self: self._two[0])
    rest2 = property(lambda self: self._two[1])
    keys2 = property(lambda self: self._two[2])
    shares2 = property(lambda self: self._two[3])


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with an end after them, and the text of each token."""
    n = len(w.counts)
    out = np.full(len(w.starts) + n, END, _U)
    out[np.arange(len(w.starts)) + w.text] = w.hashes()
    return out, np.repeat(np.arange(n), w.counts + 1)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key in the sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def places(text: np.ndarray) -> np.ndarray:
    """Number of tokens before each token in its text."""
    first = np.flatnonzero(np.diff(text, prepend=-1))
    return np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))


def longer(grams: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams that end at each token, from those of n - 1; only right where the text has n tokens by then."""
    out = t.copy()
    out[1:] += grams[:-1] * STEP
    return out


def there(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are surely not in the sieve."""
    at = keys >> _U(64 - int(len(sieve) * 8).bit_length() + 1)
    return (sieve[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0


def sieve_of(keys: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, those set that the first bits of a key point to."""
    at = F.shiftrightunsigned("key", 64 - bits)
    rows = keys.groupBy(F.shiftright(at, 15).alias("bucket")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for bucket, part in zip(rows.column(0).to_pylist(), rows.column(1)):
        out[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(part.as_buffer(), np.uint8)
    return out


def fitting(n: int, s: Settings) -> int:
    """Bits for ``n`` keys."""
    return min(s.bits, max(15, (16 * n).bit_length()))


def range_bits(spark) -> int:
    """Bits of a hash that say its range: some ranges for each partition of a shuffle."""
    return min(12, max(6, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2))


def packed(ranges: np.ndarray, bits: int, columns: dict[str, np.ndarray], **same: int) -> Iterator[pa.RecordBatch]:
    """Rows of range, constants and the bytes of each column, for values in the order of their range."""
    cuts = np.searchsorted(ranges, np.arange((1 << bits) + 1))
    used = np.flatnonzero(np.diff(cuts))
    for some in np.array_split(used, max(1, len(ranges) >> 18)):  # small batches
        if len(some):
            rows = {"range": pa.array(some), **{c: pa.array(np.full(len(some), v)) for c, v in same.items()}}
            yield pa.RecordBatch.from_pydict(rows | {c: pa.array([v[cuts[r] : cuts[r + 1]].tobytes() for r in some], pa.binary()) for c, v in columns.items()})


def unpacked(column: pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def ranges_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> _U(64 - bits)).astype(np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where in it each different one starts."""
    order = np.argsort(keys)
    return order, np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)[: len(order)])


def counted(texts: DataFrame, keys, names: list[str], least: int = 1, hot: np.ndarray | None = None) -> DataFrame:
    """(names, n): first values that occur ``least`` times, and how often; ``keys`` maps hashes and texts of a slice to arrays, the first of which says the others.

    Rows of one context go to one range, where equal values side by side take little place; those of the ``hot`` contexts are spread.
    """
    bits = range_bits(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            order, first = runs(columns[0])
            n = np.diff(np.append(first, len(order)))
            columns = [c[order[first]] for c in columns]
            ranges = ranges_of(columns[0], bits)
            if len(columns) > 1:
                order = np.argsort(columns[1])
                ranges = np.where(find(hot, columns[1]) >= 0, ranges, ranges_of(columns[1], bits))
                order = order[np.argsort(ranges[order].astype(np.uint16), kind="stable")]
                ranges, n, columns = ranges[order], n[order], [c[order] for c in columns]
            return packed(ranges, bits, dict(zip([*names, "n"], [*columns, n])))

        for batch in batches:
            for _, _, w in slices(filled(batch.column(0))):
                held.append(keys(*tokens(w)))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()
        release()

    def total(rows: pa.Table) -> pa.Table:
        key, *others = (unpacked(rows.column(c)) for c in [*names, "n"])
        order, first = runs(key)
        n = np.add.reduceat(others[-1][order], first) if len(first) else np.zeros(0, np.int64)
        at = order[first[n >= least]]
        return pa.table([*(pa.array(c[at]) for c in (key, *others[:-1])), pa.array(n[n >= least])], names=[*names, "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, ", ".join(["range long", *(f"{c} binary" for c in [*names, "n"])]))
    return rows.groupBy("range").applyInArrow(total, ", ".join(f"{c} long" for c in [*names, "n"]))


def with_suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns the context without its first word (0 for a word) into the n-gram without its first word."""
    for b in batches:
        key, context, inner = (b.column(c).to_numpy().view(_U) for c in (0, 1, 2))
        suffix = inner * STEP + (key - context * STEP)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(suffix.view(np.int64)), b.column(3)], names=["key", "context", "suffix", "n"])


def spent(spark) -> None:
    """Lets Spark delete the shuffle files of tables that are stored by now."""
    for _ in range(2):  # what a query's last events hold goes with the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def _gathered(counts: DataFrame, least: float, columns: list[str]) -> list[np.ndarray]:
    """Keys and columns of the rows with a count of at least ``least``, sorted by key."""
    rows = counts.filter(F.col("n") >= least).select("key", *columns).toArrow()
    keys, *others = (c.to_numpy() for c in rows.columns)
    order = np.argsort(keys.view(_U))
    return [keys.view(_U)[order], *(c[order] for c in others)]


def grow(texts: DataFrame, s: Settings = Settings()) -> tuple[Tree, DataFrame]:
    """The tree of the training ``texts``, and the counts of all words (key, n)."""
    spark = texts.sparkSession
    unigrams = materialize(counted(texts, lambda t, _: (t,), ["key"]), "unigrams")
    total, kinds = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    head, head_counts = _gathered(unigrams, max(2, s.head_share * total), ["n"])

    # (key, n, prob) of the n-grams of one length: prob is the last word's after the others.
    level = unigrams.filter(F.col("n") >= s.least).select("key", "n", ((F.col("n") + 1) / F.lit(float(total + kinds + 1))).alias("prob"))
    depth, parts, size = 0, [], level.count()
    while size and depth < 2:
        sieve = spark.sparkContext.broadcast(sieve_of(level, fitting(size, s)))

        # A context from this share of all tokens is spread over ranges; there are at most as many.
        hot, *_ = _gathered(level, max(s.least, total / (1 << range_bits(spark))), [])

        def extended(t, text, depth=depth + 1, sieve=sieve):
            inner, grams = np.zeros(len(t), _U), t
            for _ in range(depth - 1):
                inner, grams = grams, longer(grams, t)
            use = places(text) >= depth - 1
            use[use] = there(sieve.value, grams[use])
            use[1:] &= use[:-1]
            use &= places(text) >= depth
            at = np.flatnonzero(use)
            return longer(grams, t)[at], grams[at - 1], inner[at - 1]

        # What is frequent has a frequent suffix, so the join loses nothing.
        found = counted(texts, extended, ["key", "context", "inner"], s.least, hot)
        found = found.mapInArrow(with_suffix, "key long, context long, suffix long, n long")
        found = materialize(found.join(level.select(F.col("key").alias("suffix"), F.col("prob").alias("expected")), "suffix").select("key", "context", "n", "expected"), "n-grams")
        n, expected, of = F.col("n"), F.col("expected"), F.col("total")
        sums = found.groupBy("context").agg(F.count("*").alias("entries"), F.sum("n").alias("seen"), F.sum(n * F.log(n / expected)).alias("gain"), F.sum("expected").alias("expected"))
        sums = sums.join(level.select(F.col("key").alias("context"), F.col("n").alias("total")), "context")
        left = of - F.col("seen")
        gain = F.col("gain") - F.col("seen") * F.log(of) + F.when(left > 0, left * F.log(left / of / F.greatest(1 - expected, F.lit(1e-12)))).otherwise(0.0)
        kept = gain > 0.5 * F.col("entries") * F.log(F.greatest(of, F.lit(2)))
        states = materialize(sums.filter(kept).select("context", "total", (1 - (F.col("seen") - s.discount * F.col("entries")) / of).alias("rest")), "states")
        n_states = states.count()
        if not n_states:
            break
        depth += 1
        share = F.coalesce((n - s.discount) / of, F.lit(0.0))
        level = materialize(found.join(states, "context", "left").select("key", "n", share.alias("share"), (share + F.coalesce("rest", F.lit(1.0)) * expected).alias("prob")), "level")
        parts.append(level.filter("share > 0").select("key", "n", "share", F.lit(1.0).alias("rest")))
        parts.append(states.select(F.col("context").alias("key"), F.col("total").alias("n"), F.lit(0.0).alias("share"), "rest"))
        size = level.count()
        del found, sums
        spent(spark)
    if not parts:
        none = np.zeros(0)
        return Tree(total, kinds, 0, head, head_counts, none.astype(_U), none, none, np.zeros(1 << 12, np.uint8)), unigrams
    nodes = reduce(DataFrame.unionAll, parts).groupBy("key").agg(F.max("n").alias("n"), F.max("share").alias("share"), F.min("rest").alias("rest"))
    nodes = materialize(nodes, "nodes")
    hot = _gathered(nodes, max(s.least, s.entry_share * total), ["share", "rest"])
    return Tree(total, kinds, depth, head, head_counts, *hot, sieve_of(nodes, fitting(nodes.count(), s)), nodes), unigrams


Pulled = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # sorted hashes, counts of words, shares, rests


def token_scores(m: Tree, t: np.ndarray, text: np.ndarray, pulled: Pulled | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, base, score) of each token as log10, with what the head does not hold from ``pulled``."""
    more = pulled or (np.zeros(0, _U), *[np.zeros(0)] * 3)
    at = find(m.head, t)
    count = np.where(at >= 0, m.head_counts[at] if len(m.head) else 0, 0)
    rare = np.flatnonzero(at < 0)
    at = find(more[0], t[rare])
    count[rare[at >= 0]] = more[1][at[at >= 0]]
    root = (count + 1) / (m.tokens + m.kinds + 1)
    p, place, grams = root.copy(), places(text), t
    rest = np.ones(len(t))
    for depth in range(m.depth + 1):
        share, own = np.zeros(len(t)), np.ones(len(t))
        use = np.flatnonzero(place >= depth)
        use = use[there(m.sieve, grams[use])]
        for table, shares, rests in ((m.hot, m.hot_share, m.hot_rest), (more[0], more[2], more[3])):
            at = find(table, grams[use])
            hit = at >= 0
            share[use[hit]], own[use[hit]] = shares[at[hit]], rests[at[hit]]
            use = use[~hit]
        if depth:
            p = share + rest * p
        rest[1:] = own[:-1]
        rest[place <= depth] = 1.0
        grams = longer(grams, t)
    return count, np.log10(root), np.log10(p)


def asked(m: Tree, t: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes of words and n-grams that the head does not hold and the tables may."""
    out, place, grams = [t[find(m.head, t) < 0]], places(text), t
    for depth in range(m.depth + 1):
        keys = grams[place >= depth]
        keys = np.unique(keys[there(m.sieve, keys)])
        out.append(keys[find(m.hot, keys) < 0])
        grams = longer(grams, t)
    return np.unique(np.concatenate(out))


def looked_up(m: Tree, unigrams: DataFrame, bits: int) -> DataFrame:
    """Words, states and entries, packed: one row for each range of hashes."""
    spark = unigrams.sparkSession
    both = unigrams.select("key", "n", F.lit(0.0).alias("share"), F.lit(1.0).alias("rest"))
    if m.nodes is not None:
        both = both.unionAll(m.nodes.select("key", F.lit(0).cast("long").alias("n"), "share", "rest"))

    def pack(rows: pa.Table) -> pa.Table:
        key, n, share, rest = (rows.column(c).to_numpy() for c in ("key", "n", "share", "rest"))
        key = key.view(_U)
        order, first = runs(key)
        merged = np.maximum.reduceat(n[order], first), np.maximum.reduceat(share[order], first), np.minimum.reduceat(rest[order], first)
        of = rows.column("range").slice(0, 1).cast(pa.int64())
        return pa.table([of, *(pa.array([c.tobytes()], pa.binary()) for c in (key[order[first]], *merged))], names=["range", "key", "n", "share", "rest"])

    rows = both.withColumn("range", F.shiftrightunsigned("key", 64 - bits))
    stored = materialize(rows.groupBy("range").applyInArrow(pack, "range long, key binary, n binary, share binary, rest binary"), "looked-up")
    del both, rows
    spent(spark)
    return stored


def answered(asks: pa.Table, table: pa.Table) -> pa.Table:
    """What the table holds of each row's keys."""
    key = unpacked(table.column("key"), _U)
    values = [unpacked(table.column(c), kind) for c, kind in (("n", np.int64), ("share", float), ("rest", float))]
    out = [], [], [], [], []
    for part, wanted in zip(asks.column("part").to_pylist(), asks.column("key").to_pylist()):
        at = find(key, np.frombuffer(wanted, _U))
        at = at[at >= 0]
        if len(at):
            for o, v in zip(out, (part, *(c[at].tobytes() for c in (key, *values)))):
                o.append(v)
    return pa.table([pa.array(o, pa.binary() if k else pa.int64()) for k, o in enumerate(out)], names=["part", "key", "n", "share", "rest"])


def score_texts(docs: DataFrame, m: Tree, unigrams: DataFrame, held_out: Column) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    shared, bits = spark.sparkContext.broadcast(replace(m, nodes=None)), range_bits(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.select("doc_id", "held_out", "text", F.shiftright("row", PART).alias("part")), "tree-texts")

    def ask(batches):
        tree, part, held = shared.value, None, []

        def flush():
            keys = np.unique(np.concatenate(held))
            return packed(ranges_of(keys, bits), bits, {"key": keys}, part=part)

        for batch in batches:
            parts = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if part != parts[a] and held:
                    yield from flush()
                    held = []
                part = parts[a]
                held.extend(asked(tree, *tokens(w)) for _, _, w in slices(filled(batch.column(0).slice(a, b - a))))
                if len(held) > 64:
                    held = [np.unique(np.concatenate(held))]
        if held:
            yield from flush()
        release()

    known = looked_up(m, unigrams, bits)

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        tree = shared.value
        key, n, share, rest = (unpacked(found.column(c), k) for c, k in (("key", np.int64), ("n", np.int64), ("share", float), ("rest", float)))
        order = np.argsort(key.view(_U))
        order = order[np.append(True, np.diff(key[order]) != 0)[: len(order)]]  # a part may ask twice
        pulled = key.view(_U)[order], n[order], share[order], rest[order]
        done = [], [], [], []
        for chunk in texts.column("text").chunks:
            for a, b, w in slices(filled(chunk)):
                t, text = tokens(w)
                count, base, value = token_scores(tree, t, text, pulled)
                k = b - a
                for d, v in zip(done, (w.counts + 1, np.bincount(text[count > 0], minlength=k), np.bincount(text, base, k), np.bincount(text, value, k))):
                    d.append(v)
        values = [np.concatenate([np.zeros(0, kind), *d]) for d, kind in zip(done, (np.int64, np.int64, float, float))]
        return pa.table([texts.column("doc_id"), texts.column("held_out"), *map(pa.array, values)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    turns = max(1, min(WAVES, rows.select("part").distinct().count() // WAVE_PARTS))
    done = []
    for turn in range(turns):
        own = rows.filter(F.pmod(F.xxhash64("part"), F.lit(turns)) == turn)
        asks = own.select("text", "part").mapInArrow(ask, "range long, part long, key binary")
        answers = asks.groupBy("range").cogroup(known.groupBy("range")).applyInArrow(answered, "part long, key binary, n binary, share binary, rest binary")
        out = own.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        done.append(materialize(out, "tree-scores") if turns > 1 else out)
        del own, asks, answers, out
        spent(spark)
    return reduce(DataFrame.unionAll, done).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(m.tokens).cast("long").alias("train_tokens"), "base_score", "score")
