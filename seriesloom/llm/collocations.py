"""Phrases of two to four words that hold together, counted in counting quotient filters.

Texts are cut into pieces and words; a block of texts of one language lists its different words once and
its text as numbers of that list. Words that occur ``least`` times in their language get ids (no phrase
occurs more often than its words), which blocks receive by a join on the word. Phrases of n words are packed
ids: each task collects them in counting quotient filters (``counting_filter``), whose shards are
merged across tasks, in further rounds of splitting where the corpus asks for more shards than a task
should write. Phrases of n words are counted where both their runs of n - 1 words may be frequent: bits
of hashes of those (at most 2^``sieve_bits``, broadcast) tell that, and a bit that is set by chance only costs
a count. So all counts of phrases from ``least`` on are exact.

A phrase scores by its weakest cut, and phrases that occur nearly always inside a longer one are left
out. Defined cases: a null text is empty, a null language is ``und``. Every row counts, repeated rows too. A table
without phrases gives no rows. At most 2^32 different words may reach ``least``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seriesloom.llm import counting_filter as cqf
from seriesloom.llm.common import filled, running_totals
from seriesloom.llm.divergence import byte_slices
from seriesloom.llm.sieve import free, sieve_of
from seriesloom.llm.words import mix
from seriesloom.session import materialize

_U = np.uint64
_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BLOCKS = "block long, lang string, tokens long, words array<string>, times array<long>, line binary"
_LONGEST = 4


@dataclass(frozen=True)
class Settings:
    least: int = 30  # occurrences of a phrase
    covered: int = 80  # percent of a phrase's occurrences inside a longer one from which it is left out
    top: int = 2000  # phrases of a language
    block_bytes: int = 3 << 20
    entries: int = 1_000_000  # of a filter in a task, and about as many of a shard at the end
    split: int = 10  # bits by which a round of merging splits shards
    sieve_bits: int = 28
    least_bits: int = 1  # of an id; more than needed for tests


def tokenize(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts in lower case, and for each whether a piece begins with it."""
    buffers, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    word = kind == 0
    first = np.zeros(len(data) + 1, bool)  # of a text
    first[offsets[:-1]] = True
    first = first[:-1]
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:]
    at = np.flatnonzero(starts)
    piece = np.cumsum(kind == 2, dtype=np.int32)[at] + np.cumsum(first, dtype=np.int32)[at]
    own = np.cumsum(word, dtype=np.int32)  # bytes of words up to and with each
    bounds = np.append(own[at] - 1, own[-1] if len(own) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(_LOWER[data[word]]))
    return words, np.diff(piece, prepend=-1) != 0


def write_line(numbers: np.ndarray) -> bytes:
    """How many bytes the largest number has, then the numbers byte by byte: rows compress well so."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T).tobytes()


def read_line(raw: pa.BinaryScalar) -> np.ndarray:
    data = np.frombuffer(raw.as_buffer(), np.uint8)
    parts = data[1:].reshape(data[0], -1)
    out = parts[0].astype(np.int64)
    for k in range(1, len(parts)):
        out |= parts[k].astype(np.int64) << (8 * k)
    return out


def _blocks(s: Settings) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            langs, text = pc.dictionary_encode(batch.column(0)), filled(batch.column(1))
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                texts = text.filter(pc.equal(langs.indices, code))
                for a, b in byte_slices(texts, s.block_bytes, len(texts)):
                    words, begins = tokenize(texts.slice(a, b - a))
                    coded = pc.dictionary_encode(words)
                    codes = coded.indices.to_numpy()
                    line = np.zeros(len(codes) + int(begins.sum()), np.int64)  # 0 is a border between pieces
                    line[np.arange(len(codes)) + np.cumsum(begins)] = codes + 1
                    times = np.bincount(codes, minlength=len(coded.dictionary))
                    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([number]), pa.array([lang], pa.string()), pa.array([len(codes)]), one(coded.dictionary),
                        one(pa.array(times.astype(np.int64))), pa.array([write_line(line)], pa.binary())], names=["block", "lang", "tokens", "words", "times", "line"])
                    number += 1

    return run


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ids + 1; 0 is a border or a rare word."""
    for batch in batches:
        for raw, met in zip(batch.column("line"), batch.column("met")):
            line, cells = read_line(raw), met.values
            place, ids = (cells.field(c).to_numpy() for c in ("place", "id"))
            table = np.zeros(max(int(line.max(initial=0)), int(place.max(initial=0)) + 1) + 1, np.int64)
            table[place + 1] = ids + 1
            yield pa.RecordBatch.from_arrays([pa.array([write_line(table[line])], pa.binary())], names=["line"])


def _slots(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Place of permuted n-grams in the sieve."""
    return (mix(left * _U(0x9E3779B97F4A7C15) + right) >> _U(64 - bits)).astype(np.int64)


def _grams(line: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where n words follow each other, and their ids."""
    if len(line) < n:
        return np.zeros(0, np.int64), np.zeros((0, n), np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(line, n)
    at = np.flatnonzero((runs > 0).all(axis=1))
    return at, runs[at] - 1


def _may_be_frequent(line: np.ndarray, n: int, bits: int, sieve: np.ndarray, sieve_bits: int) -> np.ndarray:
    """For each place whether the n words from there may be frequent."""
    out = np.zeros(len(line) + 1, bool)
    at, ids = _grams(line, n)
    slots = _slots(*cqf.permute(*cqf.halves(ids, bits), n, bits), sieve_bits)
    out[at] = (sieve[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1
    return out


def _split(left, right, counts, n, bits, shard_bits) -> Iterator[tuple[int, bytes]]:
    """(shard, filter) of sorted entries."""
    a, b = cqf.half_bits(n, bits)
    shard = (left >> _U(a - shard_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(shard))):
        yield int(shard[lo]), cqf.encode(left[lo:hi], right[lo:hi], counts[lo:hi], a - shard_bits, b)


def _rows(found: Iterator[tuple[int, bytes]], turn: int) -> Iterator[pa.RecordBatch]:
    shards, filters, size = [], [], 0
    for shard, raw in found:
        shards.append(shard)
        filters.append(raw)
        size += len(raw)
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array([turn] * len(shards), pa.int64()), pa.array(filters, pa.binary())], names=["shard", "turn", "filter"])
            shards, filters, size = [], [], 0
    if shards:
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array([turn] * len(shards), pa.int64()), pa.array(filters, pa.binary())], names=["shard", "turn", "filter"])


def _count(n: int, bits: int, shard_bits: int, sieve, sieve_bits: int, s: Settings) -> Callable:
    """Filters of the phrases of n words in a task's lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if sieve is None else np.frombuffer(sieve.value, np.uint8)
        turn, size, parts = TaskContext.get().partitionId() << 20, 0, []

        def flush():
            nonlocal turn, size, parts
            left, right = (np.concatenate(x) for x in zip(*parts))
            entries = cqf.summed(*cqf.permute(left, right, n, bits), np.ones(len(left), np.int64))
            yield from _rows(_split(*entries, n, bits, shard_bits), turn)
            turn, size, parts = turn + 1, 0, []

        for batch in batches:
            for raw in batch.column("line"):
                line = read_line(raw)
                at, ids = _grams(line, n)
                if known is not None:
                    known_runs = _may_be_frequent(line, n - 1, bits, known, sieve_bits)
                    ids = ids[known_runs[at] & known_runs[at + 1]]
                for a in range(0, len(ids), s.entries):
                    part = cqf.halves(ids[a : a + s.entries], bits)
                    parts.append(part)
                    size += len(part[0])
                    if size >= s.entries:
                        yield from flush()
        if size:
            yield from flush()

    return run


def _merge(n: int, bits: int, shard_bits: int, further: int, sieve_bits: int, s: Settings) -> Callable:
    """Add up the filters of each shard, whose rows follow each other; ``further`` bits split it for the next round.

    Without further bits the frequent phrases come out; before, sums of part of a shard may come out as they grow.
    """
    a, b = cqf.half_bits(n, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, size, turn = None, [], 0, TaskContext.get().partitionId() << 20

        def total():
            return cqf.summed(*(np.concatenate(x) for x in zip(*parts)))

        def out(entries):
            left, right, counts = entries
            left = left | (_U(shard) << _U(a - shard_bits))
            if further:
                yield from _rows(_split(left, right, counts, n, bits, shard_bits + further), turn)
                return
            left, right, counts = (x[counts >= s.least] for x in (left, right, counts))
            ids = cqf.ids_of(*cqf.restore(left, right, n, bits), n, bits)
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(ids) + 1, n, dtype=np.int32)), pa.array(ids.ravel())), pa.array(counts),
                pa.array(_slots(left, right, sieve_bits))], names=["w", "f", "slot"])

        for batch in batches:
            for at, raw in zip(batch.column("shard").to_pylist(), batch.column("filter")):
                if at != shard:
                    if parts:
                        yield from out(total())
                    shard, parts, size = at, [], 0
                parts.append(cqf.decode(raw.as_py(), a - shard_bits, b))
                size += len(parts[-1][0])
                if size > 2 * s.entries:
                    entries = total()
                    parts, size = [entries], len(entries[0])
                    if further and size > s.entries:
                        yield from out(entries)
                        parts, size, turn = [], 0, turn + 1
        if parts:
            yield from out(total())

    return run


def frequent_phrases(lines: DataFrame, n: int, bits: int, tokens: int, sieve, s: Settings) -> DataFrame:
    """``(w, f, slot)`` of the phrases of ``n`` words that occur ``least`` times; ``sieve``: (bits of hashes, their number) of n - 1 words."""
    wanted = min(max(0, (tokens // s.entries).bit_length()), cqf.half_bits(n, bits)[0])
    steps = [min(s.split, wanted - x) for x in range(0, wanted, s.split)] or [0]
    done = steps[0]
    held, held_bits = sieve if sieve else (None, 0)
    rows = lines.mapInArrow(_count(n, bits, done, held, held_bits, s), "shard long, turn long, filter binary")
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for step in steps[1:]:  # shards split further; the rows of one shard go to several tasks
        dealt = rows.repartition(parts, "shard", F.pmod(F.xxhash64("turn"), F.lit(16))).sortWithinPartitions("shard")
        rows = dealt.mapInArrow(_merge(n, bits, done, step, s.sieve_bits, s), "shard long, turn long, filter binary")
        done += step
    rows = rows.repartition(parts, "shard").sortWithinPartitions("shard")
    return materialize(rows.mapInArrow(_merge(n, bits, done, 0, s.sieve_bits, s), "w array<long>, f long, slot long"), f"phrases-{n}")


def count_phrases(docs: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of 1 to 4 word ids ``(w, f)``, the dictionary ``(lang, word, f, id)``, and words by language ``(lang, n)``."""
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    blocks = materialize(plain.mapInArrow(_blocks(s), BLOCKS), "word-blocks")
    totals = materialize(blocks.groupBy("lang").agg(F.sum("tokens").alias("n")), "language-words")
    counted = blocks.select("lang", F.explode(F.arrays_zip("words", "times")).alias("c")).groupBy("lang", F.col("c.words").alias("word")).agg(F.sum("c.times").alias("f"))
    frequent = counted.filter(F.col("f") >= s.least).withColumn("one", F.lit(1).cast("long"))
    words = materialize(running_totals(frequent, ["lang", "word"], {"id": "one"}, "words").select("lang", "word", "f", "id"), "dictionary")
    bits = max(s.least_bits, max(words.count() - 1, 1).bit_length())
    if bits > 32:
        raise ValueError("more than 2^32 frequent words; raise least")
    met = blocks.select("block", "lang", F.posexplode("words").alias("place", "word")).join(words, ["lang", "word"])
    met = met.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("met"))
    lines = materialize(blocks.select("block", "line").join(met, "block").mapInArrow(_with_ids, "line binary"), "id-lines")
    free(spark)
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    found, sieve = [words.select(F.array("id").alias("w"), "f", "lang")], None
    for n in range(2, _LONGEST + 1):
        phrases = frequent_phrases(lines, n, bits, tokens, sieve, s)
        found.append(phrases.select("w", "f", F.lit(None).cast("string").alias("lang")))
        if n < _LONGEST:
            sieve = sieve_of(phrases, s.sieve_bits)
        free(spark)
    return reduce(DataFrame.unionByName, found), words, totals


def scored(phrases: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``(lang, w, a, l, r, score)`` of the phrases that stay: counts of the two parts at the weakest cut, and its score."""
    long = phrases.filter(F.size("w") > 1).select("w", F.col("f").alias("a"))
    parts = F.expr("flatten(transform(sequence(1, size(w) - 1), k -> array("
                   "named_struct('k', k, 'part', slice(w, 1, k)), named_struct('k', k - 10, 'part', slice(w, k + 1, size(w) - k)))))")
    met = long.select("w", "a", F.explode(parts).alias("c")).select("w", "a", "c.k", F.col("c.part").alias("part"))
    met = met.join(phrases.select(F.col("w").alias("part"), "f", "lang"), "part")
    whole = met.groupBy("w", "a").agg(F.map_from_entries(F.collect_list(F.struct("k", "f"))).alias("f"), F.max(F.when(F.col("k") == 1, F.col("lang"))).alias("lang"))
    cuts = F.expr("transform(sequence(1, size(w) - 1), k -> named_struct("
                  "'score', (cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(f[k] as decimal(20,0)) + cast(f[k - 10] as decimal(20,0))), 'k', k, 'l', f[k], 'r', f[k - 10]))")
    whole = whole.select("lang", "w", "a", F.array_min(cuts).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> slice(w, i, n))))")
    inside = long.filter(F.size("w") > 2).select(F.col("a").alias("longer"), F.explode(inner).alias("w")).groupBy("w").agg(F.max("longer").alias("longer"))
    kept = whole.join(inside, "w", "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * s.covered))
    return kept.select("lang", "w", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))


def collocations(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The first ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``."""
    phrases, words, totals = count_phrases(docs, s)
    found = materialize(scored(phrases, s), "scored-phrases")
    best = [F.col("score").desc(), F.col("a").desc()]
    # First the best of each slice of a language, then of each language, ties kept, so that only these need their words.
    sliced = W.partitionBy("lang", F.pmod(F.xxhash64("w"), F.lit(64))).orderBy(*best)
    few = found.withColumn("r0", F.rank().over(sliced)).filter(F.col("r0") <= s.top)
    few = few.withColumn("r0", F.rank().over(W.partitionBy("lang").orderBy(*best))).filter(F.col("r0") <= s.top).drop("r0")
    spelled = few.select("*", F.posexplode("w").alias("p", "id")).join(words.select("id", "word"), "id")
    kept = ["lang", "w", "a", "l", "r", "score"]
    spelled = spelled.groupBy(*kept).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best, "phrase"))).filter(F.col("rank") <= s.top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
