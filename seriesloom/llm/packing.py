"""Packing of token sequences into few bins by the configuration linear program.

Documents are encoded, closed with an end id, and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (at most ``capacity`` numbers) decides how to pack:

1. Pieces of more than ``Program.small`` of a bin are grouped by length into at most ``Program.classes``
   classes of like numbers, each rounded up to its longest, so that what fits as classes fits as pieces.
2. A configuration is a multiset of classes that fits in one bin. The linear program asks for the
   fewest configurations that cover all classes. Multiplicative weights price the classes; each round a
   knapsack dynamic program finds the configuration of the greatest price, which is taken while the
   prices of what it covers fall. The prices also bound the program from below; rounds go on until the
   cover is within ``Program.gap`` of the best such bound, and every class is covered.
3. The numbers of configurations are rounded to whole bins along their order (running sums are
   rounded, so each is off by less than one), and filled with real pieces, longest first.
4. What remains (small pieces, what rounding left, and bins with more room than a limit, opened again;
   the widest limit of ``Program.loose`` that needs the fewest bins) goes best-fit, longest first, into
   the room of these bins, then into new ones. Best-fit of everything is never the result.

Each length then has a list of places (bin, offset), and the n-th piece of a length takes its n-th
place; pieces are numbered by a distributed running count, so a length with very many pieces is
spread over tasks.

Defined cases: a null or empty text is one piece with the end id only. Repeated rows and rows with
the same or no doc_id are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import map_rows, running_totals
from seriesloom.llm.divergence import byte_slices
from seriesloom.llm.token_files import encode_ids
from seriesloom.session import materialize

SLICE_BYTES, SLICE_ROWS = 2 << 20, 4096  # of texts that are encoded at once
Bins = dict[tuple[int, ...], int]  # lengths in a bin, longest first: number of such bins

_PIECE = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def cut_pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece."""
    end = np.array([end_id], "<u4").tobytes()
    arrow = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def make():
        from seriesloom.llm.tokens import encoder

        def work(texts: pa.Array) -> list:
            own, offsets, rows = encoder(vocabulary), [0], []
            for a, b in byte_slices(texts, SLICE_BYTES, SLICE_ROWS):
                for raw in own.encode(texts.slice(a, b - a).to_pylist()):
                    raw += end
                    for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                        one = raw[at : at + 4 * capacity]
                        rows.append((i, at // 4, len(one) // 4, zlib.crc32(one)))
                    offsets.append(len(rows))
            columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)] if rows else [pa.array([], t.type) for t in arrow]
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(arrow)))]

        return work

    return map_rows(docs, ["doc_id"], make, [T.StructField("pieces", T.ArrayType(_PIECE))]).select("doc_id", F.inline("pieces"))


@dataclass(frozen=True)
class Program:
    classes: int = 32
    small: float = 1 / 12  # of a bin: shorter pieces fill room
    gap: float = 0.03  # of the cover to its lower bound
    rate: float = 0.25  # of the prices
    rounds: int = 10_000
    loose: tuple[float, ...] = (1.0, 1 / 16, 1 / 64, 1 / 256, 1 / 512, 1 / 1024)  # room of a bin that stays closed


@dataclass(frozen=True)
class Cover:
    """Fractional numbers of configurations that cover all classes, their sum, and a lower bound for any such sum."""

    parts: dict[tuple[int, ...], float]
    value: float
    bound: float


def best_fit(counts: np.ndarray, capacity: int, started: Bins | None = None) -> Bins:
    """Longest first, each into the fullest bin that has room, bins of ``started`` included; equal lengths and equal bins at once."""
    room: list[dict[tuple[int, ...], int]] = [defaultdict(int) for _ in range(capacity + 1)]  # bins by what is left
    for kind, n in (started or {}).items():
        room[capacity - sum(kind)][kind] += n
    open_rooms = np.array([bool(held) for held in room])
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(open_rooms[length:])
            r = int(fits[0]) + length if len(fits) else capacity
            if not len(fits):
                most = capacity // length
                many = left // most
                if many:  # bins of this length alone, full of it
                    room[capacity - most * length][(length,) * most] += many
                    open_rooms[capacity - most * length] = True
                if left - many * most:
                    rest = left - many * most
                    room[capacity - rest * length][(length,) * rest] += 1
                    open_rooms[capacity - rest * length] = True
                break
            held = room[r]
            for kind in list(held):
                n = min(left, held[kind])
                room[r - length][(*kind, length)] += n
                open_rooms[r - length] = True
                held[kind] -= n
                left -= n
                if not held[kind]:
                    del held[kind]
                if not left:
                    break
            open_rooms[r] = bool(held)
    out: Bins = defaultdict(int)
    for held in room:
        for kind, n in held.items():
            out[tuple(sorted(kind, reverse=True))] += n
    return dict(out)


def grouped(counts: np.ndarray, classes: int) -> np.ndarray:
    """For each length that occurs, the longest of its class: at most ``classes`` runs of like numbers of pieces."""
    lengths = np.flatnonzero(counts)
    if len(lengths) <= classes:
        return lengths
    after = np.cumsum(counts[lengths][::-1])[::-1]  # pieces of this length or longer
    kind = (after - 1) * classes // after[0]
    longest = np.full(classes, 0)
    np.maximum.at(longest, kind, lengths)
    return longest[kind]


def best_configuration(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each length in the configuration of the greatest total price: unbounded knapsack by dynamic programming."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, length in enumerate(lengths):
        for a in range(length, capacity + 1, length):  # a stretch of one length: its sources are all done
            part = slice(a, min(a + length, capacity + 1))
            more = best[a - length : part.stop - length] + price[i]
            better = more > best[part]
            best[part][better], last[part][better] = more[better], i
    copies, c = np.zeros(len(lengths), np.int64), int(best.argmax())
    while last[c] >= 0:
        copies[last[c]] += 1
        c -= int(lengths[last[c]])
    return copies


def cover(lengths: np.ndarray, need: np.ndarray, capacity: int, p: Program = Program()) -> Cover:
    """The fewest configurations of ``lengths`` with ``need`` pieces of each, but for ``p.gap``."""
    if not len(lengths):
        return Cover({}, 0.0, 0.0)
    done, mean = np.zeros(len(lengths)), np.zeros(len(lengths))
    parts: dict[tuple[int, ...], float] = defaultdict(float)
    bound, total, every = 0.0, 0.0, 4 * len(lengths)
    for i in range(1, p.rounds + 1):
        weight = np.exp(-p.rate * (done - done.min()))
        mean += weight / weight.sum()
        copies = best_configuration(weight / need, lengths, capacity)
        used = copies > 0
        step = float((need[used] / copies[used]).min())  # covers one length once over
        parts[tuple(np.repeat(lengths, copies)[::-1].tolist())] += step
        total += step
        done += copies * step / need
        if i % every == 0:
            # At the mean prices no configuration is worth more than the best one: a dual solution.
            price = mean / need
            bound = max(bound, float(mean.sum() / (best_configuration(price, lengths, capacity) @ price)))
            mean[:] = 0
            if done.min() > 0 and total / done.min() <= (1 + p.gap) * bound:
                break
    if done.min() == 0:  # out of rounds: lengths not met yet get bins of their own
        for length, n in zip(lengths[done == 0].tolist(), need[done == 0].tolist()):
            parts[(length,) * (capacity // length)] += n / (capacity // length) * done[done > 0].min()
        total, done = sum(parts.values()), done[done > 0]
    return Cover({k: x / done.min() for k, x in parts.items()}, total / done.min(), bound)


def filled(counts: np.ndarray, chosen: Bins, capacity: int) -> tuple[Bins, np.ndarray]:
    """Bins of ``chosen`` with real pieces for the classes, and the pieces left over.

    A place takes the longest piece that its class and the room left by the places before it allow.
    """
    left = counts.copy()
    alive = np.flatnonzero(counts).tolist()  # lengths with pieces left
    bins: Bins = defaultdict(int)
    for classes, n in chosen.items():
        while n:
            room, held, own = capacity - sum(classes), [], defaultdict(int)
            for kind in classes:
                room += kind
                i = bisect_right(alive, room) - 1
                while i >= 0 and own[alive[i]] == left[alive[i]]:
                    i -= 1
                if i >= 0:
                    held.append(alive[i])
                    own[alive[i]] += 1
                    room -= alive[i]
            if not held:
                return dict(bins), left
            many = min(n, *(int(left[length]) // copies for length, copies in own.items() if copies))
            for length, copies in own.items():
                left[length] -= copies * many
                if copies and not left[length]:
                    alive.remove(length)
            bins[tuple(sorted(held, reverse=True))] += many
            n -= many
    return dict(bins), left


def configured(counts: np.ndarray, capacity: int, p: Program = Program()) -> tuple[Bins, np.ndarray, Cover]:
    """Bins of the rounded program, the pieces left over, and the program's solution."""
    large = counts.copy()
    large[: int(capacity * p.small) + 1] = 0
    kinds = grouped(large, p.classes)
    lengths, at = np.unique(kinds, return_inverse=True)
    need = np.bincount(at, large[np.flatnonzero(large)], len(lengths)) if len(lengths) else np.zeros(0)
    solved = cover(lengths, need, capacity, p)
    chosen, before, total = {}, 0, 0.0
    for kind in sorted(solved.parts, reverse=True):
        total += solved.parts[kind]
        upto = int(total + 0.5)
        if upto > before:
            chosen[kind] = upto - before
        before = upto
    bins, left = filled(large, dict(sorted(chosen.items(), reverse=True)), capacity)
    left[: int(capacity * p.small) + 1] = counts[: int(capacity * p.small) + 1]
    return bins, left, solved


def plan(counts: np.ndarray, capacity: int, p: Program = Program()) -> Bins:
    """Bins for ``counts[length]`` pieces of each length up to ``capacity``."""
    rest = counts.copy()
    whole = int(rest[capacity])
    rest[capacity] = 0
    bins, _, _ = configured(rest, capacity, p)
    out: Bins = {}
    for loose in p.loose:  # bins with more room than this are opened again; the most that cost no bin stay
        kept = {kind: n for kind, n in bins.items() if capacity - sum(kind) <= loose * capacity}
        free = rest.copy()
        for kind, n in kept.items():
            np.subtract.at(free, list(kind), n)
        tried = best_fit(free, capacity, kept)
        if not out or sum(tried.values()) < sum(out.values()):
            out = tried
    if whole:
        out[(capacity,)] = out.get((capacity,), 0) + whole
    return out


def places(bins: Bins) -> dict[str, np.ndarray]:
    """Runs of equal places for each length: rows sorted by (length, first rank)."""
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for kind in sorted(bins, reverse=True):
        n, offset = bins[kind], 0
        i = 0
        while i < len(kind):
            length = kind[i]
            copies = kind.count(length)
            rows.append((length, taken[length], copies, base, offset))
            taken[length] += copies * n
            offset += copies * length
            i += copies
        base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {c: table[:, i] for i, c in enumerate(("length", "rank", "copies", "base", "offset"))}


def pack(docs: DataFrame, capacity: int = 2048, vocabulary: str = "word_bpe_49k.json", end_id: int = 0, program: Program = Program()) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(cut_pieces(docs, capacity, vocabulary, end_id), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table = places(plan(counts, capacity, program))
    before = np.concatenate([[0], np.cumsum(counts)])[: capacity + 1]  # pieces of smaller lengths
    shared = docs.sparkSession.sparkContext.broadcast((table, before))
    one = running_totals(pieces.withColumn("one", F.lit(1)), ["length", "doc_id", "piece", "start", "ids_crc32"], {"at": "one"}, "ranked-pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches):
        t, smaller = shared.value
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy() - smaller[length]
            # Runs are sorted by (length, rank): find the last run that starts at or before each piece.
            key, runs = length * (1 << 40) + rank, t["length"] * (1 << 40) + t["rank"]
            i = np.searchsorted(runs, key, "right") - 1
            q = rank - t["rank"][i]
            copies = t["copies"][i]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(t["base"][i] + q // copies), pa.array(t["offset"][i] + (q % copies) * length)],
                                             names=[*columns, "sequence_id", "offset"])

    schema = T.StructType([docs.schema["doc_id"], *_PIECE.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return one.select(*columns, "at").mapInArrow(place, schema)


def token_sequences(docs: DataFrame, packed: DataFrame, capacity: int = 2048, vocabulary: str = "word_bpe_49k.json", end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and the lengths of the pieces in them."""
    ids = encode_ids(docs, ["doc_id"], vocabulary, end_id)
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size("ids") - 1) / capacity).cast("int")), lambda i: F.struct(i.alias("piece"), F.slice("ids", i * capacity + 1, F.lit(capacity)).alias("ids")))
    own = F.crc32(F.to_json("ids"))
    pieces = ids.select("doc_id", F.inline(cuts)).withColumn("_sum", own).dropDuplicates(["doc_id", "piece", "_sum"])
    rows = packed.join(pieces, (packed["doc_id"].eqNullSafe(pieces["doc_id"])) & (packed["piece"] == pieces["piece"]) & (packed["length"] == F.size(pieces["ids"])))
    ordered = F.sort_array(F.collect_list(F.struct("offset", pieces["ids"].alias("ids"))))  # at most ``capacity`` tokens
    return rows.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: F.size(p["ids"])).alias("lengths"))
