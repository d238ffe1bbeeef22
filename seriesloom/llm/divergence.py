"""How far the sources of a language differ in their words, by factorizing texts into chunks.

Texts are cut at white space into chunks, counted for each document: blocks of documents of one language give
the documents and occurrences of each of their different chunks by source. They travel packed, a row for each
block and range of hashes of chunks, and are summed range by range. Each chunk that is globally
distinct is cut into terms once, and the terms come back to the counts by a join on the chunk.

A term is kept if enough documents of its language hold it. It has at least as many as its most frequent chunk and at
most as many as its chunks together, which decides nearly all terms. For the others the documents themselves
are listed: in a second pass over the texts, restricted to chunks whose bits are set in a broadcast sieve (other
chunks do not leave their block), and counted once each.

Counts are smoothed to whole numbers out of ``SCALE``; two sources are apart by the sum of the differences
over all kept terms, and a source's own terms are those above the share in its language.

Defined cases: null text, language and source are empty texts. Every row of the table is a document, repeated
rows too. A text without terms counts for its group only. A language without kept terms has pairs of value 0.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seriesloom.llm.common import filled, release
from seriesloom.llm.sieve import free, sieve_of
from seriesloom.llm.words import mix, string_hashes
from seriesloom.session import materialize

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"  # a run of ASCII letters and other characters beyond ASCII
SCALE = 1_000_000_000
BLOCK_BYTES, BLOCK_DOCS = 5 << 20, 1 << 16
CELLS = 4_000_000
SIEVE_BITS = 28
RANGE_BITS = 12  # of a chunk's hash that name its range
PACKED_ROWS = 1024  # summed at once
OPEN_COUNTS = 1_000_000  # counts of one range that are summed before its end
PACKED = "range int, lang string, sources array<string>, runs binary, letters binary, sizes binary, counts binary"
CHUNKS = "chunk string, cells array<struct<lang: string, source: string, docs: long, n: long>>, langs array<struct<lang: string, docs: long>>"
PLACES = "lang string, chunk string, block long, docs array<int>"


def byte_slices(texts: pa.Array, limit: int, rows: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``limit`` bytes and at most ``rows`` rows; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right"))
        b = min(max(a + 1, b), a + rows, len(ends))
        yield a, b
        a = b


class Block:
    """The chunks of some texts: the different ones (``kinds``), and how often each text has them, ordered by chunk and text.

    With ``listed``, which marks the strings of an array that it wants, all other chunks are left out.
    """

    def __init__(self, texts: pa.Array, listed: Callable[[pa.Array], np.ndarray] | None = None):
        n = max(1, len(texts))
        parts = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(parts.flatten())
        self.kinds, kind = words.dictionary, words.indices.to_numpy()
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(parts).to_numpy())
        del words, parts
        if listed:
            wanted = listed(self.kinds)
            self.kinds, met = self.kinds.filter(pa.array(wanted)), wanted[kind]
            kind, doc = (np.cumsum(wanted) - 1)[kind[met]], doc[met]
        keys = kind * np.int64(n)
        keys += doc
        del kind, doc
        cells, self.times = np.unique(keys, return_counts=True)
        self.chunk, self.doc = cells // n, cells % n

    def by_source(self, sources: pa.Array) -> list[pa.Array]:
        """Source, chunk, documents and occurrences."""
        named = pc.dictionary_encode(sources)
        width = max(1, len(named.dictionary))
        key = self.chunk * np.int64(width) + named.indices.to_numpy()[self.doc]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.add.reduceat(self.times[order], first) if len(first) else np.zeros(0, np.int64)
        return [pa.DictionaryArray.from_arrays((key[first] % width).astype(np.int32), named.dictionary), pa.DictionaryArray.from_arrays((key[first] // width).astype(np.int32), self.kinds),
                pa.array(np.diff(np.append(first, len(key)))), pa.array(n.astype(np.int64))]

    def places(self) -> list[pa.Array]:
        """Chunk and the list of its documents."""
        bounds = np.searchsorted(self.chunk, np.arange(len(self.kinds) + 1)).astype(np.int32)
        return [self.kinds, pa.ListArray.from_arrays(pa.array(bounds), pa.array(self.doc.astype(np.int32)))]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, pa.Array]]:
    """(language, sources, texts) of blocks of documents."""
    for batch in batches:
        langs, source, text = pc.dictionary_encode(batch.column(0)), batch.column(1), filled(batch.column(2))
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = pc.equal(langs.indices, code)
            sources, texts = source.filter(own), text.filter(own)
            for a, b in byte_slices(texts, BLOCK_BYTES, BLOCK_DOCS):
                yield lang, sources.slice(a, b - a), texts.slice(a, b - a)
                release()  # what the block took; Arrow would keep it, and idle workers hold it beside later stages
            del sources, texts
        del batch, langs, source, text
    release()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, source, chunk, documents and occurrences, a batch for each block."""
    for lang, sources, texts in _blocks(batches):
        order = pc.sort_indices(sources)  # so that the cells of a block are in order of source at once
        columns = Block(texts.take(order)).by_source(sources.take(order))
        langs = pa.DictionaryArray.from_arrays(np.zeros(len(columns[0]), np.int32), pa.array([lang], pa.string()))
        del sources, texts, order
        yield pa.RecordBatch.from_arrays([langs, *columns], names=["lang", "source", "chunk", "docs", "n"])
        del langs, columns


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Items of ``values`` between each two ``bounds``."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The items of all rows, and how many each row has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    items = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)
    return items, np.diff(ends) // items.itemsize


def pack(counts: pa.RecordBatch) -> pa.RecordBatch:
    """Counts of a block as a row for each range of hashes of chunks: its chunks (``letters`` and ``sizes``), and by source
    (``runs``) the chunk's number, documents and occurrences."""
    source, chunk = counts.column("source"), counts.column("chunk")
    ranges = (string_hashes(chunk.dictionary) >> np.uint64(64 - RANGE_BITS)).astype(np.int16)
    order = np.argsort(ranges, kind="stable")
    kinds, ranges = chunk.dictionary.take(pa.array(order)), ranges[order]
    first = np.flatnonzero(np.diff(ranges, prepend=-1))
    bounds = np.append(first, len(kinds))
    row_of = np.repeat(np.arange(len(first)), np.diff(bounds))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = place[chunk.indices.to_numpy()]
    width = len(source.dictionary)
    key = row_of[at] * width + source.indices.to_numpy()
    order = np.argsort(key.astype(np.min_scalar_type(len(first) * width)), kind="stable")  # sorted by digits if it is short
    key, at = key[order], at[order]
    row = row_of[at]
    table = np.stack([at - first[row], counts.column("docs").to_numpy()[order], counts.column("n").to_numpy()[order]], axis=1).astype("<i4")
    runs = np.flatnonzero(np.diff(key, prepend=-1))
    rows = np.arange(len(first) + 1)
    run_bounds = np.searchsorted(key[runs] // width, rows)
    ends = np.frombuffer(kinds.buffers()[1], np.int32)[: len(kinds) + 1].astype(np.int64)
    letters = kinds.buffers()[2]
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges[first].astype(np.int32)), counts.column("lang").dictionary.take(pa.array(np.zeros(len(first), np.int32))),
         pa.ListArray.from_arrays(pa.array(run_bounds.astype(np.int32)), source.dictionary.take(pa.array(key[runs] % width))),
         _binary(np.diff(np.append(runs, len(key))).astype("<i4"), run_bounds), _binary(np.frombuffer(letters if letters is not None else b"", np.uint8), ends[bounds]),
         _binary(np.diff(ends).astype("<i4"), bounds), _binary(table.ravel(), 3 * np.searchsorted(row, rows))],
        names=["range", "lang", "sources", "runs", "letters", "sizes", "counts"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for counts in _counts(batches):
        rows = pack(counts) if counts.num_rows else None
        del counts
        if rows is not None:
            yield rows
        del rows


def unpack(rows: pa.RecordBatch) -> pa.Table:
    """Language, source, chunk, documents and occurrences of packed rows."""
    letters, _ = _joined(rows.column("letters"), np.uint8)
    sizes, kinds = _joined(rows.column("sizes"), np.int32)
    table, cells = _joined(rows.column("counts"), np.int32)
    runs, _ = _joined(rows.column("runs"), np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    words = pc.dictionary_encode(pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(letters)))
    table, cells = table.reshape(-1, 3), cells // 3
    chunk = words.indices.to_numpy()[table[:, 0] + np.repeat(np.cumsum(kinds) - kinds, cells)]
    lang, source = pc.dictionary_encode(rows.column("lang")), pc.dictionary_encode(rows.column("sources").flatten())
    columns = [(np.repeat(lang.indices.to_numpy(), cells), lang), (np.repeat(source.indices.to_numpy(), runs), source), (chunk, words)]
    return pa.table([*(pa.DictionaryArray.from_arrays(codes, of.dictionary) for codes, of in columns), table[:, 1].astype(np.int64), table[:, 2].astype(np.int64)],
                    names=["lang", "source", "chunk", "docs", "n"])


def summed(counts: list[pa.Table]) -> pa.Table:
    """One row for each chunk, language and source, in this order (of their numbers)."""
    table = (pa.concat_tables(counts).unify_dictionaries() if len(counts) > 1 else counts[0]).combine_chunks()
    lang, source, chunk = (table.column(i).chunk(0) for i in range(3))
    groups, group = np.unique(lang.indices.to_numpy() * np.int64(len(source.dictionary)) + source.indices.to_numpy(), return_inverse=True)
    key = chunk.indices.to_numpy() * np.int64(len(groups)) + group
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    docs, n = (np.add.reduceat(table.column(c).to_numpy()[order], first) for c in ("docs", "n"))
    key, group = key[first], groups[key[first] % len(groups)]
    codes = (group // len(source.dictionary), group % len(source.dictionary), key // len(groups))
    return pa.table([*(pa.DictionaryArray.from_arrays(c.astype(np.int32), of.dictionary) for c, of in zip(codes, (lang, source, chunk))), docs, n], names=table.column_names)


def _by_chunk(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    """Each chunk with its cells, and its documents by language."""
    lang, source, chunk = (counts.column(i).chunk(0) for i in range(3))
    docs, code, kind = counts.column("docs").to_numpy(), lang.indices.to_numpy(), chunk.indices.to_numpy()
    cells = pa.StructArray.from_arrays([lang.dictionary_decode(), source.dictionary_decode(), counts.column("docs").chunk(0), counts.column("n").chunk(0)], names=["lang", "source", "docs", "n"])
    first = np.flatnonzero(np.diff(kind * np.int64(len(lang.dictionary)) + code, prepend=-1))
    langs = pa.StructArray.from_arrays([lang.dictionary.take(pa.array(code[first])), pa.array(np.add.reduceat(docs, first))], names=["lang", "docs"])
    kinds = np.arange(len(chunk.dictionary) + 1)
    lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(of, kinds).astype(np.int32)), items) for of, items in ((kind, cells), (kind[first], langs))]
    rows = pa.RecordBatch.from_arrays([chunk.dictionary, *lists], names=["chunk", "cells", "langs"])
    for a in range(0, len(rows), 1 << 15):
        yield rows.slice(a, 1 << 15)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of packed rows that come in order of their ranges; a range's counts are summed on the way when they are many."""
    held, last, limit = [], None, OPEN_COUNTS
    for batch in batches:
        for a, b in byte_slices(batch.column("letters"), BLOCK_BYTES, PACKED_ROWS):
            part = batch.slice(a, b - a)
            ranges = part.column("range").to_numpy()
            start = int(np.searchsorted(ranges, ranges[-1]))  # of the last range, which may go on
            if start:
                held.append(unpack(part.slice(0, start)))
            if held and ranges[-1] != last:
                yield from _by_chunk(summed(held))
                held, limit = [], OPEN_COUNTS
            held.append(unpack(part.slice(start)))
            last = ranges[-1]
            if sum(map(len, held)) > limit:
                held = [summed(held)]
                limit = max(OPEN_COUNTS, 2 * len(held[0]))
            del part
        del batch
        release()
    if held:
        yield from _by_chunk(summed(held))
    held.clear()
    release()


def _slots(lang: str, chunks: pa.Array) -> np.ndarray:
    return (mix(string_hashes(chunks) + string_hashes(pa.array([lang], pa.string()))) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def _with_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Column ``slot``: bits of the hash of language and chunk."""
    for batch in batches:
        langs, chunks = pc.dictionary_encode(batch.column("lang")), batch.column("chunk")
        slots = np.zeros(batch.num_rows, np.int64)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = langs.indices.to_numpy() == code
            slots[own] = _slots(lang, chunks.filter(pa.array(own)))
        yield batch.append_column("slot", pa.array(slots))


def _places(sieve, bits: int):
    """The documents of chunks whose bit is set, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first = np.frombuffer(sieve.value, np.uint8), TaskContext.get().partitionId() << 40

        def listed(lang: str, kinds: pa.Array) -> np.ndarray:
            slots = _slots(lang, kinds) >> (SIEVE_BITS - bits)
            return ((known[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool)

        for number, (lang, sources, texts) in enumerate(_blocks(batches)):
            kinds, docs = Block(texts, partial(listed, lang)).places()
            del sources, texts
            columns = [pa.array([lang] * len(kinds), pa.string()), kinds, pa.array(np.full(len(kinds), first + number)), docs]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "block", "docs"])
            del kinds, docs, columns

    return run


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _listed_terms(plain: DataFrame, wanted: DataFrame, least_docs: int) -> DataFrame:
    """``(lang, term)`` of those of ``(lang, chunk, term, slot)`` that enough documents hold, by listing these."""
    sieve, bits = sieve_of(wanted, SIEVE_BITS)
    met = plain.mapInArrow(_places(sieve, bits), PLACES).join(wanted, ["lang", "chunk"]).select("lang", "term", "block", F.explode("docs").alias("doc")).distinct()
    return met.groupBy("lang", "term").count().filter(F.col("count") >= least_docs).select("lang", "term")


def factors(plain: DataFrame) -> DataFrame:
    """``(chunk, cells, langs, terms)``: each distinct chunk once, its counts by group and language, and its terms."""
    packed = plain.mapInArrow(_packed, PACKED).repartition("range").sortWithinPartitions("range")
    return packed.mapInArrow(_summed, CHUNKS).select("chunk", "cells", "langs", F.regexp_extract_all(lowered(F.col("chunk")), F.lit(TERM), F.lit(0)).alias("terms"))


def term_counts(docs: DataFrame, least_docs: int = 30) -> DataFrame:
    """``(lang, source, term, n)``: occurrences of the terms that at least ``least_docs`` documents of the language hold."""
    plain = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").alias("text"))
    chunks = materialize(factors(plain).filter(F.size("terms") > 0), "chunk-factors")
    free(docs.sparkSession)
    of_lang = chunks.select("chunk", "langs", F.explode(F.array_distinct("terms")).alias("term")).select("chunk", "term", F.explode("langs").alias("l"))
    of_lang = of_lang.select("chunk", "term", F.col("l.lang").alias("lang"), F.col("l.docs").alias("docs"))
    bounds = of_lang.groupBy("lang", "term").agg(F.sum("docs").alias("most"), F.max("docs").alias("fewest")).filter(F.col("most") >= least_docs)
    bounds = materialize(bounds, "term-bounds")
    kept = bounds.filter(F.col("fewest") >= least_docs).select("lang", "term")
    open_ = bounds.filter(F.col("fewest") < least_docs).select("lang", "term")
    wanted = of_lang.filter(F.col("docs") < least_docs).join(open_, ["lang", "term"]).select("lang", "chunk", "term")
    wanted = materialize(wanted.mapInArrow(_with_slots, "lang string, chunk string, term string, slot long"), "open-chunks")
    if not wanted.isEmpty():
        kept = kept.unionByName(materialize(_listed_terms(plain, wanted, least_docs), "listed-terms"))
    free(docs.sparkSession)
    cells = chunks.select("cells", F.explode("terms").alias("term")).select("term", F.explode("cells").alias("c"))
    cells = cells.groupBy(F.col("c.lang").alias("lang"), F.col("c.source").alias("source"), "term").agg(F.sum("c.n").alias("n"))
    return materialize(cells.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "source-terms")


def share(n: str | Column, total: str, kinds: str) -> Column:
    """``n`` occurrences as a share of ``SCALE``, smoothed by 5, as an exact whole number."""
    n = F.col(n) if isinstance(n, str) else n
    over = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(5).cast("decimal(1,0)"))
    under = (F.col(total).cast("decimal(20,0)") + F.col(kinds).cast("decimal(18,0)") * F.lit(5).cast("decimal(1,0)"))
    return (F.call_function("div", over, under) + 1).cast("long")


def groups_of(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(lang, source, place, total, kinds, lang_total, unseen)`` of every group; ``place`` numbers the sources of a language."""
    found = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kinds = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("kinds"))
    none = F.lit(0).cast("long")
    out = found.join(own, ["lang", "source"], "left").join(kinds, "lang", "left").select(
        "lang", "source", (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("place"),
        *[F.coalesce(c, none).alias(c) for c in ("total", "kinds", "lang_total")])
    return materialize(out.withColumn("unseen", F.when(F.col("kinds") > 0, share(none, "total", "kinds")).otherwise(none)), "groups")


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of differences between all sources of each language over a task's terms."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = pc.dictionary_encode(batch.column("lang"))
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(langs.indices.to_numpy() == code)
            base = np.array(batch.column("unseen")[int(rows[0])].as_py(), np.int64)
            total = sums.setdefault(lang, np.zeros((len(base), len(base)), np.int64))
            step = max(1, CELLS // len(base))
            for a in range(0, len(rows), step):
                part = pa.array(rows[a : a + step])
                place, value = batch.column("places").take(part), batch.column("shares").take(part)
                shares = np.tile(base, (len(part), 1))
                shares[np.repeat(np.arange(len(part)), pc.list_value_length(place).to_numpy()), place.flatten().to_numpy()] = value.flatten().to_numpy()
                for j in range(len(base)):
                    total[j] += np.abs(shares - shares[:, j : j + 1]).sum(axis=0)
    for lang, total in sums.items():
        one, other = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * total.size, pa.string()), pa.array(one.ravel().astype(np.int32)), pa.array(other.ravel().astype(np.int32)),
                                          pa.array(total.ravel())], names=["lang", "one", "other", "value"])


def distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for each two different sources of a language, which are as many rows as that asks for."""
    placed = counts.join(groups, ["lang", "source"]).select("lang", "term", "place", share("n", "total", "kinds").alias("share"))
    packed = placed.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "share")).alias("c"))  # at most one entry a source
    unseen = groups.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "unseen"))), lambda x: x["unseen"]).alias("unseen"))
    rows = packed.join(unseen, "lang").select("lang", F.col("c.place").alias("places"), F.col("c.share").alias("shares"), "unseen")
    sums = rows.mapInArrow(_distances, "lang string, one int, other int, value long").groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    one = groups.select("lang", "source", F.col("place").alias("one"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    pairs = one.join(other, "lang").filter(F.col("one") != F.col("other"))
    return pairs.join(sums, ["lang", "one", "other"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def own_terms(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: the terms that a source has more often than its language, and by how much."""
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    met = counts.join(whole, ["lang", "term"]).join(groups, ["lang", "source"])
    value = share("n", "total", "kinds") - share("lang_n", "lang_total", "kinds")
    return met.select("lang", "source", F.col("term").alias("item"), value.alias("value")).filter(F.col("value") > 0)


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """Distances of the sources of each language (part ``pair``) and the ``top`` terms of each (part ``term``), ranked."""
    counts = term_counts(docs, least_docs)
    groups = groups_of(docs, counts)
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = distances(counts, groups).withColumn("rank", F.row_number().over(order))
    terms = own_terms(counts, groups).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
