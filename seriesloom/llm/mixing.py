"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's documents all have the same expected number of copies, target / size of the source. Its
whole part is taken of every document; the fraction is rounded so that the words taken stay at the
target: documents are met in pairs, words of expected mass move from one to the other until one of
them is taken in full or not at all, and the direction is drawn so that no document's expectation
changes (a pivotal step weighted by size). Documents are folded in chunks; what one chunk leaves
over (one document at most) goes up to the next level of a reduction tree. About ``CHUNK`` documents
of each source are held back for the root, where the long ones that are left over meet a full range
of sizes; the one document that is left at the end is drawn alone. Documents that hold more than
1 / ``CHUNK`` of their source (fewer than ``CHUNK`` of them) are rounded first among themselves, and
what they miss is spread over the expectations of all others. So a source misses its target by less
than one document that holds at most 1 / ``CHUNK`` of it, unless it has no such document.

Draws are hashes of the document's own values and a seed, and chunks depend on counts only, so
reruns agree whatever the partitions. A source that holds most rows is spread over its chunks.

Defined cases: a null text has size 0 and is taken 0 times; so is a source whose sizes are all 0
(target 0). A null source is a source of its own, the last. Repeated rows are drawn each. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import WORD, free_name, running_totals
from seriesloom.session import materialize

CHUNK = 128  # documents folded in one row
SALTS = 32  # parts of a source in joins with what is known of the source


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, n, source_size, target. ``sizes``: source (may be null), n, source_size, a row each.

    Sources by code point, null last, weigh ``weights``, repeating. Targets share all words by weight
    but stop at ``most`` times the source's size. The water level is found by one running total
    over sources in the order of the level at which they stop.
    """
    known = sizes.withColumn("none", F.col("source").isNull().cast("int")).withColumn("one", F.lit(1))
    ranked = running_totals(known, ["none", "source"], {"rank": "one"}, "ranked-sources")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("stop", F.col("source_size") * F.lit(most) / F.col("weight"))
    levelled = running_totals(ranked, ["stop", "rank"], {"size_before": "source_size", "weight_before": "weight"}, "levelled-sources")
    total, weight = levelled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).head()
    levelled = levelled.withColumn("level", (F.lit(total) - F.col("size_before") * F.lit(most)) / (F.lit(weight) - F.col("weight_before")))
    full = F.col("level") >= F.col("stop")
    # Those not stopped lie above the level of the first of them, which is the highest of theirs.
    level = levelled.agg(F.max(F.when(~full, F.col("level")))).head()[0] or 0.0
    return levelled.select("source", "n", "source_size", F.when(full, F.col("source_size") * F.lit(most)).otherwise(F.col("weight") * F.lit(level)).cast("double").alias("target"))


def _draw(*parts) -> Column:
    """A number in (0, 1) that depends on the given values only."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def _duel(state: Column, x: Column) -> Column:
    """One pivotal step between the document that is left (``state.left``, may be null) and ``x``.

    ``mass`` is size times probability; it moves up to full, or down to nothing.
    """
    a = state["left"]
    up = F.least(a["size"] - a["mass"], x["mass"])  # words that can move from x to a
    down = F.least(a["mass"], x["size"] - x["mass"])  # and from a to x
    to_a = _draw(F.lit("duel"), a["u"], x["u"]) * (up + down) < down

    def moved(d: Column, mass: Column) -> Column:
        return F.struct(d["size"].alias("size"), d["u"].alias("u"), d["key"].alias("key"), mass.alias("mass"))

    new_a = moved(a, F.when(to_a, F.when(up == a["size"] - a["mass"], a["size"]).otherwise(a["mass"] + up)).otherwise(F.when(down == a["mass"], 0.0).otherwise(a["mass"] - down)))
    new_x = moved(x, F.when(to_a, F.when(up == x["mass"], 0.0).otherwise(x["mass"] - up)).otherwise(F.when(down == x["size"] - x["mass"], x["size"]).otherwise(x["mass"] + down)))
    open_a, open_x = (new_a["mass"] > 0) & (new_a["mass"] < new_a["size"]), (new_x["mass"] > 0) & (new_x["mass"] < new_x["size"])
    settled = F.concat(F.when(~open_a, F.array(new_a)).otherwise(F.slice(F.array(new_a), 1, 0)), F.when(~open_x, F.array(new_x)).otherwise(F.slice(F.array(new_x), 1, 0)))
    met = F.struct(F.when(open_a, new_a).when(open_x, new_x).alias("left"), F.concat(state["done"], settled).alias("done"))
    return F.when(a.isNull(), F.struct(x.alias("left"), state["done"].alias("done"))).otherwise(met)


def pivotal(units: DataFrame) -> DataFrame:
    """Round fractions: ``units`` (g: group, key, size double, mass strictly between 0 and size, u: hash,
    chunks: number of chunks of the group, late: kept for the root) to (key, up: taken or not)."""
    kind = units.schema["key"].dataType.simpleString()
    one = f"struct<size:double,u:bigint,key:{kind},mass:double>"
    rounds, level = [], 0
    late = units.filter("late").withColumn("chunks", F.lit(1).cast("long")).drop("late")
    units = units.filter(~F.col("late")).drop("late")
    chunks = units.agg(F.coalesce(F.max("chunks"), F.lit(0))).head()[0]
    while True:
        root = chunks <= 1
        if root:
            units = units.withColumn("chunks", F.lit(1).cast("long")).unionByName(late)
        # Longest first, so that a document meets one of about its size.
        by_chunk = units.groupBy("g", "chunks", F.pmod(F.xxhash64(F.lit(level), "u"), F.col("chunks")).alias("chunk"))
        items = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("order"), "u", "key", "size", "mass"))),
                            lambda r: F.struct(r["size"].alias("size"), r["u"].alias("u"), r["key"].alias("key"), r["mass"].alias("mass")))
        start = F.struct(F.lit(None).cast(one).alias("left"), F.array().cast(f"array<{one}>").alias("done"))
        folded = materialize(by_chunk.agg(items.alias("items")).select("g", "chunks", F.aggregate("items", start, _duel).alias("r")).select("g", "chunks", "r.left", "r.done"), "pivotal")
        rounds.append(folded.select(F.inline("done")).select("key", (F.col("mass") > 0).alias("up")))
        left = folded.filter(F.col("left").isNotNull())
        if root:
            rounds.append(left.select("left.key", (_draw(F.lit("last"), F.col("left.u")) * F.col("left.size") < F.col("left.mass")).alias("up")))
            break
        chunks, level = 1 if chunks <= CHUNK else -(-chunks // CHUNK), level + 1
        # At the last level before the root, the survivors of up to CHUNK chunks meet those held back.
        units = left.select("g", F.ceil(F.col("chunks") / CHUNK).cast("long").alias("chunks"), "left.*")
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def copies(units: DataFrame, most: float = 3.0) -> DataFrame:
    """source_size, target and copies (whole number) for each row of ``units`` (key, source, size)."""
    per_source = materialize(units.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), "source-sizes")
    targets = source_targets(per_source, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = materialize(targets.withColumn("rate", rate).withColumn("g", F.xxhash64(F.col("source").isNull(), "source")), "source-targets")
    salted = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    u = F.xxhash64("key")
    known = units.withColumn("salt", F.pmod(u, F.lit(SALTS)).cast("int")).withColumnRenamed("source", "own")
    known = known.join(salted, (known["salt"] == salted["salt"]) & known["own"].eqNullSafe(salted["source"])).drop("own").drop(salted["salt"])
    known = known.withColumn("whole", F.floor("rate").cast("int")).withColumn("fraction", F.col("rate") - F.floor("rate"))
    known = materialize(known.select("key", "source", "size", "source_size", "target", "whole", "fraction", "n", "g"), "mix-units")
    open_units = known.filter((F.col("size") > 0) & (F.col("fraction") > 0)).select(
        "g", "key", "source_size", F.col("size").cast("double").alias("size"), (F.col("size") * F.col("fraction")).alias("mass"), u.alias("u"), F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks"),
        (_draw(F.lit("late"), u) * F.col("n") < CHUNK).alias("late"))
    open_units = open_units.withColumn("heavy", F.col("size") * CHUNK > F.col("source_size"))
    between = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    heavy = materialize(pivotal(open_units.filter(F.col("heavy") & between).withColumns({"chunks": F.lit(1).cast("long"), "late": F.lit(True)}).drop("heavy", "source_size")), "mix-heavy")
    # By source: the words that heavy documents should have given but did not, per word of the others.
    settled = open_units.filter("heavy").join(heavy.select(F.col("key").alias("_key"), "up"), F.col("key") == F.col("_key"), "left")
    missed = settled.groupBy("g").agg(F.sum(F.col("mass") - F.when(F.col("up"), F.col("size")).otherwise(0.0)).alias("missed"))
    light = targets.select("g", "rate", "source_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    shift = open_units.groupBy("g").agg(F.sum(F.when(~F.col("heavy"), F.col("size")).otherwise(0.0)).alias("others")).join(missed, "g")
    shift = materialize(light.join(shift, "g").select("g", "salt", F.try_divide("missed", "others").alias("shift")), "mix-shifts")
    rest = open_units.filter(~F.col("heavy")).withColumn("salt", F.pmod("u", F.lit(SALTS)).cast("int")).join(shift, ["g", "salt"], "left")
    moved = F.col("mass") + F.col("size") * F.coalesce("shift", F.lit(0.0))
    rest = materialize(rest.withColumn("mass", F.greatest(F.lit(0.0), F.least(moved, F.col("size")))).drop("heavy", "source_size", "salt", "shift"), "mix-others")
    full = rest.filter(~between).select("key", (F.col("mass") > 0).alias("up"))
    rounded = materialize(heavy.unionByName(pivotal(rest.filter(between))).unionByName(full), "mix-rounded").withColumnRenamed("key", "_key")
    out = known.join(rounded, known["key"] == rounded["_key"], "left")
    return out.select("key", "source", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("whole") + F.coalesce(F.col("up").cast("int"), F.lit(0))).otherwise(0).cast("int").alias("copies"))


def mix(docs: DataFrame, most: float = 3.0) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, copies, taken (words)."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size"))
    # Rows alike in all three are counted, then numbered, so that each is a unit with a key of its own.
    alike = rows.groupBy("doc_id", "source", "size").count()
    units = alike.select(F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("nth"), "doc_id", "source", "size")
    units = materialize(units.select(F.struct(F.col("doc_id").alias("doc_id"), "nth", F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), F.col("size").alias("words")).alias("key"), "source", "size"), "mix-rows")
    return copies(units, most).select(F.col("key.doc_id").alias("doc_id"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, most: float = 3.0) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it.

    Rows with the same doc_id, source and number of words are one unit here: taken alike.
    """
    source, size = free_name(docs, "_source"), free_name(docs, "_words")
    sized = docs.withColumn(source, F.col("source").cast("string")).withColumn(size, n_words())
    units = sized.groupBy(F.col("doc_id").alias("doc_id"), F.col(source).alias("source"), F.col(size).alias("words")).count()
    units = units.select(F.struct("doc_id", F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), "words").alias("key"), "source", (F.col("words") * F.col("count")).alias("size"))
    chosen = copies(materialize(units, "mix-units-of-rows"), most).filter(F.col("copies") > 0).select(F.col("key.doc_id").alias("_d"), F.col("source").alias("_s"), F.col("key.words").alias("_w"), "copies")
    number = free_name(docs, "_copies")
    chosen = chosen.withColumnRenamed("copies", number)
    out = sized.join(chosen, sized["doc_id"].eqNullSafe(chosen["_d"]) & sized[source].eqNullSafe(chosen["_s"]) & (sized[size] == chosen["_w"]))
    out = out.select(*[sized[c] for c in docs.columns], number)
    return out.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(number)))).select(*docs.columns)
