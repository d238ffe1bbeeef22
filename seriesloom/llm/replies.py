"""Conversations as training text: paths of reply trees, ranked, formatted and read back.

Messages answer each other, so a conversation is a tree and a training text is a path from its root to a
leaf. Self-joins that double their reach enumerate these paths: after round j each message knows its
ancestor 2^j above (and the sum of scores up to there), so depths and path scores need as many joins as
the depth has bits. Branches are ranked by mean score, and the messages of the chosen ones are found by going
back over the same tables, the longest jumps first, which meets every ancestor exactly once.

A path becomes text in ``template``: turns are marked, and any control string inside a text gets a backslash after
its first character, one more if it has some, so that it can be read back as it was. Loss spans are
the places of the assistants' texts. A path of more than ``PIECE`` turns is written as several rows, in order.

Defined cases: a null text, role or score is empty or 0; roles other than system, user and assistant are kept
in a marker. Null conversation ids form one conversation. Rows of one turn follow each other by role
and text; rows without a turn come first. A message whose parent is not there is a root. Messages in a
circle stop the run. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from seriesloom.operators.layout import number_rows
from seriesloom.session import materialize, shared_dir

PIECE = 512  # turns of a row
TURNS = 64  # of a bucket within which turns are numbered
# The template's marks. An assistant's text has no opening mark.
START, END = "<s>", "</s>"
OPEN = {"system": "[SYS] ", "user": "[INST] ", "other": "[ROLE] "}
CLOSE = {"system": " [/SYS]", "user": " [/INST]", "other": " [/ROLE]", "assistant": END}
_REST = r"/?(?:s>|SYS\]|INST\]|ROLE\])"
_ESCAPE, _UNESCAPE = rf"([<\[])(\\*)({_REST})", re.compile(rf"([<\[])\\(\\*)({_REST})")


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(_ESCAPE), F.lit(r"$1\\$2$3"))


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text) if "\\" in text else text


def _role_unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(text))


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    at = len(START) if text.startswith(START) else 0
    while at < len(text):
        role = next((r for r, mark in OPEN.items() if text.startswith(mark, at)), "assistant")
        at += len(OPEN.get(role, ""))
        end = text.index(CLOSE[role], at)
        body, at = text[at:end], end + len(CLOSE[role])
        if role == "other":
            name, body = body.split("\n", 1)
            yield _role_unescaped(name), unescaped(body)
        else:
            yield role, unescaped(body)


def _jumps(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of ancestors at distances 1, 2, 4 ..., and ``(tree, node, depth, total)`` of all messages."""
    own = links.select("tree", F.col("node").alias("parent")).withColumn("there", F.lit(True))
    known = links.join(own, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"))
    here = materialize(known.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "ancestors")
    tables, most = [], 2 + links.count().bit_length()
    while not (active := here.filter(F.col("up").isNotNull())).isEmpty():
        if len(tables) > most:
            raise ValueError("messages answer each other in a circle")
        tables.append(active.select("tree", "node", "up"))
        next_ = here.select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("total").alias("more"), F.col("depth").alias("further"))
        joined = active.join(next_, ["tree", "up"]).select("tree", "node", F.col("far").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("further")).alias("depth"))
        done = here.filter(F.col("up").isNull()).select("tree", "node", "up", "total", "depth")
        here = materialize(done.unionByName(joined), "ancestors")
    return tables, here.select("tree", "node", "depth", "total")


def chosen_paths(links: DataFrame, paths: int = 1) -> DataFrame:
    """``(tree, path, node, depth)``: the messages of the best branches of each tree of ``(tree, node, parent, score)``.

    A branch is named by its leaf. The higher mean score comes first, then the longer branch, then the smaller leaf.
    """
    tables, reached = _jumps(links)
    leaves = reached.join(links.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti")
    order = W.partitionBy("tree").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "node")
    best = leaves.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= paths)
    found = materialize(best.select("tree", F.col("node").alias("path"), "node", "depth"), "paths")
    for j in reversed(range(len(tables))):
        above = found.join(tables[j], ["tree", "node"]).select("tree", "path", F.col("up").alias("node"), (F.col("depth") - (1 << j)).alias("depth"))
        found = materialize(found.unionByName(above), "paths")
    return found


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Rows with a turn number as messages of which each answers the one before."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = conversations.select("conv_id", tree.alias("tree"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
                                F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))).cast("long").alias("bucket"))
    placed = number_rows(rows, "bucket", [F.col("turn").asc_nulls_first(), "role", "text"], ("tree",), "node")
    return placed.select("conv_id", "tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def formatted_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """``(conv_id, path, piece, pieces, text, loss)`` of the chosen paths of ``(conv_id, tree, node, parent, score, role, text)``."""
    chosen = chosen_paths(messages.select("tree", "node", "parent", "score"), paths)
    length = chosen.groupBy("tree", "path").agg((F.floor(F.max("depth") / PIECE) + 1).cast("int").alias("pieces"))
    name, known = F.col("role"), F.col("role").isin("system", "user", "assistant")
    plain_name = escaped(F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    kind = F.when(known, name).otherwise("other")
    opened = F.when(name == "assistant", "").when(known, F.element_at(F.create_map(*[F.lit(x) for kv in OPEN.items() for x in kv]), kind)).otherwise(
        F.concat(F.lit(OPEN["other"]), plain_name, F.lit("\n")))
    body, close = escaped(F.col("text")), F.element_at(F.create_map(*[F.lit(x) for kv in CLOSE.items() for x in kv]), kind)
    turns = chosen.join(messages.select("conv_id", "tree", "node", opened.alias("opened"), body.alias("body"), close.alias("close"), (name == "assistant").alias("learn")), ["tree", "node"])
    turn = F.struct("depth", F.concat("opened", "body", "close").alias("text"), F.when(F.col("learn"), F.length("body")).alias("learn"), F.length("opened").alias("before"))
    rows = turns.groupBy("tree", "path", F.floor(F.col("depth") / PIECE).cast("int").alias("piece")).agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns"))
    first = F.when(F.col("piece") == 0, START).otherwise("")
    text = F.concat(first, F.array_join(F.transform("turns", lambda x: x["text"]), ""))
    span = "array<struct<start:long,stop:long>>"
    zero = F.struct(F.length(first).cast("long").alias("at"), F.array().cast(span).alias("spans"))

    def step(acc, x):
        start = acc["at"] + x["before"]
        more = F.when(x["learn"].isNull(), F.array().cast(span)).otherwise(F.array(F.struct(start.alias("start"), (start + x["learn"]).cast("long").alias("stop"))).cast(span))
        return F.struct((acc["at"] + F.length(x["text"])).cast("long").alias("at"), F.concat(acc["spans"], more).alias("spans"))

    loss = F.aggregate("turns", zero, step, lambda acc: acc["spans"])
    return rows.join(length, ["tree", "path"]).select("conv_id", "tree", "path", "piece", "pieces", text.alias("text"), loss.alias("loss"))


def write_chats(messages: DataFrame, path: str | None = None, paths: int = 1) -> str:
    """Write the chosen paths of all conversations; returns the folder."""
    path = path or f"{shared_dir(messages.sparkSession)}/chats-{uuid.uuid4().hex}"
    formatted_paths(materialize(messages, "messages"), paths).write.parquet(path)
    return path


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of paths whose pieces follow each other; only the running state of one path is kept."""
    for batch in batches:
        out = []
        for conv, piece, pieces, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "pieces", "text", "loss"))):
            if piece == 0:
                n, turns, chars, learnt, whole = 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            for role, said in read_turns(text):
                turns.update(f"{role}\n{said}\n".encode())
                n += 1
            for span in loss:
                said = unescaped(text[span["start"] : span["stop"]])
                learnt.update(said.encode())
                chars += len(said)
            whole += len(text)
            if piece == pieces - 1:
                out.append((conv, n, turns.hexdigest(), chars, learnt.hexdigest(), whole))
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                                         names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """From the files: one row per written path, with digests of its turns and of the text under its loss spans."""
    rows = spark.read.parquet(path)
    made = {"n_turns": T.LongType(), "turns_sha256": T.StringType(), "loss_chars": T.LongType(), "loss_sha256": T.StringType(), "formatted_chars": T.LongType()}
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(c, t) for c, t in made.items()]])
    whole = rows.filter(F.col("pieces") == 1)
    cut = rows.filter(F.col("pieces") > 1).repartition("tree", "path").sortWithinPartitions("tree", "path", "piece")
    return whole.mapInArrow(_digests, schema).unionByName(cut.mapInArrow(_digests, schema))
