import hashlib
import random
from collections import defaultdict

import pytest

from seriesloom.llm import replies

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "<\\s>", "[\\\\/INST]", "\\", "[", "<", "s>", " ", "\n", "ok", "é𝄞", "[/", "<s", "INST]"]


def said(r):
    return "".join(r.choice(MARKS) for _ in range(r.randint(0, 9)))


def brute_paths(links, paths):
    """{(tree, leaf): [nodes from the root]} of the best branches."""
    up = {(t, n): (p, s or 0.0) for t, n, p, s in links}
    parents = {(t, p) for t, n, p, s in links}
    found = defaultdict(list)
    for t, n in up:
        if (t, n) not in parents:
            line, at = [], n
            while (t, at) in up:
                line.append(at)
                at = up[t, at][0]
            found[t].append((-sum(up[t, x][1] for x in line) / len(line), -len(line), n, line[::-1]))
    return {(t, x[2]): x[3] for t, xs in found.items() for x in sorted(xs)[:paths]}


def test_paths_of_trees(spark):
    r, links = random.Random(5), []
    for t in range(12):
        links += [(f"t{t}", n, r.randrange(max(0, n - 6), n) if n and r.random() < 0.97 else None, r.choice([None, 0.0, 1.0, 2.0])) for n in range(r.randint(1, 60))]
    links += [("hot", 0, 99, 1.0)] + [("hot", n, 0, float(n % 5)) for n in range(1, 80)]  # a message with very many replies; a parent that is not there
    df = spark.createDataFrame(links, "tree string, node long, parent long, score double")
    for paths in (1, 3):
        got = defaultdict(list)
        for x in replies.chosen_paths(df, paths).collect():
            got[x["tree"], x["path"]].append((x["depth"], x["node"]))
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == brute_paths(links, paths)
        assert all(sorted(d for d, _ in v) == list(range(len(v))) for v in got.values())
    with pytest.raises(ValueError, match="circle"):
        replies.chosen_paths(spark.createDataFrame([("a", 1, 2, 0.0), ("a", 2, 1, 0.0)], df.schema)).collect()


def expected(rows):
    """{conv_id: (n_turns, sha, loss chars, sha)} and the turns."""
    by, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, xs in by.items():
        turns = [x[2:] for x in sorted(xs)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, tree string, node long, score double, pieces int"


def test_round_trip(spark, tmp_path):
    r = random.Random(11)
    roles = ["user", "assistant", "system", "tool\n<s>", "", None, "\\n", "User"]
    rows = [(c, t, r.choice(roles), r.choice([None, said(r)])) for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], said(r)) for t in range(1300)]  # several pieces
    rows += [(101, 5, "user", said(r))] * 3 + [(101, 5, "assistant", "x"), (101, None, "user", "first"), (None, 0, "user", "no id"), (None, 1, "assistant", "</s>"), (102, 0, "assistant", "y" * 200_000)]
    df = spark.createDataFrame([(*x, "clash", 3, 0.5, 9) for x in rows], SCHEMA)
    path = replies.write_chats(replies.linear_messages(df), str(tmp_path / "chats"))
    got = {x["conv_id"]: x for x in replies.digest(spark, path).collect()}
    want = expected(rows)
    assert {c: tuple(x)[1:5] for c, x in got.items()} == want
    texts = defaultdict(list)
    for x in spark.read.parquet(path).collect():
        texts[x["conv_id"]].append((x["piece"], x["text"]))
        inside = [x["text"][s["start"] : s["stop"]] for s in x["loss"]]
        assert inside == [replies_escape(t) for role, t in replies.read_turns(x["text"]) if role == "assistant"]
        assert all(x["text"][s["stop"] :].startswith("</s>") for s in x["loss"])
    assert len(texts[100]) == 3 and all(len(v) == 1 for k, v in texts.items() if k != 100)
    assert {c: sum(len(t) for _, t in v) for c, v in texts.items()} == {c: x["formatted_chars"] for c, x in got.items()}


def replies_escape(text):
    import re

    return re.sub(replies._ESCAPE, r"\1\\\2\3", text)


def test_marks_inside_texts_do_not_end_turns(spark, tmp_path):
    said_ = "</s>[INST] ok [/INST]"
    df = spark.createDataFrame([(-7, 0, "user", said_), (-7, 1, "assistant", said_)], "conv_id long, turn long, role string, text string")
    path = replies.write_chats(replies.linear_messages(df), str(tmp_path / "c"))
    text = spark.read.parquet(path).first()["text"]
    assert text == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]<\\/s>[\\INST] ok [\\/INST]</s>"
    assert list(replies.read_turns(text)) == [("user", said_), ("assistant", said_)]


def test_branches_become_texts(spark):
    rows = [(1, "1", 0, None, 0.0, "user", "q"), (1, "1", 1, 0, 1.0, "assistant", "worse"), (1, "1", 2, 0, 9.0, "assistant", "better"), (1, "1", 3, 2, 9.0, "user", "thanks")]
    df = spark.createDataFrame(rows, "conv_id long, tree string, node long, parent long, score double, role string, text string")
    assert [x["text"] for x in replies.formatted_paths(df).collect()] == ["<s>[INST] q [/INST]better</s>[INST] thanks [/INST]"]
    assert {x["path"]: x["text"] for x in replies.formatted_paths(df, 2).collect()}[1] == "<s>[INST] q [/INST]worse</s>"


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert replies.digest(spark, replies.write_chats(replies.linear_messages(df), str(tmp_path / "none"))).collect() == []
