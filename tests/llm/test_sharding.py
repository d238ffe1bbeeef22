import zlib
from collections import Counter, defaultdict

from seriesloom.llm import sharding
from tests.llm.conftest import make_text


def check(rows, source, shards=8, slack=0.1):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in source)
    slots, size = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    assert all(abs(size[k] - mean) <= slack * mean for k in range(shards)), size


def test_shards_are_even(docs_of):
    rows = [(i, make_text(i, 5 + i % 50), "a") for i in range(1500)]
    rows += [(2000 + i, "the same text, again and again", "a") for i in range(900)]  # a hot text must be split
    rows += [(4000 + i, None, "a") for i in range(600)] + [(5000 + i, make_text(i, 5 + i % 50), "b") for i in range(40)]
    out = sharding.shard(docs_of(rows)).collect()
    check(out, rows)
    where = defaultdict(set)
    for r in out:
        where[r["text_crc32"]].add(r["shard"])
    split = [c for c, s in where.items() if len(s) > 1]
    assert set(split) <= {zlib.crc32(b"the same text, again and again")}
    assert Counter(out) == Counter(sharding.shard(docs_of(rows).repartition(5)).collect())


def test_a_part_reaches_into_several_shards(docs_of):
    """With two ranges for eight shards, rows are placed by their own start, and equal texts by the first of them."""
    rows = [(i, make_text(i, 5 + i % 50), "a") for i in range(1200)] + [(3000 + i, make_text(i % 40, 30) + " twice", "a") for i in range(80)]
    out = sharding.shard(docs_of(rows), ranges=2).collect()
    check(out, rows, slack=0.05)
    where = defaultdict(set)
    for r in out:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_odd_rows(docs_of, odd_rows):
    check(sharding.shard(docs_of(odd_rows)).collect(), odd_rows, slack=8)
    assert sharding.shard(docs_of([])).collect() == []
