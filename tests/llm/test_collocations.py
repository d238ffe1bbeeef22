import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from seriesloom.llm import collocations, counting_filter as cqf
from seriesloom.llm.collocations import Settings


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, least=30, covered=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        long = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in long.items():
            if any(100 * b >= covered * a for q, b in long.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def as_table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 3, "x", 7, 1, "w") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, block long, word string, n long, f long, w string")


def run(df, **kw):
    return sorted(tuple(r) for r in collocations.collocations(df, Settings(**kw)).collect())


def texts(seed, count):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "a\x01", "a"]
    fixed = ["new york city hall", "a b c d e", "To Be or not", "x, y z"]
    return [("en" if i % 3 else None, "".join((r.choice(fixed) if r.random() < 0.2 else r.choice(words)) + r.choice([" ", " ", " ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(r.randint(0, 60))))
            for i in range(count)]


def test_against_plain_counting(spark):
    rows = texts(1, 120)
    assert run(as_table(spark, rows).repartition(5)) == brute(rows)
    # filters of a few entries, shards split in several rounds, wide ids, and a short list with ties at its end
    got = run(as_table(spark, rows).repartition(3), least=4, entries=64, split=2, block_bytes=500, least_bits=19, top=25)
    assert got == brute(rows, least=4, top=25)


def test_odd_rows(spark, odd_rows):
    rows = [("en" if i % 2 else None, r[1]) for i, r in enumerate(odd_rows)] + [("en", "again " * 50_000), ("", "Zz zz, zz ZZ"), ("", "zz zz zz zz zz")]
    assert run(as_table(spark, rows), least=2) == brute(rows, least=2)
    assert run(as_table(spark, rows)) == brute(rows)
    assert run(as_table(spark, [])) == [] and run(as_table(spark, [("en", None)])) == []


def test_scores_beyond_64_bits(spark):
    big = 5 * 10**17
    phrases = spark.createDataFrame([([0], big + 11, "en"), ([1], big + 5, "en"), ([0, 1], big, None)], "w array<long>, f long, lang string")
    assert [tuple(r) for r in collocations.scored(phrases).collect()] == [("en", [0, 1], big, big + 11, big + 5, 2000000 * big // (2 * big + 16))]


@pytest.mark.parametrize("bits", [1, 7, 16, 19, 32])
@pytest.mark.parametrize("n", [2, 3, 4])
def test_filters_are_lossless(n, bits):
    r = np.random.default_rng(n * 100 + bits)
    ids = r.integers(0, 1 << bits, (3000, n))
    ids[:400] = ids[0]
    assert (cqf.ids_of(*cqf.halves(ids, bits), n, bits) == ids).all()
    left, right, counts = cqf.summed(*cqf.permute(*cqf.halves(ids, bits), n, bits), np.ones(len(ids), np.int64))
    a, b = cqf.half_bits(n, bits)
    found = Counter()
    for shard_bits in {0, min(3, a)}:
        found = Counter()
        for shard, raw in collocations._split(left, right, counts, n, bits, shard_bits):
            x, y, c = cqf.decode(raw, a - shard_bits, b)
            back = cqf.ids_of(*cqf.restore(x | np.uint64(shard << (a - shard_bits)), y, n, bits), n, bits)
            found.update({tuple(w): k for w, k in zip(back.tolist(), c.tolist())})
        assert found == Counter(map(tuple, ids.tolist())) and max(found.values()) >= 400
    if bits == 19:  # far smaller than the n-grams themselves
        distinct = len(left)
        assert len(cqf.encode(left, right, counts, a, b)) < distinct * ((n * bits + 7) // 8 + 1.6)


def test_tokenize():
    words, begins = collocations.tokenize(pa.array(["x", "Ab\tc, D.e", "", " \n", "fÉ g"]).slice(1))
    assert words.to_pylist() == ["ab", "c", "d", "e", "fÉ", "g"] and begins.tolist() == [True, False, True, True, True, False]
    line = np.array([0, 5, 1 << 20, 3])
    assert (collocations.read_line(pa.scalar(collocations.write_line(line))) == line).all()
