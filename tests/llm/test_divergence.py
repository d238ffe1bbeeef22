import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from seriesloom.llm import divergence
from tests.llm.conftest import make_text

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top=50):
    """Rows of (lang, source, part, item, value, rank) by plain counting; rows are (lang, source, text)."""
    docs, count, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]
        for w in words:
            count[lang, source, w] += 1
        for w in set(words):
            docs[lang, w] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (x, w), n in docs.items() if x == lang and n >= least]
        sources = [s for x, s in groups if x == lang]
        shares = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c[v] for v in kept) + 5 * len(kept)) for w in kept}
        per = {s: shares(Counter({w: count[lang, s, w] for w in kept})) for s in sources}
        whole = shares(Counter({w: sum(count[lang, s, w] for s in sources) for w in kept}))
        for s in sources:
            pairs = [(sum(abs(per[s][w] - per[t][w]) for w in kept), t) for t in sources if t != s]
            terms = [(per[s][w] - whole[w], w) for w in kept if count[lang, s, w] and per[s][w] > whole[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def as_table(spark, rows):
    full = [(i, t, lang, s, 3, "x", 7, 1, 2) for i, (lang, s, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, block long, chunk string, n long, value long, rank int")


def run(df, **kw):
    return sorted(tuple(r) for r in divergence.audit(df, **kw).collect())


def test_against_plain_counting(spark):
    rows = [("en", f"s{i % 3}", make_text(i, 20 + i % 40) + (" The, the; THE été Été" if i % 2 else " x1y")) for i in range(60)]
    rows += [("de", f"s{i % 2}", make_text(i, 15)) for i in range(25)] + [("fr", "only", "nichts davon")] + rows[:4]
    for least, parts in ((30, 4), (3, 7)):
        assert run(as_table(spark, rows).repartition(parts), least_docs=least) == brute(rows, least)
    assert run(as_table(spark, rows), least_docs=2, top=3) == brute(rows, 2, 3)


def test_odd_rows(spark, odd_rows):
    rows = [(None if i % 4 == 0 else "en", r[2], r[1]) for i, r in enumerate(odd_rows)] + [("en", "empty", None), ("zz", "a", ""), ("zz", "b", "12 34")]
    rows += [("en", "a", "one;" * 30_000 + "two"), ("en", "b", "one;two,ONE")]  # one very long chunk
    for least in (1, 2):
        assert run(as_table(spark, rows), least_docs=least) == brute(rows, least)
    pairs = [r for r in run(as_table(spark, rows)) if r[2] == "pair"]
    assert all(r[4] == 0 for r in pairs) and {(r[0], r[1]) for r in pairs} >= {("zz", "a"), ("zz", "b"), ("en", "empty")}
    assert run(as_table(spark, [])) == []


def test_shares_are_exact_beyond_64_bits(spark):
    n = 3 * 10**15 + 7
    df = spark.createDataFrame([(n, 10**16 + 3, 10**6)], "n long, total long, kinds long")
    assert df.select(divergence.share("n", "total", "kinds")).first()[0] == 1 + 10**9 * (n + 5) // (10**16 + 3 + 5 * 10**6)


def test_blocks():
    block = divergence.Block(pa.array(["a b a", "", "b\tc\x0bb"]))
    rows = {(k, s): (d, n) for s, k, d, n in zip(*(x.to_pylist() for x in block.by_source(pa.array(["x", "y", "x"])))) if k}
    assert rows == {("a", "x"): (1, 2), ("b", "x"): (2, 3), ("c", "x"): (1, 1)}
    assert {k: d for k, d in zip(*(x.to_pylist() for x in block.places())) if k} == {"a": [0], "b": [0, 2], "c": [2]}
    assert list(divergence.byte_slices(pa.array(["aaaa", "b", "c" * 50, "", "d"]), 6, 2)) == [(0, 2), (2, 3), (3, 5)]


def test_terms_spelled_in_many_chunks_are_listed(spark):
    """No chunk alone reaches the least number of documents, and single documents hold several of them."""
    rows = [("en", "a", f"x{i}y" + (" (foo)" if i < 25 else "") + (" foo!" if i >= 5 else "") + " Foo, bar") for i in range(29)]
    rows += [("en", "b", f'"FOO" "{i}bar"') for i in range(3)] + [("en", "b", "bar;"), ("en", "b", "foo")]
    for least in (29, 30, 31, 32, 33, 34):
        assert run(as_table(spark, rows).repartition(3), least_docs=least) == brute(rows, least)


def test_memory_goes_back_after_each_block(monkeypatch):
    """Workers are kept, so what Arrow holds after a block or a task would stay beside the later stages."""
    calls = []
    monkeypatch.setattr(divergence, "release", lambda: calls.append(pa.total_allocated_bytes()))
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 1000)
    held = pa.total_allocated_bytes()
    batch = lambda i: pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array(["s"] * 40), pa.array([make_text(i + j, 20) for j in range(40)])], names=["lang", "source", "text"])
    found = sum(sum(b.column("n").to_pylist()) for b in divergence._counts(batch(i) for i in (0, 50)))
    assert found == 2 * 40 * 20 and len(calls) > 8 and calls[-1] <= held + 100_000


def _block(seed, n=60):
    texts = [make_text(seed * n + i, 30) + f" own{i % 7}x{seed} été{i}" for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(["en" if i % 3 else "de" for i in range(n)]), pa.array([f"s{i * 7 % 5}" for i in range(n)]), pa.array(texts)], names=["lang", "source", "text"])


def _plain(batches):
    docs, n = Counter(), Counter()
    for b in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
            n.update((lang, source, w) for w in text.split())
            docs.update((lang, source, w) for w in set(text.split()))
    return {k: (docs[k], n[k]) for k in n}


def test_counts_travel_as_few_rows():
    """A row for each range of hashes, not for each chunk and source of a block."""
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 200), pa.array([f"s{i % 20}" for i in range(200)]), pa.array([" ".join(f"w{j}" for j in range(i, i + 400)) for i in range(200)])],
                                       names=["lang", "source", "text"])
    rows = list(divergence._packed(iter([batch])))
    counts = list(divergence._counts(iter([batch])))
    assert sum(map(len, counts)) > 11_000 and sum(map(len, rows)) <= 599
    found = {(x["lang"], x["source"], x["chunk"]): (x["docs"], x["n"]) for r in rows for x in divergence.unpack(r).to_pylist()}
    assert found == _plain([batch])


def test_packed_counts_are_summed_by_range(monkeypatch):
    batches = [_block(i) for i in range(6)]
    rows = pa.Table.from_batches([r for b in batches for r in divergence._packed(iter([b]))]).sort_by("range").combine_chunks().to_batches()[0]
    for at_once, open_, size in ((1024, 1_000_000, 10_000), (3, 20, 50), (1, 1, 7)):
        monkeypatch.setattr(divergence, "PACKED_ROWS", at_once)
        monkeypatch.setattr(divergence, "OPEN_COUNTS", open_)
        out = [x for b in divergence._summed(rows.slice(a, size) for a in range(0, len(rows), size)) for x in b.to_pylist()]
        want = _plain(batches)
        assert len(out) == len({w for _, _, w in want})
        assert {(c["lang"], c["source"], x["chunk"]): (c["docs"], c["n"]) for x in out for c in x["cells"]} == want
        for x in out:
            assert len(x["cells"]) == sum(1 for k in want if k[2] == x["chunk"])
            assert {d["lang"]: d["docs"] for d in x["langs"]} == Counter({lang: sum(v[0] for k, v in want.items() if k[0] == lang and k[2] == x["chunk"]) for lang in {k[0] for k in want if k[2] == x["chunk"]}})
    assert list(divergence._summed(iter([]))) == []


def test_unlisted_chunks_do_not_leave_their_block():
    block = divergence.Block(pa.array(["a b a", "", "b\tc\x0bb d"]), lambda kinds: pc.is_in(kinds, pa.array(["b", "d"])).to_numpy(zero_copy_only=False))
    assert dict(zip(*(x.to_pylist() for x in block.places()))) == {"b": [0, 2], "d": [2]}
    assert divergence.Block(pa.array(["a"]), lambda kinds: np.zeros(len(kinds), bool)).places()[0].to_pylist() == []


def test_hashes_of_strings_equal_those_of_words():
    from seriesloom.llm.words import string_hashes, slices

    strings = pa.array(["skipped", "a", "été", "A", "b" * 5000, "a", "日本"])
    (_, _, words), = slices(strings)
    assert (string_hashes(strings) == words.hashes(lower=False)).all()
    assert (string_hashes(strings.slice(1, 3)) == words.hashes(lower=False)[1:4]).all()
    assert len(string_hashes(pa.array([], pa.string()))) == 0 and len(set(string_hashes(pa.array(["", "", "x"])).tolist())) == 2
