import random
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesloom.llm import packing, token_files
from seriesloom.llm.tokens import encoder
from tests.llm.conftest import make_text


def plain_ids(name, text):
    t = Tokenizer.from_file(path(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    r = random.Random(3)
    bits = [" ", "  ", "\n", "a", "bc", ".", ",", "'s", "\t", "é", "́", "12", "\x01", " ", "!", "A", "日", "\x1c", "\r", "　", "<|endoftext|>", "\U0001f600"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 16))) for _ in range(3000)] + ["", " ", "\n\n a", make_text(1, 500)]
    t = Tokenizer.from_file(path(name))
    t.encode_special_tokens = True
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert encoder(name).encode(texts) == want
    assert encoder(name).encode(texts) == want  # from memory


def test_encoder_with_little_memory(monkeypatch):
    from seriesloom.llm import tokens

    monkeypatch.setattr(tokens, "MOST_PARTS", 5)
    monkeypatch.setattr(tokens, "PASSING_PARTS", 5)
    own = tokens.WordEncoder("word_bpe_49k.json")
    texts = [make_text(i % 7, 40) for i in range(30)]
    for a in range(0, 30, 3):
        want = [np.array(plain_ids("word_bpe_49k.json", t), "<u4").tobytes() for t in texts[a : a + 3]]
        assert own.encode(texts[a : a + 3]) == want
    assert len(own.known) < 200


def test_words_met_once_are_not_kept_for_good(monkeypatch):
    """Workers are kept, so words that never come again would stay beside all later stages."""
    from seriesloom.llm import tokens

    monkeypatch.setattr(tokens, "PASSING_PARTS", 300)
    own = tokens.WordEncoder("word_bpe_49k.json")
    for i in range(12):
        texts = [f"These words return. {' '.join(f'once{i}x{j}y{k}' for k in range(20))}" for j in range(5)]
        assert own.encode(texts) == [np.array(plain_ids("word_bpe_49k.json", t), "<u4").tobytes() for t in texts]
    assert sorted(own.known) == [b"return.", b"these", b"words"] and len(own.known.passing) <= 400


def test_files_round_trip(spark, docs_of, odd_rows):
    folder = token_files.write_token_files(docs_of(odd_rows))
    rows = token_files.read_token_files(spark, folder).orderBy("row_id").collect()
    order = [r["doc_id"] for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    want = Counter((r[0], tuple([*plain_ids("byte_bpe_50k.json", r[1]), 2])) for r in odd_rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
    start = 0
    digest = token_files.digest(spark, folder).orderBy("start").collect()
    for d, r in zip(digest, rows):
        assert (d["doc_id"], d["start"], d["n_tokens"]) == (r["doc_id"], start, len(r["ids"]))
        assert d["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += d["n_tokens"]
    assert [r["doc_id"] for r in token_files.lookup(spark, folder, [4]).collect()] == [4, 4]
    assert "PushedFilters: [In(doc_id" in token_files.lookup(spark, folder, [4, 6])._jdf.queryExecution().toString()


def test_no_rows(spark, docs_of):
    assert token_files.digest(spark, token_files.write_token_files(docs_of([]))).collect() == []
    assert packing.pack(docs_of([])).collect() == []


def check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(docs_of, odd_rows):
    docs = docs_of(odd_rows + [(100 + i, make_text(i, 5 + i % 60), "a") for i in range(60)])
    rows = packing.pack(docs, capacity=64).cache()
    got = rows.collect()
    n = check_packed(got, 64)
    total = sum(r["length"] for r in got)
    assert n <= -(-total // 64) * 1.05 + 1
    ids = {}
    for r in odd_rows:
        ids.setdefault(r[0], []).append([*plain_ids("word_bpe_49k.json", r[1]), 0])
    for d, texts in ids.items():
        want = Counter((k, a, min(64, len(t) - a), zlib.crc32(np.array(t[a : a + 64], "<u4").tobytes())) for t in texts for k, a in enumerate(range(0, len(t), 64)))
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == d) == want
    whole = packing.token_sequences(docs, rows, capacity=64).collect()
    assert len(whole) == n and sum(len(r["ids"]) for r in whole) == total


def test_plans_cover_and_fit():
    r = np.random.default_rng(5)
    for capacity, sizes in ((20, r.integers(1, 21, 400)), (100, r.integers(30, 60, 1000)), (10, np.array([5, 5, 5, 7, 3, 10])), (12, np.full(30, 4))):
        counts = np.bincount(sizes, minlength=capacity + 1)
        bins = packing.plan(counts, capacity)
        held = np.zeros(capacity + 1, int)
        for kind, n in bins.items():
            assert sum(kind) <= capacity
            held += n * np.bincount(kind, minlength=capacity + 1)
        assert (held == counts).all()
        assert sum(bins.values()) <= sum(packing.best_fit(counts, capacity).values()) + 1


def test_configurations_beat_best_fit():
    """Longest first mixes lengths that fill bins exactly together: 1034 + 520 + 494, and 1034 with two of 500."""
    for n in (30, 3000, 300_000):
        counts = np.zeros(2049, int)
        counts[[1034, 520, 515, 496]] = n, n, n, 2 * n
        bins, left, solved = packing.configured(counts, 2048)
        best = sum(packing.plan(counts, 2048).values())
        assert best <= 0.95 * sum(packing.best_fit(counts, 2048).values())
        assert solved.bound <= solved.value <= 1.05 * solved.bound and best >= solved.bound
        assert sum(len(k) * m for k, m in bins.items()) + left.sum() == counts.sum()


@pytest.mark.parametrize("least, most", [(300, 1200), (500, 900), (180, 2047)])
def test_program_covers_every_class(least, most):
    """The value lies between the size bound and the bins; most pieces lie in bins of configurations."""
    r = np.random.default_rng(least)
    counts = np.bincount(r.integers(least, most, 5000), minlength=2049)
    bins, left, solved = packing.configured(counts, 2048)
    size = (counts * np.arange(2049)).sum() / 2048
    best = packing.plan(counts, 2048)
    assert size <= solved.value and solved.bound <= solved.value <= 1.05 * solved.bound
    kinds = packing.grouped(counts, packing.Program().classes)
    held = np.zeros(2049)
    for kind, x in solved.parts.items():
        assert sum(kind) <= 2048
        np.add.at(held, list(kind), x)
    for kind in np.unique(kinds):
        assert held[kind] >= counts[np.flatnonzero(counts)[kinds == kind]].sum() * (1 - 1e-9)
    assert size <= sum(best.values()) <= 1.01 * sum(packing.best_fit(counts, 2048).values())
    assert sum(len(k) * m for k, m in bins.items()) >= 0.95 * counts.sum()
    assert sum(len(k) * m for k, m in best.items() if bins.get(k)) >= 0.5 * counts.sum()


def test_hot_length_is_spread(spark, docs_of):
    """A third of all pieces have one length; their numbering is spread over partitions."""
    docs = docs_of([(i, "a b c" if i % 3 == 0 else make_text(i, 3 + i % 30)) for i in range(900)])
    assert check_packed(packing.pack(docs, capacity=40).collect(), 40) > 0
    assert docs.select(F.count("*")).head()[0] == 900


def test_words_with_punctuation_share_their_letters():
    """Each different word goes through the model once, and only other parts are learnt in bulk."""
    from seriesloom.llm import tokens

    own = tokens.ByteEncoder("byte_bpe_50k.json")
    pieces, bulk, piece, learn = [], [], own._piece, own.learn
    own._piece = lambda p: pieces.append(p) or piece(p)
    own.learn = lambda parts: bulk.extend(parts) or learn(parts)
    texts = ["zzyva qorst, qorst. qorst\nqorst, été été!", "qorst it's été qorst;;", "qorst, (12) zzyva"]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in own.encode(texts)] == [plain_ids("byte_bpe_50k.json", t) for t in texts]
    assert pieces.count("Ġqorst") == 1 and len(pieces) == len(set(pieces) - {"qorst", "zzyva"}) + pieces.count("qorst") + pieces.count("zzyva")
    assert sorted(bulk) == ["(12)", "it's"]
    again = len(pieces), len(bulk)
    own.encode(texts)
    assert (len(pieces), len(bulk)) == again


def test_plain_words_do_not_pass_the_whole_tokenizer(monkeypatch):
    """Latin letters and punctuation after them are pieces, which the model takes without normalizer and pattern."""
    from seriesloom.llm import tokens

    own, seen = tokens.WordEncoder("word_bpe_49k.json"), []
    monkeypatch.setattr(own, "learn", lambda parts: seen.extend(parts) or tokens.WordEncoder.learn(own, parts))
    words = ["river", "Ünïcode,", "ÉTÉ!!", "stone.", "stone,", "STONE", "ªº", "ß", "...", "it_", "a<|", "longer" * 40, "İstanbul", "x1y", "don't", "'s", "日本", "été.été", "ét", "<|endoftext|>", "ǅ.", "Ⱥb"]
    texts = [" ".join(words), "", " ", *words, *(f" {w}\n" for w in words), make_text(3, 400)]
    assert own.encode(texts) == [np.array(plain_ids("word_bpe_49k.json", t), "<u4").tobytes() for t in texts]
    assert {p.decode() for p in seen} == {"İstanbul", "x1y", "don't", "'s", "日本", "été.été", "ét", "<|endoftext|>", "Ⱥb"}
