from collections import Counter

import corpus_pipeline
from seriesloom.llm import jaccard, mixing, rules
from seriesloom.session import materialize
from tests.llm.conftest import make_text


def test_stages_on_a_small_corpus(spark, docs_of, labels_of, tmp_path, odd_rows):
    rows, labels = list(odd_rows), []
    for i in range(200):
        text = make_text(i, 70)
        if i % 10 == 0:
            text += " idiot"
        rows.append((100 + i, text, "abc"[i % 3]))
        labels.append((100 + i, 1, int(i % 10 == 0)))
    rows += [(1000 + i, make_text(i, 70) + " end", "a") for i in range(20)]  # near copies
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of(labels).write.parquet(str(tmp_path / "labels.parquet"))
    docs = start = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = materialize(stage(spark, docs, str(tmp_path)), "stage")
        if name != "best-fit packing":
            assert docs.columns == start.columns
    after = {name: Counter(df.collect()) for name, df in seen.items()}
    first = after["quality rules"]
    judged = {(r["doc_id"], r["n_words"]): r["kept"] for r in rules.judge(start, labels_of(labels)).collect()}
    assert first == Counter(r for r in start.collect() if judged[r["doc_id"], len((r["text"] or "").replace(" ", "_").split())])
    clean = after["toxicity"]
    assert not clean - first and not any("idiot" in r["text"] for r in clean)
    assert sum(clean.values()) >= 0.97 * sum(n for r, n in first.items() if "idiot" not in r["text"])
    kept = after["n-gram Jaccard join"]
    groups = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(seen["toxicity"]).collect()}
    assert not kept - clean and Counter(r["doc_id"] for r in kept) == Counter(set(groups.values()))
    mixed = after["mixing sources to target weights"]
    assert set(mixed) <= set(kept) and max(mixed.values()) <= 3
    words = {r["doc_id"]: r["taken"] for r in mixing.mix(seen["n-gram Jaccard join"]).collect()}
    assert sum(words.values()) > 0
    assert {r["doc_id"] for r in after["best-fit packing"]} == {r["doc_id"] for r in mixed}
    assert Counter(corpus_pipeline.run(spark, str(tmp_path)).collect()) == after["best-fit packing"]
