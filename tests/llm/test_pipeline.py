"""The pipeline's stages on the smallest tables, each against its own input."""

from collections import Counter, defaultdict

import corpus_pipeline
from conftest import FOLDER
from factloom.llm import personal_data
from factloom.llm.common import stored
from test_operators import brute_classes, brute_targets, check_packed


def test_stages(spark):
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, FOLDER), name)
        seen.append((docs, made))
        if name != "packing":
            assert made.schema.simpleString() == docs.schema.simpleString()
        docs = made
    rows = [[m.collect() for m in pair] for pair in seen]

    before, after = rows[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    assert all((r["doc_id"] in kept) == bool(labels.get(r["doc_id"], r["doc_id"] in kept)) for r in before)

    before, after = rows[1]
    before = sorted(before, key=lambda r: r["doc_id"])
    classes = brute_classes([r["text"] for r in before])
    assert {r["doc_id"] for r in after} == {before[c]["doc_id"] for c in classes}

    before, after = rows[2]
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        text = texts[r["doc_id"]]
        assert r["text"] == personal_data.masked(text, personal_data.find(text))
        assert r["n_chars"] == len(r["text"])

    before, after = rows[3]
    sizes, taken, longest = Counter(), Counter(), defaultdict(int)
    for r in before:
        n = len(r["text"].split())
        sizes[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    for r in after:
        taken[r["source"]] += len(r["text"].split())
    wanted = brute_targets(sizes)
    assert all(abs(taken[s] - wanted[s]) <= longest[s] for s in wanted)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3

    before, after = rows[4]
    assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
    check_packed(after, 4096)


def test_stages_on_odd_rows(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ("keep", "copies", "uid", "_id", "row", "_s", "rep", "key", "n_symbols")
    rows = [
        (None, None, None, None, None),
        (3, "", "en", "s", 0),
        (3, "", "en", "s", 0),
        (5, "some plain words in a row", "en", None, 25),
    ]
    odd = spark.createDataFrame(
        [r + ("x",) * len(extra) for r in rows],
        f"{columns}, " + ", ".join(f"{c} string" for c in extra),
    )
    for docs in (odd, odd.limit(0)):
        wanted = docs.schema.simpleString()
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER), name)
            assert name == "packing" or docs.schema.simpleString() == wanted
