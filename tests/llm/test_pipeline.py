"""The pipeline's stages on a small folder of tables, each against what brute force makes of its own input."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from cartlens.llm import langid, mixing, tokens

LOWER = {i: i + 32 for i in range(65, 91)}
SCRIPTED = {"en": "abcdefgh", "fr": "ijklmnop"}
NAMES = {1: "op1_", 2: "op2_", 3: "op3_", 4: "op4_", 5: "op5_", 6: "op6_", 7: "op7_", 8: "op8_", 9: "op9_", 10: "op10_"}


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    own = plain(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def test_each_operator_and_the_pipeline_are_registered():
    names = list(contract.queries())
    assert all(sum(n.startswith(prefix) for n in names) == 1 for prefix in NAMES.values())
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def folder(spark, documents, prose, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    item = prose(900, 30)
    rows = [(i, prose(i, 40 + i, SCRIPTED["en" if i % 2 else "fr"]), "en" if i % 2 else "fr", f"s{i % 5}") for i in range(80)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "s1") for i in range(10)] + [(120, rows[3][1], "en", "s9")]
    rows += [(200, None, "en", "s1"), (201, "", "en", "s1"), (202, "1 2 3", None, None), (203, "абв где", None, "s2")]
    rows += [(300, f"{prose(70, 20)} {item} {prose(71, 20)}", "en", "s2"), (301, prose(72, 9), None, None)]
    documents(rows).repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), item


def test_stages_keep_what_they_should(spark, folder):
    path, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    stages = dict(corpus_pipeline.STAGES)

    def after(name, docs):
        made = stages[name](spark, docs, path)
        made.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    docs = after("language_id", docs)
    assert docs.columns == columns
    assert {r.doc_id for r in before} - {r.doc_id for r in docs.collect()} == {200, 201, 202, 203}

    rows = docs.collect()
    docs = after("ngram_jaccard", docs)
    assert docs.columns == columns
    sets = {r.doc_id: shingles(r.text) for r in rows}
    least = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((least[a], least[b]))
                least = {k: low if v == high else v for k, v in least.items()}
    kept = {r.doc_id for r in docs.collect()}
    assert kept == set(least.values()) and 120 not in kept and 105 not in kept

    docs = after("decontamination", docs)
    assert docs.columns == columns and kept - {r.doc_id for r in docs.collect()} == {300}

    mixed = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    docs = after("mix_sources", docs)
    assert docs.columns == columns
    assert Counter(r.doc_id for r in docs.collect()) == Counter({i: n for i, n in mixed.items() if n})

    rows = docs.collect()
    slots = after("training_shards", docs).collect()
    made = tokens.encoder(tokens.Vocabulary.read("/opt/tokenizers/byte_bpe_50k.tiktoken"))
    assert sorted(r.slot for r in slots) == list(range(len(slots)))
    assert sum(r.n_tokens for r in slots) == sum(len(made.inner.encode_ordinary(r.text)) + 1 for r in rows)
    assert Counter(r.doc_id for r in slots if r.part == 0) == Counter(r.doc_id for r in rows)

    run = corpus_pipeline.run(spark, path).collect()
    assert sorted(map(tuple, run), key=repr) == sorted(map(tuple, slots), key=repr)


def test_the_language_stage_learns_from_its_own_input(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert set(langid.learn(langid.held_out(docs)).languages) == {"en", "fr"}
