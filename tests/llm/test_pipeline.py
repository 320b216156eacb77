import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shopgrain.llm import near_dedup
from tests.llm.helpers import clashing, documents
from tests.llm.test_near_dedup import smallest_linked

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality classifier", "near-duplicates", "mixing", "BPE",
    ]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns over the given documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], SF).cache())
    return results


def test_each_stage_takes_effect(spark, stages):
    documents, known, good, single, mixed, coded = stages
    assert all(s.columns == documents.columns for s in (known, good, single, mixed))
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    assert ids[1] == ids[0]  # all of them have letters
    clean = {d for d in ids[1] if truth.get(d) == 1}
    assert len(clean & ids[2]) >= 0.98 * len(clean)
    junk = {d for d in ids[1] if truth.get(d) == 0}
    assert len(junk & ids[2]) <= 0.1 * len(junk)
    texts = {r.doc_id: r.text for r in good.collect()}
    assert ids[3] == {d for d, (_, _, kept) in smallest_linked(texts).items() if kept}
    assert ids[4] <= ids[3] and mixed.count() != single.count()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sample = {r.doc_id: r for r in coded.collect()}
    assert set(sample) == ids[4] and coded.count() == mixed.count()
    for doc_id in list(sample)[:100]:
        expected = tokenizer.encode(texts[doc_id], add_special_tokens=False).ids
        row = sample[doc_id]
        assert (row.ids, row.n_tokens) == (expected, len(expected))
        assert row.decoded == tokenizer.decode(expected, skip_special_tokens=False)


def test_language_stage_drops_letters_of_no_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(4)
    cyrillic = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    foreign = [
        " ".join("".join(rng.choices(cyrillic, k=rng.randint(2, 9))) for _ in range(300)) for _ in range(20)
    ]
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 25
    planted = documents(
        spark, [(-1 - i, t, None, "a", 1) for i, t in enumerate([*foreign, polish, "Tak", "12 34"])]
    )
    stage = dict(corpus_pipeline.STAGES)["language ID"]
    kept = [r.doc_id for r in stage(spark, docs.unionByName(planted.select(docs.columns)), SF).collect()]
    assert [d for d in kept if d < 0] == [-22]  # too short to judge
    assert len(kept) == docs.count() + 1


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == stages[-1].columns
    assert sorted((r.doc_id, r.n_tokens) for r in found.collect()) == sorted(
        (r.doc_id, r.n_tokens) for r in stages[-1].collect()
    )


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_stand_awkward_rows(spark, name, stage):
    docs = documents(spark)
    found = stage(spark, docs, SF)
    if name != "BPE":
        assert found.columns == docs.columns
    assert stage(spark, clashing(docs), SF).count() == found.count()
    assert stage(spark, documents(spark, []), SF).collect() == []
    assert near_dedup.BANDS * near_dedup.BAND == near_dedup.REGISTERS


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
