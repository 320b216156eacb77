import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shopgrain.llm import queries, token_counts
from shopgrain.sources.scratch import scratch_root
from tests.llm.helpers import ROWS, documents, each_case

WORD = public_tokenizers.path("word_bpe_49k.json")


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    tokenizer = Tokenizer.from_file(path)
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(spark, tmp_path, name):
    count, paths = library(name), iter(range(9))
    found = each_case(
        spark,
        lambda d: token_counts.count_tokens(
            d, public_tokenizers.path(name), str(tmp_path / f"cache{next(paths)}")
        ),
    )
    expected = [(i, len((t or "").encode()), count(t or "")) for i, t, *_ in ROWS]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_only_missing_content_is_encoded(spark, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    first = documents(spark, [(i, f"text {i % 3}", "en", "a", 1) for i in range(30)])
    token_counts.count_tokens(first, WORD, cache)
    assert spark.read.parquet(cache).count() == 3
    more = documents(spark, [(1, " text  1\n", "en", "a", 1), (2, "new text", "en", "a", 1)])
    counted = token_counts.count_tokens(more, WORD, cache)
    assert spark.read.parquet(cache).count() == 4  # white space makes no other content here
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {1: 2, 2: 2}
    files = len(spark.read.parquet(cache).inputFiles())
    token_counts.count_tokens(more, WORD, cache)
    assert len(spark.read.parquet(cache).inputFiles()) == files


def test_another_tokenizer_version_has_counts_of_its_own(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = documents(spark)
    token_counts.count_tokens(docs, WORD, cache)
    other = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), cache)
    count = library("piece_bpe_32k.model")
    assert {r.n_tokens for r in other.where("doc_id = 5").collect()} == {count(ROWS[0][1])}


def test_many_missing_digests_are_joined_and_not_broadcast(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    small = token_counts.count_tokens(docs, WORD, str(tmp_path / "a")).collect()
    monkeypatch.setattr(token_counts, "FILTER_ROWS", 10)
    large = token_counts.count_tokens(docs, WORD, str(tmp_path / "b")).collect()
    assert sorted(small) == sorted(large)


def test_the_query_meets_its_cache_again(spark):
    """A second run joins the stored counts: it encodes nothing and appends no file."""
    sf_dir = "/root/testdata/sf0.001"
    first = sorted(queries.op7_token_counts(spark, sf_dir).collect())
    cache = f"{scratch_root(spark)}/{queries.TOKEN_CACHE}"
    files = set(spark.read.parquet(cache).inputFiles())
    again = sorted(queries.op7_token_counts(spark, sf_dir).collect())
    assert again == first and set(spark.read.parquet(cache).inputFiles()) == files
