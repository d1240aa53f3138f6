"""Token counts and their prefix table against the tokenizer libraries called directly."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm import tokencounts

TEXTS = [
    None,
    "",
    "Hello world, this is a test.",
    "héllo wörld — ünïcode ✓ 𝔘 text",
    "special <|endoftext|> inside",
    "   spaces\n\n\ttabs  ",
    "long " * 20000,
    "Hello world, this is a test.",
]


def frame(spark):
    rows = [(i % 6 if i != 3 else None, t, "x", 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ends int")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, name):
    path = public_tokenizers.path(name)
    got = tokencounts.token_prefixes(frame(spark), path).collect()
    if name.endswith(".json"):
        model = Tokenizer.from_file(path)
        want = [len(model.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    else:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t or "")) for t in TEXTS]
    assert sorted((r.text or "", r.n_tokens) for r in got) == sorted((t or "", w) for t, w in zip(TEXTS, want))
    for r in got:
        data = (r.text or "").encode("utf-8")
        assert r.n_bytes == len(data) and len(r.ends) == r.n_tokens
        assert list(r.ends) == sorted(r.ends) and (not r.ends or r.ends[-1] <= len(data))


def test_prefix_table_answers_budgets(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    got = tokencounts.token_prefixes(frame(spark), path)
    rows = got.select("text", "n_tokens", tokencounts.cut_bytes(F.col("ends"), 3).alias("cut"),
                      tokencounts.cut_bytes(F.col("ends"), 0).alias("none"),
                      tokencounts.fits(F.col("n_tokens"), 5).alias("fits")).collect()
    for r in rows:
        text = r.text or ""
        prefix = text.encode("utf-8")[: r.cut].decode("utf-8", "replace")
        ids = model.encode(text, add_special_tokens=False).ids
        assert model.decode(ids[:3], skip_special_tokens=False) == prefix or len(ids) < 3 and prefix == text
        assert r.none == 0 and r.fits == (r.n_tokens <= 5)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokencounts.token_prefixes(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
