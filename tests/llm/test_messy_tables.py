"""Every operator on tables with nulls, empty and long texts, ties, repeated rows, clashing columns, or no rows."""

import pytest

from ledgerlake.llm import (compression_quality, conv_toxicity, cube_mixing, exact_dedup, masked_lm, packing, repetition_rules, simhash_dedup, suffix_dedup,
                            token_attribution)

from .cases import empty, messy


def _labels(spark, docs):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(110)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "quality": lambda s, d: compression_quality.quality_scores(d, compression_quality.train(d, _labels(s, d))),
    "toxicity": lambda s, d: conv_toxicity.toxicity_scores(d, conv_toxicity.train(d, _labels(s, d))),
    "masked_lm": lambda s, d: masked_lm.pseudo_likelihood(d, masked_lm.train(d)),
    "repetition": lambda s, d: repetition_rules.repetition_verdicts(d),
    "simhash": lambda s, d: simhash_dedup.near_duplicates(d),
    "mixing": lambda s, d: cube_mixing.mix(d),
    "exact": lambda s, d: exact_dedup.exact_duplicates(d),
    "suffix": lambda s, d: suffix_dedup.repeated_passages(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(spark, name):
    docs = messy(spark).repartition(3)
    got = OPERATORS[name](spark, docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, empty(spark)).count() == 0


def test_packing_and_tokens_keep_every_document(spark):
    docs = messy(spark)
    for got in (packing.packed(docs), token_attribution.section_tokens(docs)):
        assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert packing.packed(empty(spark)).count() == 0
    assert token_attribution.section_tokens(empty(spark)).count() == 0


@pytest.mark.parametrize("stage", [repetition_rules.drop_repetitive, exact_dedup.drop_exact_duplicates, simhash_dedup.drop_near_duplicates, cube_mixing.apply_mix])
def test_stages_keep_the_columns(spark, stage):
    docs = messy(spark)
    for d in (docs, empty(spark)):
        got = stage(d)
        assert got.schema.simpleString() == docs.schema.simpleString()
        assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in d.collect()}


def test_texts_without_words_score_zero(spark):
    docs = messy(spark)
    for name in ("quality", "toxicity"):
        got = {r["doc_id"]: r["score"] for r in OPERATORS[name](spark, docs).collect() if r["doc_id"] is not None}
        assert got[0] == got[1] == got[2] == 0.0 and all(0 <= v <= 1 for v in got.values())
