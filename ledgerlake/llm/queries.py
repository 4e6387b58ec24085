"""The registered queries of the training-data operators and, where SQL can express one, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, compression_quality, conv_toxicity, cube_mixing, exact_dedup, masked_lm, merkle_manifest, packing, repetition_rules, simhash_dedup, suffix_dedup, token_attribution, window_packing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, by a model fitted to the labels that may be learned from."""
    docs = _table(spark, folder, "documents")
    return compression_quality.quality_scores(docs, compression_quality.train(docs, _table(spark, folder, "labels")))


@_query
def op2_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Masked pseudo-likelihood of every document under a model of all documents."""
    docs = _table(spark, folder, "documents")
    return masked_lm.pseudo_likelihood(docs, masked_lm.train(docs))


@_query
def op3_suffix_repetition(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the repetition rules for every document."""
    return repetition_rules.repetition_verdicts(_table(spark, folder, "documents"))


@_query
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_dedup.near_duplicates(_table(spark, folder, "documents"))


@_query
def op5_conv_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, by a network trained on the labels that may be learned from."""
    docs = _table(spark, folder, "documents")
    return conv_toxicity.toxicity_scores(docs, conv_toxicity.train(docs, _table(spark, folder, "labels")))


@_query
def op6_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_attribution.section_tokens(_table(spark, folder, "documents"))


@_query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The sequence that every piece of every document is packed into."""
    return packing.packed(_table(spark, folder, "documents"))


@_query
def op8_cube_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return cube_mixing.mix(_table(spark, folder, "documents"))


@_query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which row of each group of equal texts stays."""
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


@_query
def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the bytes of repeated passages."""
    return suffix_dedup.repeated_passages(_table(spark, folder, "documents"))


@_query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The most telling phrases of two and three words of every language."""
    return collocations.collocations(_table(spark, folder, "documents"))


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a tampered one still folds to the root."""
    return merkle_manifest.manifest(_table(spark, folder, "documents"))


@_query
def op13_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The sequence, and the place in it, of every piece of every document's ids."""
    import public_tokenizers

    return window_packing.packed_windows(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


SQL["op9_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)"""

SQL["op11_collocations"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
sentences AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM sentences),
grams AS (SELECT lang, s, array_to_string(ws[i:i + s - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3)) AS v(s) WHERE i + s - 1 <= len(ws)),
f AS (SELECT lang, s, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE s = 1 GROUP BY lang),
candidates AS (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE s > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, s)) AS k FROM candidates),
parts AS (SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:c.s], ' ')),
least AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a FROM candidates WHERE s = 3),
inside AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase AND 100 * g.a >= 50 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def _merkle_sql(levels: int, top_levels: int) -> str:
    """Runs of 8 level by level; a tree of one node stays as it is, so more levels than needed do no harm."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([part(c) for c in ("doc_id", "source", "lang", "n_chars")] + [part(text)]) + ")"
    step = "SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM"
    cells = "SELECT range AS i, range AS c FROM range(256)"
    for _ in range(8):
        cells = f"{step} ({cells})"
    out = f"""
WITH cells AS (SELECT list(c ORDER BY i) AS cell FROM ({cells})),
ids AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda h, b: xor(h >> 8, cell[CAST(xor(h, b) & 255 AS BIGINT) + 1])), 4294967295) AS crc FROM documents, cells),
texts AS (SELECT *, CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM ids),
leaves AS (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf("changed")} AS tampered FROM texts),
a0 AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    leaf, tampered AS fold, '' AS proof FROM leaves),
n0 AS (SELECT t, i, leaf AS d FROM a0)"""
    for k in range(levels + top_levels):
        if k == levels:  # the subroots are the leaves of one more tree
            out += f""",
b{k} AS (SELECT doc_id, 0 AS t, t AS i, leaf, d AS subroot, fold, proof FROM a{k} JOIN n{k} USING (t)),
m{k} AS (SELECT 0 AS t, t AS i, d FROM n{k})"""
        a, n, more = (f"b{k}", f"m{k}", ", subroot") if k == levels else (f"a{k}", f"n{k}", ", subroot" if k > levels else "")
        out += f""",
s{k} AS (SELECT t, i, count(*) OVER (PARTITION BY t) AS n, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {n} WINDOW w AS (PARTITION BY t, i // 8 ORDER BY i)),
a{k + 1} AS (SELECT doc_id, t, CASE WHEN n > 1 THEN i // 8 ELSE i END AS i, leaf{more}, CASE WHEN n > 1 THEN sha256(l || fold || r) ELSE fold END AS fold,
    CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof FROM {a} JOIN s{k} USING (t, i)),
c{k} AS (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM {n}),
n{k + 1} AS (SELECT t, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM c{k} WHERE n > 1 GROUP BY t, i // 8 UNION ALL SELECT t, i, d FROM c{k} WHERE n = 1)"""
    end = levels + top_levels
    return out + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = d AS verified FROM a{end} JOIN n{end} USING (t)"""


SQL["op12_merkle_manifest"] = _merkle_sql(9, 3)
