"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from surgewatch.llm import (
    alignment,
    decontam,
    exact_dedup,
    jaccard,
    langid,
    licenses,
    mixing,
    phrases,
    pii,
    quotes,
    token_frames,
    url_filter,
    whitening,
)

#: Tokenizer file of op5 and of the pipeline; give another path to ``token_frames``.
TOKENIZER = "word_bpe_49k.json"
#: Tokenizer files of op13.
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def op1_language_profiles(spark, sf_dir):
    return langid.predict_languages(_documents(spark, sf_dir))


def op2_license_rules(spark, sf_dir):
    return licenses.digest(licenses.scan_licenses(_documents(spark, sf_dir)))


def op3_private_terms(spark, sf_dir):
    return pii.digest(pii.find_private(_documents(spark, sf_dir)))


def op4_quotation_links(spark, sf_dir):
    return quotes.link_quotes(_table(spark, sf_dir, "conversations"))


def op5_token_frames(spark, sf_dir):
    return token_frames.digest(_documents(spark, sf_dir), tokenizer_path())


def op6_wu_manber(spark, sf_dir):
    docs, benchmark = _documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")
    return decontam.digest(decontam.find_passages(docs, benchmark))


def op7_grace_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op8_jaccard_join(spark, sf_dir):
    return jaccard.similar_documents(_documents(spark, sf_dir))


def op9_repeated_phrases(spark, sf_dir):
    return phrases.remove_repeats(_documents(spark, sf_dir)).drop("kept")


def op10_entropy_mix(spark, sf_dir):
    return mixing.digest(_documents(spark, sf_dir))


def op11_path_templates(spark, sf_dir):
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op12_refined_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark, sf_dir):
    return alignment.align(_documents(spark, sf_dir), *map(tokenizer_path, ALIGNED))


QUERIES = {
    "op1_language_profiles": op1_language_profiles,
    "op2_license_rules": op2_license_rules,
    "op3_private_terms": op3_private_terms,
    "op4_quotation_links": op4_quotation_links,
    "op5_token_frames": op5_token_frames,
    "op6_wu_manber": op6_wu_manber,
    "op7_grace_dedup": op7_grace_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_repeated_phrases": op9_repeated_phrases,
    "op10_entropy_mix": op10_entropy_mix,
    "op11_path_templates": op11_path_templates,
    "op12_refined_whitening": op12_refined_whitening,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0),
pats AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
    SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, i, places.k, item_id FROM places JOIN pats USING (k, p)),
hits AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS x FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP7 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id)"""

# Pairs are made from the shingles that two sets share.
_OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b
    ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT a AS v, b AS r FROM links UNION SELECT v, b FROM reach JOIN links ON r = a),
least AS (SELECT v, min(r) AS r FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(r, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON v = d.doc_id"""

_OP9 = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
places AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS p FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
owned AS (SELECT p, min(doc_id) AS o FROM places GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(range(i, i + 50)) AS x
    FROM places JOIN owned USING (p) WHERE o < doc_id)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY x) AS t FROM (
    SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS x FROM d)
    ANTI JOIN gone USING (doc_id, x) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

ORACLES = {
    "op6_wu_manber": _OP6,
    "op7_grace_dedup": _OP7,
    "op8_jaccard_join": _OP8,
    "op9_repeated_phrases": _OP9,
}
