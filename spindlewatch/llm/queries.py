"""The operators of this package as queries on whole tables, and their results in DuckDB's SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from spindlewatch.llm.byte_pairs import read_vocabulary, tokenize
from spindlewatch.llm.collocations import collocations
from spindlewatch.llm.common import crc_remainder, table
from spindlewatch.llm.decontaminate import find_leaks, n_hit
from spindlewatch.llm.language_id import fit, predict
from spindlewatch.llm.language_model import score_texts
from spindlewatch.llm.license_scan import find_licenses
from spindlewatch.llm.passages import remove_repeats
from spindlewatch.llm.piece_agenda import encode_pieces, read_model
from spindlewatch.llm.quality_rules import judge_quality
from spindlewatch.llm.quality_trees import fit_quality, score_quality
from spindlewatch.llm.shingle_join import similar_components
from spindlewatch.llm.url_rules import judge, rule_table
from spindlewatch.llm.whitening import fit_whitening, whiten

# Where the vocabularies of the tokenizers are; read on the driver and sent to the tasks.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# The rules that pages are judged by.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def good_ids(spark, sf_dir):
    """Ids of documents labelled as good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(crc_remainder("doc_id", 4) != 2)
    scored = score_quality(docs, fit_quality(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, good_ids(spark, sf_dir), keep=[])


def op3_ngram_jaccard_join(spark, sf_dir):
    return similar_components(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, crc_remainder("doc_id", 7) == 2, read_vocabulary(VOCABULARY))


def _labels(array):
    return F.array_join(F.array_sort(F.array_distinct(array)), ",")


def op5_license_scans(spark, sf_dir):
    found = find_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    places, notices = F.col("places"), F.col("notices")
    starts = F.transform(places, lambda p: p["start"].cast("bigint"))
    base = F.transform(places, lambda p: p["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.concat(base, F.transform(notices, lambda n: n["label"]))).alias("labels"),
        "score",
        notices,
    )


def op6_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    hit = n_hit(F.col("leaks")).cast("bigint")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("leak_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("leak_items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op7_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs)


def op8_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = tokenize(docs, read_vocabulary(VOCABULARY), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(crc_remainder("doc_id", 5) != 0))
    held_out = (crc_remainder("doc_id", 5) == 0).alias("held_out")
    return predict(docs, model, keep=["doc_id"]).select("doc_id", held_out, "lang_pred", "score")


def op10_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark, URL_RULES)).drop("url")


def op11_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_embedding_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(rows, components=8)
    white = whiten(rows, model, keep=["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, explained, error = (model.n, model.explained.tolist(), model.identity_error) if model else (0, [], 0.0)
    return white.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        # Null where 64 bits do not hold it; the operator's own column does.
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_piece_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_pieces(docs, read_model(PIECES), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scans": op5_license_scans,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_language_id": op9_language_id,
    "op10_url_filters": op10_url_filters,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_piece_round_trip": op13_piece_round_trip,
}

_ADDRESS = """
address AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages)"""

ORACLES = {
    "op10_url_filters": "WITH rules(verdict, host, path) AS (VALUES "
    + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    + f"), {_ADDRESS},"
    """
best AS (
    SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
        arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM address a JOIN rules r
    ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)
    GROUP BY page_id)
SELECT a.page_id, a.host, a.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM address a LEFT JOIN best b USING (page_id)""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
rows_of_words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM rows_of_words),
counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
    FROM places, (VALUES (1), (2), (3)) sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND n >= 10),
inside AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
    FROM candidates WHERE k = 3),
covers AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
cuts AS (
    SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS first_part, array_to_string(w[cut + 1:k], ' ') AS rest
    FROM (SELECT c.*, unnest(range(1, k)) AS cut FROM candidates c) c LEFT JOIN covers USING (lang, phrase)
    WHERE most IS NULL OR 100 * most < 50 * a),
scores AS (
    SELECT cuts.lang, cuts.phrase, a, cut, x.n AS l, y.n AS r,
        CAST(1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n) AS BIGINT) AS score
    FROM cuts JOIN counts x ON cuts.lang = x.lang AND first_part = x.phrase
    JOIN counts y ON cuts.lang = y.lang AND rest = y.phrase),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
