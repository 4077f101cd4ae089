"""The named queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.llm import (
    bwt_repeats,
    forced_bpe,
    heavy_dedup,
    html_layout,
    int8_tiles,
    license_align,
    minhash_bayes,
    oracles,
    sainte_lague,
    term_transducer,
    url_trie,
    value_codebooks,
    weak_labels,
    zstd_language,
)

# the rules that the url query judges by
URL_RULES = [
    ("net", "/", url_trie.BLOCK),
    ("example.net", "/en/", url_trie.ALLOW),
    ("example.com", "/de/", url_trie.BLOCK),
    ("org", "/fr/", url_trie.ALLOW),
]


def word_bpe_file() -> str:
    """Where the word-end BPE vocabulary lies; it is read by the driver only."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = weak_labels.judge_quality(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.score", "quality.posterior", "quality.kept")


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = license_align.scan_licenses(docs, license_align.known_licenses())
    best = F.get("licenses", F.lit(0))
    return scanned.select(
        "doc_id",
        F.size("licenses").alias("n_licenses"),
        *[best.getField(c).alias(c) for c in ("license", "coverage", "first_word", "last_word")],
    )


def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_bayes.near_components(table(spark, folder, "documents"), width=4)


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "html")
    return html_layout.extract_text(pages).select("page_id", F.col("extracted").alias("text"))


def op5_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return int8_tiles.cosine_links(table(spark, folder, "embeddings"))


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_trie.judge_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "decision.rule", "decision.verdict")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", part.alias("part"))
    model = zstd_language.fit_languages(docs.where("part <> 1"))
    judged = zstd_language.identify_languages(docs, model)
    return judged.select(
        "doc_id",
        F.coalesce(F.col("part") == 1, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
        "language.accepted",
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = heavy_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    pieces = sainte_lague.mix_pieces(table(spark, folder, "documents"))
    return pieces.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", sainte_lague.taken_words().alias("taken")
    )


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = forced_bpe.encode_documents(docs, word_bpe_file(), forms=("packed", "decoded"))
    return coded.select(
        "doc_id",
        (F.octet_length("bpe.packed") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("bpe.packed", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = value_codebooks.compress_vectors(table(spark, folder, "embeddings"))
    digest = F.lit(value_codebooks.codebooks_digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)


def op12_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = bwt_repeats.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return term_transducer.audit_sources(table(spark, folder, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_html_text": op4_html_text,
    "op5_embedding_links": op5_embedding_links,
    "op6_url_rules": op6_url_rules,
    "op7_language": op7_language,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixture": op9_mixture,
    "op10_bpe": op10_bpe,
    "op11_vector_codes": op11_vector_codes,
    "op12_repeats": op12_repeats,
    "op13_source_audit": op13_source_audit,
}

ORACLES = {
    "op6_url_rules": """
        WITH rest AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), ruled AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op8_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op11_vector_codes": oracles.vector_codes(),
    "op13_source_audit": oracles.SOURCE_AUDIT,
}
