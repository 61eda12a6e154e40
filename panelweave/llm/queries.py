"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.llm import align, decontam, lines, minhash, nbsvm, pieces, pii, quality, search, spans, suffixes, toxicity, urls
from panelweave.session import use_settings


BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the session hands texts to Python in batches of a bounded size."""
    for setting, value in BATCHES.items():
        spark.conf.set(setting, value)
    return use_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_table(spark)).drop("url")


def op2_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.judge(docs, pii.learn(docs))


def op3_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality.judge(docs, labels)
    named = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*named, "anomaly")


def op4_benchmark_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark, sf_dir):
    judged = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "worst", "offending")


def op6_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op7_suffix_dedup(spark, sf_dir):
    cut = suffixes.drop_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark, sf_dir):
    return lines.drop_boilerplate(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark, sf_dir):
    return spans.drop_repeated_spans(table(spark, sf_dir, "documents"))


def piece_model() -> bytes:
    """The public model file's bytes, read where the query is built and shared from there."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op10_pieces(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


def op11_ranked_search(spark, sf_dir):
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark, sf_dir):
    judged = nbsvm.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "margin")


def vocabularies() -> align.Vocabularies:
    """The two public vocabularies, read where the query is built and shared from there."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return align.Vocabularies(file.read(), piece_model())


def op13_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    files = vocabularies()
    return align.digests(docs, files, align.learn(docs, files))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_pii,
        op3_quality_rules,
        op4_benchmark_decontamination,
        op5_toxicity,
        op6_minhash_near_dedup,
        op7_suffix_dedup,
        op8_line_dedup,
        op9_substring_dedup,
        op10_pieces,
        op11_ranked_search,
        op12_quality_classifier,
        op13_token_alignment,
    )
}
SQL = {"op1_url_filters": urls.twin(), "op8_line_dedup": lines.twin(), "op11_ranked_search": search.twin()}
