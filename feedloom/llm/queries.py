"""Driver queries of the training-data operators: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.llm import embedding_dedup, jaccard_join, line_dedup, mixing, packing, quality_classifier, quality_rules, secret_scan, spelling_variants, suffix_dedup, token_counts, tokenizer_alignment, warc
from feedloom.session import scratch_path


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op2_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(~quality_classifier.held_out(F.col("doc_id"))))
    held_out = quality_classifier.held_out(F.col("doc_id")).alias("held_out")
    return quality_classifier.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op3_warc(spark, sf_dir):
    path = scratch_path(spark, "archives")
    warc.archive(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path)


def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trusted = quality_rules.trusted_documents(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, trusted)


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    vocabulary = token_counts.whole_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_secret_scans(spark, sf_dir):
    owner, repository = F.col("source"), F.concat_ws("/", "source", "lang")
    return secret_scan.scan(table(spark, sf_dir, "documents"), owner=owner, repository=repository)


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants.variants(spelling_variants.word_counts(table(spark, sf_dir, "documents")))


def op12_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    first, second = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return tokenizer_alignment.align(table(spark, sf_dir, "documents"), first, second).documents


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_secret_scans": op10_secret_scans,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_line_dedup": op12_line_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
