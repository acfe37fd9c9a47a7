"""Registered queries of the text operators: each runs one operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from periodlens.llm import (chosen_path, chunk_recipes, decontam, fingerprint, html_main, langid, line_dedup, ngram_trie, packing,
                            periodic_runs, radix_windows, source_divergence, url_filter)
from periodlens.llm.common import read_table

URL_RULES = (("net", "/", "net/", "block"), ("example.net", "/en/", "example.net/en/", "allow"),
             ("example.com", "/de/", "example.com/de/", "block"), ("org", "/fr/", "org/fr/", "allow"))


def op1_line_dedup(spark, sf_dir):
    """Every document's text without repeated lines, and how many lines went."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, count_cols=("n_lines", "n_removed"))


def op2_document_fingerprints(spark, sf_dir):
    """Multiset fingerprints of every document and its edited form."""
    return fingerprint.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The public tokenizer that packing uses; its files are installed beside the interpreter."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark, sf_dir):
    """All documents' tokens in windows of 2048 that are filled with lexical neighbours."""
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_html_extraction(spark, sf_dir):
    """Main text of every page by tag-path ratios."""
    return html_main.extract_main_text(read_table(spark, sf_dir, "pages"))


def op5_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, with the item and its containment."""
    return decontam.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark, sf_dir):
    """Scores of all documents by a bigram trie that learns from nine of ten folds."""
    docs = read_table(spark, sf_dir, "documents")
    return ngram_trie.score_documents(docs, langid.held_out(docs["doc_id"], 10))


def op7_language_id(spark, sf_dir):
    """Language of every document; the models learn from four of five folds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id"), 5))
    models = langid.train(docs.where("not held_out"))
    return (langid.predict(docs.select("doc_id", "held_out", "text"), models)
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


def op8_url_filter(spark, sf_dir):
    """Verdict for every page's URL by the fixed rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, rule string, verdict string")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), rules)


def op9_near_dedup(spark, sf_dir):
    """Near-duplicate groups of the documents: two-word shingles, Jaccard similarity of at least 0.8."""
    return (chosen_path.near_duplicates(read_table(spark, sf_dir, "documents"), words=2, percent=80)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op10_suffix_dedup(spark, sf_dir):
    """Bytes of every document that a 50-byte string of a document with a smaller id covers, removed."""
    return (radix_windows.remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def with_periodic_ends(docs):
    """The documents of op11: one in ten ends with repetitions of its own words, by the checksum h of its id.

    With n words, g = h / 10, a = g % n and p = 1 + (n - a) / (3 + g % 8) (divisions round down), each word i >= a becomes the word
    a + (i - a) % p.
    """
    words = F.regexp_extract_all("text", F.lit(periodic_runs.WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    edited = """array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), int((size(w) - a) div p) + 1)),
                                                           1, size(w) - a)), ' ')"""
    return (rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(size(w) > 0, int(g % size(w)), 0)"))
            .withColumn("p", F.expr("int(1 + (size(w) - a) div (3 + g % 8))"))
            .select("doc_id", F.when(F.size("w") > 0, F.expr(edited)).otherwise(F.col("text")).alias("text")))


def op11_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document (one in ten with periodic ends), and what stays without repetitions."""
    found = periodic_runs.find_runs(with_periodic_ends(read_table(spark, sf_dir, "documents")))
    top = F.col("top")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", periodic_runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
        top["period"].alias("period"), F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_exact_dedup(spark, sf_dir):
    """Groups of equal documents (white space aside) and the row of each that stays."""
    return chunk_recipes.exact_groups(read_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    """Distances between the sources of a language, and each source's leading terms."""
    return source_divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_document_fingerprints, op3_packing, op4_html_extraction, op5_benchmark_decontamination,
    op6_lm_scoring, op7_language_id, op8_url_filter, op9_near_dedup, op10_suffix_dedup, op11_periodic_runs, op12_exact_dedup, op13_source_divergence)}
