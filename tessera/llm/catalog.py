"""Registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import arrow_tokens, decontam, layout_html, merkle, near_dup, oracle, packing, quality, repair, secrets, sketches, toxicity, url_templates, warc
from tessera.llm._common import read_table, scratch
from tessera.llm.tokens import tokenizer_path

QUERIES, ORACLE = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_distribution_divergence(spark, sf_dir):
    return quality.quality_verdicts(read_table(spark, sf_dir, "documents"))


# The rules of the contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query
def op2_path_template_tree(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    # a page is labelled as the document is whose number ends its path
    number = F.regexp_extract("url", r"://[^/?#]*/(?:[^?#]*/)?([0-9]{1,18})[^0-9/?#]*/?(?:[?#]|$)", 1)
    bad = read_table(spark, sf_dir, "labels").select(F.col("doc_id"), (1 - F.col("quality")).alias("bad"))
    labels = (pages.withColumn("n", number).selectExpr("page_id", "try_cast(n AS bigint) AS doc_id")
              .join(bad, "doc_id").select("page_id", "bad"))
    return url_templates.url_verdicts(pages, labels, URL_RULES)


@query
def op3_arrow_token_files(spark, sf_dir):
    out = scratch(spark, "token-files")
    arrow_tokens.write_token_files(read_table(spark, sf_dir, "documents"), out, tokenizer_path("word_bpe_49k.json"))
    return arrow_tokens.read_token_files(spark, out)


@query
def op4_min_bin_slack(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op5_compression_distance(spark, sf_dir):
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), max_chars=None)


@query
def op6_ownership_frequency(spark, sf_dir):
    return secrets.secret_report(read_table(spark, sf_dir, "documents"), owner=F.col("source"),
                                 repository=F.concat_ws("/", "source", "lang"))


@query
def op7_prefix_filtered_join(spark, sf_dir):
    return decontam.contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op8_layout_rendering(spark, sf_dir):
    return layout_html.rendered_pages(read_table(spark, sf_dir, "pages"))


@query
def op9_chosen_path(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), width=4)


@query
def op10_transaction_assembly(spark, sf_dir):
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    return warc.captures(spark, manifest, with_payload=False).select(
        "page_id", "response.payload_bytes", "response.payload_digest", "record_type", "refers_to")


@query
def op11_rank_convergence(spark, sf_dir):
    return repair.repaired_conversations(read_table(spark, sf_dir, "conversations"))


@query
def op12_bottom_k_sketch(spark, sf_dir):
    return sketches.edited_fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op13_slot_pivot(spark, sf_dir):
    return merkle.verified_documents(read_table(spark, sf_dir, "documents"))


ORACLE |= {"op1_distribution_divergence": oracle.OP1, "op6_ownership_frequency": oracle.OP6, "op7_prefix_filtered_join": oracle.OP7,
           "op9_chosen_path": oracle.OP9, "op10_transaction_assembly": oracle.OP10,
           "op11_rank_convergence": oracle.OP11, "op13_slot_pivot": oracle.OP13}
