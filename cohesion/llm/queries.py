"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, bpe, conversations, fill_middle, fingerprints, fuzzy_lines, html_template, licenses, ngram_join, packing, quality_crf, stream_dedup, token_edits
from .common import table, text_or_empty


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is. Pass another path to the operators to use another file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.main_text(table(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), ids=False)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.dedup_report(spark, f"{sf_dir}/documents.parquet")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fuzzy_lines.drop_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_kept", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copies", "class_size", "kept")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # alone on its executors, unlike the pipeline's stage, it has room to remember more words
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), remember=192 << 20)


def three_edits(docs: DataFrame) -> DataFrame:
    """docs with an edit at a quarter (insert), half (replace) and the end (delete) of each text, from its own words."""
    n = F.length("text")
    edit = lambda start, length, new: F.struct(start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), new.alias("replacement"))
    text = docs.select("doc_id", text_or_empty().alias("text"))
    return text.withColumn("edits", F.array(
        edit(F.floor(n / 4), 0, F.substring("text", 1, 25)),
        edit(F.floor(n / 2), 20, F.expr("right(text, 15)")),
        edit(F.greatest(n - 10, F.lit(0)), 10, F.lit(""))))


def op9_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_edits.count_tokens(three_edits(table(spark, sf_dir, "documents")), vocabulary("byte_bpe_50k.json"))


def op10_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints.compare_edits(docs, fingerprints.rarity_ranks(fingerprints.entropy_counts(docs)))


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_site_templates, op2_byte_bpe, op3_license_scan, op4_stream_dedup, op5_quality_crf,
    op6_fuzzy_lines, op7_ngram_join, op8_best_fit_packing, op9_edit_token_counts, op10_improbable_features,
    op11_attention_lm, op12_fill_middle, op13_conversation_repair)}

#: DuckDB SQL where SQL can say what the operator says. translate() there, too, lower-cases A-Z alone.
ORACLE = {
    "op4_stream_dedup": """
        with n as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents),
        h as (select doc_id, sha256(norm) as text_sha256 from n),
        g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from h group by 1)
        select h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id as kept, h.text_sha256 from h join g using (text_sha256)""",
    "op12_fill_middle": """
        with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
        h as (select doc_id, text, u, len(u) as n, cast('0x' || d[1:8] as bigint) as h1, cast('0x' || d[9:16] as bigint) as h2,
                cast('0x' || d[17:24] as bigint) as h3, cast('0x' || d[25:32] as bigint) as h4 from t),
        c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                     when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
        p as (select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid, array_to_string(u[b + 1:n], '') as suf from c)
        select doc_id, n, form, case when form != 'plain' then length(pre) end as prefix_chars, case when form != 'plain' then length(mid) end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
            sha256(text) as restored_sha256
        from p""",
}
