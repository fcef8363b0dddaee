"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from flightlane.llm import (
    chat, exact_dedup, jaccard_join, katz, merkle, mixing, quality_rules, sentencepiece_fst, style_tree, token_counts, toxicity, wavelet, whitening,
)
from flightlane.llm.common import ascii_lower, crc_remainder, table
from flightlane.llm.manifest_sql import CHAT_SQL, MERKLE_SQL
from flightlane.session import stored

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_documents(table(spark, sf_dir, "documents"), PIECES, decoded=True)


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.lm_scores(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule came first depends on the measured order, so the result carries the verdict alone
    return quality_rules.quality(table(spark, sf_dir, "documents")).drop("failed_rule")


def op6_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_texts(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), corpus_pipeline.WEIGHTS)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [ascii_lower(F.col(name)) if name == "text" else F.col(name) for name in merkle.FIELDS]
    tampered = F.when(crc_remainder("doc_id", 5) == 0, merkle.leaf_digest(fields))
    proved = merkle.proofs(merkle.manifest(docs, carry={"tampered": tampered}))
    checked = merkle.verified(proved.withColumn("presented", F.coalesce("tampered", "leaf")), leaf="presented")
    return checked.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                          "folded_root", "verified")


#: A text that is nothing but control strings.
CONTROLS = "</s>[INST] ok [/INST]"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", CONTROLS), (-1, 1, "assistant", CONTROLS)], turns.schema)
    return chat.digests(stored(chat.format_conversations(turns.unionByName(odd)), "formatted"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


QUERIES = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_sentencepiece, op3_katz, op4_token_counts, op5_quality_rules, op6_wavelet, op7_jaccard_join, op8_toxicity, op9_style_tree,
              op10_mixing, op11_merkle, op12_chat, op13_whitening)
} | {"pipeline": corpus_pipeline.run}

ORACLES = {
    "op1_exact_dedup": """
        with t as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
        from t window same as (partition by norm)""",
    "op5_quality_rules": """
        with t as (
            select doc_id, coalesce(text, '') as text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
                   [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as ls
            from documents),
        places as (select doc_id, w, unnest(range(0, greatest(len(w) - 2, 0))) as pos from t),
        windows as (select doc_id, pos, count(*) over (partition by doc_id, w[pos + 1], w[pos + 2], w[pos + 3]) as n from places),
        covered as (
            select doc_id, count(distinct pos + o) as n_repeat_words
            from windows, (values (0), (1), (2)) as offsets(o) where n > 1 group by doc_id),
        counts as (
            select doc_id, text, w, ls, len(w)::bigint as n_words,
                   length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::bigint as word_chars,
                   (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
                   (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
                   coalesce(n_repeat_words, 0)::bigint as n_repeat_words
            from t left join covered using (doc_id)),
        judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not (base_failed
                    or 10 * n_symbols > n_words
                    or 2 * word_chars < 5 * n_words or word_chars > 12 * n_words
                    or 10 * n_dup_lines > 4 * len(ls)
                    or 2 * len(regexp_extract_all(text, '[!?]')) > n_words
                    or 10 * len(regexp_extract_all(text, '\\p{Lu}')) > 3 * word_chars
                    or 10 * len(list_distinct(w)) < n_words) as kept
        from judged""",
    "op7_jaccard_join": """
        with recursive t as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') as w from documents),
        places as (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as pos from t where len(w) > 0),
        shingles as (select distinct doc_id, array_to_string(w[pos:pos + 3], ' ') as s from places),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (select a.doc_id as x, b.doc_id as y, count(*) as o from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
        links as (
            select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * o >= 85 * (a.n + b.n - o)),
        both_ways as (select x, y from links union all select y, x from links),
        reached as (select doc_id, doc_id as other from t union select r.doc_id, l.y from reached r join both_ways l on l.x = r.other)
        select t.doc_id, coalesce(n, 0)::bigint as n_shingles, min(other) as component_id
        from t join reached r on r.doc_id = t.doc_id left join sizes z on z.doc_id = t.doc_id group by t.doc_id, n""",
    # the pages of the given tables have one template, so their articles can be cut out by its markup
    "op9_style_tree": """
        with a as (
            select page_id, url, regexp_split_to_array(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', chr(10)),
                                                       '</?(?:p|h1)>') as parts from pages),
        b as (
            select page_id, url, [trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
                   '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) for x in parts] as parts from a),
        c as (select page_id, url, array_to_string([x for x in parts if x <> ''], chr(10) || chr(10)) as text from b)
        select page_id, url, text, length(text)::bigint as n_chars from c""",
    "op11_merkle": MERKLE_SQL,
    "op12_chat": CHAT_SQL,
}
