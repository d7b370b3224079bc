"""The registered queries of this subpackage, over whole tables, and their SQL twins where SQL can express them."""

from tallyleaf.llm import chat, digests, langid, licenses, mixing, pii, qgrams, repair, simhash, spelling
from tallyleaf.llm import token_counts, tokens, toxicity
from tallyleaf.llm.tables import new_table, read


def op1_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op2_chat_formatting(spark, folder):
    return chat.digests(chat.format_chats(chat.with_probe(read(spark, folder, "conversations"))))


def op3_token_output(spark, folder):
    import public_tokenizers

    shards = tokens.write_shards(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokens.read_documents(shards)


def op4_license_scan(spark, folder):
    return licenses.report(licenses.scan(read(spark, folder, "documents")))


def op5_toxicity(spark, folder):
    return toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op6_pii(spark, folder):
    return pii.report(pii.sanitise(read(spark, folder, "documents")))


def op7_benchmark_decontamination(spark, folder):
    return qgrams.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op8_exact_dedup(spark, folder):
    return digests.exact_duplicates(read(spark, folder, "documents"))


def op9_language_id(spark, folder):
    return langid.languages(read(spark, folder, "documents"))


def op10_source_mixing(spark, folder):
    return mixing.mix(read(spark, folder, "documents"))


def op11_spelling_variants(spark, folder):
    return spelling.variants(read(spark, folder, "documents"))


def op12_structure_repair(spark, folder):
    turns = read(spark, folder, "conversations")
    return repair.digests(turns, repair.repair(new_table(repair.damaged(turns), "damaged")))


def op13_token_counts(spark, folder):
    """The counts of all prefixes are stored, and what is asked is answered from them; ``fits`` is the longest prefix within the limit."""
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    stored = new_table(token_counts.prefix_counts(read(spark, folder, "documents"), file), "prefix-counts")
    told = token_counts.answers(stored)
    return told.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {token_counts.LIMIT} over_limit", "fits")


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_chat_formatting,
        op3_token_output,
        op4_license_scan,
        op5_toxicity,
        op6_pii,
        op7_benchmark_decontamination,
        op8_exact_dedup,
        op9_language_id,
        op10_source_mixing,
        op11_spelling_variants,
        op12_structure_repair,
        op13_token_counts,
    )
}

ORACLE = {
    "op2_chat_formatting": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) n,
    lag(role) over (partition by conv_id order by turn nulls first, role, text) before
  from turns
), sized as (
  select *, before is not distinct from role and n > 1 as merged,
    length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) size,
    length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;')) role_size
  from placed
)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) turns_sha256,
  length(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) loss_sha256,
  cast(sum(size + case when merged then 11 else 12 + role_size + 1 + 11 end) as bigint) formatted_chars
from sized group by conv_id""",
    "op8_exact_dedup": """
with digests as (select doc_id, sha256(coalesce(text, '')) text_sha256 from documents),
groups as (select text_sha256, max(doc_id) keep_id, count(*) group_size from digests group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from digests join groups using (text_sha256)""",
}
