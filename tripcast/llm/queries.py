"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm import alignment, bytebpe, chat, embeddings, langid, lines, minhash, packing, quality, sharding, substring, survival, unigram


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json"), added=True)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words",
                      F.sha2("clean_text", 256).alias("clean_sha256"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    coded = unigram.encode(_read(spark, sf_dir, "documents", "doc_id", "text"), model)
    out = unigram.decode(coded, model)
    return out.select("doc_id", (F.octet_length("piece_ids") / 4).cast("long").alias("n_ids"), F.crc32("piece_ids").alias("ids_crc32"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(_read(spark, sf_dir, "documents", "doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"), threshold=0.95)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = langid.learn(docs.where(~langid.held_out()))
    return langid.identify(docs.select("doc_id", "text"), profiles).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents", "doc_id", "text"), shards=24)


_TEXT = {"type": "string", "minLength": 1}
_FROM = {"type": "object", "properties": {"$ref": {"type": "string"}}, "required": ["$ref"], "additionalProperties": False}
TOOLS = {
    "search": {"type": "object", "properties": {"query": _TEXT, "limit": {"type": "integer", "minimum": 0, "maximum": 5}, "context": _FROM},
               "required": ["query", "limit"], "additionalProperties": False},
    "summarise": {"type": "object", "properties": {"query": _TEXT, "limit": {"type": "integer"}, "context": _FROM}, "required": ["query"]},
    "store": {"type": "object", "properties": {"query": _TEXT, "limit": {"type": "number"}}, "required": ["query"], "additionalProperties": False},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls, derived from plain conversations.

    By the length n of a turn's text (in code points): two thirds of the assistant's turns call
    a tool with the whole text as an argument, some of them unknown tools, unreadable or wrong
    arguments, or referring to an earlier call; every other user turn is the result of
    the turn before it, whether that called a tool or not.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    before = F.concat(F.lit("call_"), (F.col("turn") - 2).cast("string"))
    name = F.element_at(F.array(*[F.lit(x) for x in ("search", "summarise", "store", "fax")]), (n % 4 + 1).cast("int"))
    limit = F.when(n % 13 == 0, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).otherwise((n % 7).cast("string"))
    context = F.when((n % 5 == 0) & (F.col("turn") >= 2), F.concat(F.lit(',"context": {"$ref": "'), before, F.lit('"}'))).otherwise("")
    query = F.to_json(F.struct(F.col("text").alias("query")), {"ignoreNullFields": "false"})
    # {"query":...} becomes {"limit": ..., "query":..., "context": ...}: neither sorted nor free of white space
    spoken = F.concat(F.lit('{"limit": '), limit, F.lit(", "), F.expr("substring(q, 2, length(q) - 2)"), context, F.lit("}"))
    arguments = F.when(n % 11 == 0, F.col("text")).otherwise(spoken)
    rows = conversations.withColumn("q", query)
    call = F.array(F.struct(F.concat(F.lit("call_"), F.col("turn").cast("string")).alias("id"), name.alias("name"), arguments.alias("arguments")))
    calls = (F.col("role") == "assistant") & (n % 3 != 0)
    result = (F.col("role") == "user") & (F.col("turn") > 0) & (n % 2 == 0)
    return rows.select("conv_id", "turn", F.when(result, "tool").otherwise(F.col("role")).alias("role"), "text", F.when(calls, call).alias("tool_calls"),
                       F.when(result, F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string"))).alias("tool_call_id"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tool_messages(_read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return chat.link_tool_calls(messages, TOOLS)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survival.audit(_read(spark, sf_dir, "documents", "doc_id", "text", "lang"), _read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    out = bytebpe.decode(bytebpe.encode(_read(spark, sf_dir, "documents", "doc_id", "text"), ranks), ranks)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict:
    own = (op1_substring_dedup, op2_packing, op3_quality_rules, op4_minhash_dedup, op5_sentencepiece, op6_line_dedup, op7_embedding_dedup,
           op8_language_id, op9_sharding, op10_chat_formatting, op11_token_alignment, op12_filter_audit, op13_byte_bpe)
    return {f.__name__: f for f in own}
