"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.llm import disclosure, idfiles, jaccard, maglev, mincut, mixing, paragraphs, repair, repetition, secrets, tiling, toxicity, trie
from gaugeframe.storage import scratch_path

SHARDS = [f"shard-{i:03d}" for i in range(128)]

DOMAINS = ("web", "reference", "forum", "news")
MIX_WEIGHTS = {"domain": {"web": 4, "reference": 3, "forum": 2, "news": 1}, "lang": {"en": 6, "de": 2}}
BUDGET_SHARE = (3, 4)
MAX_EPOCHS = 2
MIX_SEED = 17
TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition(read(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, folder, "documents"))
    return spans_digest(found, secrets.KINDS[:3])


def spans_digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""

    def text(span):
        return F.concat_ws(":", span["kind"], span["start"], span["end"])

    def number_of(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number_of(kind) for kind in base]
    joined = F.concat_ws(",", F.transform(F.filter("found", lambda s: s["kind"].isin(*base)), text))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("found", text)).alias("spans"),
    )


def op3_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    found = disclosure.find_personal_data(read(spark, folder, "documents"))
    return spans_digest(found.withColumnRenamed("spans", "found"), disclosure.KINDS[:4])


def op4_paragraph_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_text(read(spark, folder, "documents"))


def op4_passage_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_passages(read(spark, folder, "documents"))


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return toxicity.add_scores(documents, toxicity.fit(documents, labels))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(documents, read(spark, folder, "labels"))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return mincut.extract(read(spark, folder, "pages"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, folder, "documents"))


def mix(documents: DataFrame) -> DataFrame:
    """The production mixture: a tree of domain, language and source."""
    digest = F.substring(F.md5(F.coalesce("source", F.lit("unknown")).cast("binary")), 1, 8)
    group = F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(len(DOMAINS)).cast("long")).cast("int")
    domain = F.element_at(F.array(*map(F.lit, DOMAINS)), group + 1)
    levels = {"domain": domain, "lang": documents["lang"], "source": documents["source"]}
    return mixing.mix_sources(documents, levels, MIX_WEIGHTS, BUDGET_SHARE, MAX_EPOCHS, MIX_SEED)


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(read(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", "mix_domain", "mix_lang", "mix_source", "mix_tokens", "mix_epoch")


def op9_shard_table(spark: SparkSession, folder: str) -> DataFrame:
    placed = maglev.assign_shards(read(spark, folder, "documents"), SHARDS)
    return placed.select("doc_id", "slot", "shard")


def op10_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of ``conv_id:turn``; ``copies`` 0 is a dropped turn.

    Nulls are one space, in the hashed text as in role and text.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("role", "text"))
    place = F.concat_ws(":", *[F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(place.cast("binary")) % 20
    return conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(damaged(read(spark, folder, "conversations")))


def op12_id_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    root = scratch_path(spark, "ids")
    idfiles.write_ids(read(spark, folder, "documents"), root, public_tokenizers.path(TOKENIZER), END_ID, words_apart=True)
    return idfiles.id_digests(spark, root)


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin with turns of another one, as samples branched from it do.

    Conversation c has the first h turns of conversation c - c % ``every``, then its own after
    its first h; h is the CRC-32 of its id, modulo ``most``.
    """
    conv = F.col("conv_id")
    taken = F.crc32(conv.cast("string").cast("binary")) % F.lit(most)
    heads = turns.filter(conv % F.lit(every) == 0).select(conv.alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    own = turns.select("conv_id", (conv - conv % F.lit(every)).alias("base"), taken.cast("int").alias("taken"), "turns")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.array().cast(heads.schema["head"].dataType))
    rest = F.slice("turns", F.col("taken") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(rebuilt(trie.sequences(read(spark, folder, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition_rules": op1_repetition_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_disclosure": op3_disclosure,
    "op4_paragraph_repeats": op4_paragraph_repeats,
    "op4_passage_repeats": op4_passage_repeats,
    "op5_toxicity": op5_toxicity,
    "op6_main_text": op6_main_text,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_source_mix": op8_source_mix,
    "op9_shard_table": op9_shard_table,
    "op10_string_tiling": op10_string_tiling,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_id_files": op12_id_files,
    "op13_prefix_trie": op13_prefix_trie,
}
