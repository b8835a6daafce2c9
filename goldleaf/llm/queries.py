"""The registered queries of this subpackage: each applies one operator with
production parameters to its whole table, and its SQL twin where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.chat_format import chat_digest, format_chats
from goldleaf.llm.collision_search import nearest
from goldleaf.llm.common import let, read_table
from goldleaf.llm.decontaminate import contamination
from goldleaf.llm.embedding_dedup import embedding_groups
from goldleaf.llm.filter_audit import audit_filters
from goldleaf.llm.html_extract import extract
from goldleaf.llm.language_id import held_out, identify
from goldleaf.llm.license_scan import scan_licenses
from goldleaf.llm.line_dedup import dedup_lines
from goldleaf.llm.mixing import mix
from goldleaf.llm.periodic_runs import periodic_runs
from goldleaf.llm.ppm import score_texts
from goldleaf.llm.simhash_tiles import hex_fingerprint, simhash_groups
from goldleaf.llm.sqltwins import ORACLES

__all__ = ["ORACLES", "QUERIES"]

# Fixed value: the conversation the contract adds to the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", "posterior", "domain", "rate", "copies")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("matches")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(CONTROL_TEXT).alias("text"))
        for k, role in enumerate(["user", "assistant"])])))
    return chat_digest(format_chats(turns.unionByName(extra)))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(read_table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents").withColumn("held_out", held_out(7, 2)))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's table: in one document of ten, chosen by the crc32 of its
    id, the words from a place on repeat with a period; both follow from that
    number and the number of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(turned, " ")).otherwise("")

    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.col3")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_html_extraction": op3_html_extraction,
    "op4_license_scan": op4_license_scan,
    "op5_chat_format": op5_chat_format,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
