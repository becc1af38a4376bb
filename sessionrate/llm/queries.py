"""One registered query per corpus operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionrate.llm import (alignment, classlm, langid, lz, mixing, pii, quality, rotcodes, sentencepieces,
                             sharding, simhash, warc, whitening)
from sessionrate.llm.common import read_table, scratch_path


def q_op1(spark, sf_dir):
    """Every document's shard among 32, and among the first 31 of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    names = list(sharding.SHARDS)
    return sharding.place(docs, shards=names, also={"shard_with_one_fewer": names[:-1]})


def q_op2(spark, sf_dir):
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fp().alias("fingerprint"),
                      F.col("component").alias("component_id"))


def q_op3(spark, sf_dir):
    return quality.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def q_op4(spark, sf_dir):
    return lz.edited_likeness(read_table(spark, sf_dir, "documents"))


def q_op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    net = langid.fit(langid.training_pieces(docs))
    rows = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return langid.identify(rows, net, drop=("text",))


def q_op6(spark, sf_dir):
    """Every document's text with validated personal values replaced."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key=pii.PUBLIC_TEST_KEY)


def q_op7(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    return warc.read_records(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_op8(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.mix_copies(docs, target_entropy=0.99, max_repeat=4.0, budget="corpus")
    return out.select("doc_id", "source", mixing.count_tokens(F.col("text")).alias("n_tokens"),
                      "copies")


def q_op9(spark, sf_dir):
    return classlm.score(read_table(spark, sf_dir, "documents"))


def q_op10(spark, sf_dir):
    """Every document's piece ids, and whether they decode to its text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.with_ids(docs, sentencepieces.read_model(), check=True, drop=("text",))


def q_op11(spark, sf_dir):
    return alignment.score_links(read_table(spark, sf_dir, "documents"))


def q_op12(spark, sf_dir):
    out = rotcodes.near_duplicates(read_table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("component", "component_id")


def q_op13(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_permutation_table_sharding": q_op1,
    "op2_simhash_pigeonhole": q_op2,
    "op3_line_first_quality": q_op3,
    "op4_lz_phrase_fingerprint": q_op4,
    "op5_byte_bigru_langid": q_op5,
    "op6_feistel_pseudonyms": q_op6,
    "op7_content_addressed_warc": q_op7,
    "op8_temperature_mixing": q_op8,
    "op9_brown_class_lm": q_op9,
    "op10_sentencepiece_viterbi": q_op10,
    "op11_pointer_jumping_alignment": q_op11,
    "op12_rotation_code_dedup": q_op12,
    "op13_feast_whitening": q_op13,
}
