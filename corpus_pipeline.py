"""Corpus preparation pipeline: from raw documents to piece ids.

Five stages, each one operator of ``sessionrate.llm`` on all that its predecessor kept:

1. quality: line-first cleaning; failing lines leave the texts, rejected documents go.
2. near-duplicates: the SimHash operator with its own contract (3 words, at most 2 of 64 bits);
   of each group the row with the smallest doc_id stays.
3. pii: validated values become format-preserving pseudonyms.
4. mixing: sources are weighted by temperature; the mixture reads every document at least
   once and no source more than ``MAX_REPEAT`` times as often as another, so documents of
   small sources appear as several rows and none is lost.
5. pieces: SentencePiece ids.

All stages but the last return the columns of their input; n_chars follows the text.
Every stage's result is written as Parquet in the shared checkpoint folder and read back.

Defined cases, besides those of the operators: NULL and empty texts fall under the quality
rules and go; repeated rows are near-duplicates of each other; extra columns are carried
to the fourth stage; no documents give no rows.
"""

from pyspark.sql import functions as F

from sessionrate.llm import mixing, pii, quality, sentencepieces, simhash
from sessionrate.llm.common import materialize, prepare, read_table

TARGET_ENTROPY = 0.99      # of the uniform entropy over sources
MAX_REPEAT = 2.0
#: a public one: give a key of your own where the pseudonyms must not be undone by others
PSEUDONYM_KEY = pii.PUBLIC_TEST_KEY

#: SimHash, temperature weights and piece ids have no SQL form; see tests/llm
ORACLE_SQL = None


def _apart(docs, *names):
    """``names`` of ``docs`` beside the whole row, so that none of its columns can clash."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), *names)


def _back(rows, docs, text=None):
    """The columns of ``docs`` again, with ``text`` as the text, and its length."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


def quality_stage(spark, docs, sf_dir):
    prepare(spark)
    rows = quality.clean(_apart(docs, "text")).filter("kept")
    return _back(rows, docs, F.col("clean_text"))


def near_duplicate_stage(spark, docs, sf_dir):
    prepare(spark)
    return simhash.one_per_group(docs)


def pii_stage(spark, docs, sf_dir):
    prepare(spark)
    return _back(pii.pseudonymise(_apart(docs, "text"), key=PSEUDONYM_KEY), docs, F.col("text"))


def mixing_stage(spark, docs, sf_dir):
    prepare(spark)
    mixed = mixing.mixture(_apart(docs, "doc_id", "source", "text"), target_entropy=TARGET_ENTROPY,
                           max_repeat=MAX_REPEAT, budget="cover")
    return _back(mixed, docs)


def pieces_stage(spark, docs, sf_dir):
    prepare(spark)
    keep = docs.select("doc_id", "lang", "source", "n_chars", "text")
    return sentencepieces.with_ids(keep, sentencepieces.read_model(), drop=("text",))


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-duplicates", near_duplicate_stage),
    ("pii pseudonyms", pii_stage),
    ("temperature mixing", mixing_stage),
    ("sentencepiece ids", pieces_stage),
]


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
