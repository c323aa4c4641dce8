"""The corpus pipeline: documents through five operators of snapforge.llm, each stage written and read again by the next.

toxicity           drops what the class models, learnt from labels, call toxic
near_duplicates    keeps one document, the least doc_id, of each group of near-equal SimHash fingerprints
decontamination    drops documents that hold a benchmark window
secrets            replaces secrets by a mark, and counts n_chars anew
bpe                gives token ids and the decoded text of what is left

All but the last return the columns of documents. Rows with a null doc_id pass the second stage; null texts count as empty.
"""

from __future__ import annotations

from snapforge.llm import bpe, common, decontaminate, secrets_scan, simhash, toxicity


def toxicity_stage(spark, docs, sf_dir):
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_stage(spark, docs, sf_dir):
    return simhash.keep_one(docs)


def decontamination_stage(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark, docs, sf_dir):
    return secrets_scan.redact_documents(docs)


def bpe_stage(spark, docs, sf_dir):
    import public_tokenizers

    return bpe.encode_table(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]
#: The first two and the last stage can't be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; a stage's table goes once the next one's is written."""
    docs, before = common.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
        if before is not None:
            common.unstage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
