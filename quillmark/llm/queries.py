"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import collocations, html_extract, minhash, nn_descent, packing, piece_table, quality, rp_forest, secret_scan, simhash, token_align, toxicity, warc
from quillmark.llm.common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.encode_documents(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": warc.op2_warc,
    "op3_minhash": minhash.op3_minhash,
    "op4_fingerprints": simhash.op4_fingerprints,
    "op5_nn_descent": nn_descent.op5_nn_descent,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_secrets": secret_scan.op7_secrets,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": quality.op9_quality,
    "op10_html": html_extract.op10_html,
    "op11_alignment": token_align.op11_alignment,
    "op12_collocations": collocations.op12_collocations,
    "op13_neighbours": rp_forest.op13_neighbours,
}
ORACLES = {"op2_warc": warc.ORACLE, "op12_collocations": collocations.ORACLE}
