"""A training corpus from raw documents: five stages, each written and read again.

Every stage works on all that its predecessor kept, and its decisions take effect: the
quality classifier drops what it rejects, near-dedup keeps one document of each group,
decontamination drops documents with a benchmark window, mixing repeats or drops
documents by the mix, and token output encodes the rest and returns the file's contents
by document. All stages but the last return the columns of documents. The token file is
the product: it stays, and `file` of each row names its folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessel.llm import decontaminate, mixing, quality, simhash, token_output
from tessel.llm.common import Shared, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality.stage),
    ("simhash_near_dedup", simhash.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("source_mixing", mixing.stage),
    ("token_output", token_output.stage),
]

#: Drawing, fingerprints and tokens are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, start, n_tokens, ids_crc32, and file (the token file's folder)."""
    shared = Shared(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        made = len(Shared.live)
        docs = shared.table(stage(spark, docs, sf_dir))
        # a written stage needs neither its own working tables nor its predecessor's result any more
        for used in Shared.live[made:]:
            used.clear()
        if before is not None:
            shared.drop(before)
        before = docs
    return docs
