"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from changefeed.llm import (
    bin_slack,
    bit_planes,
    counterfactual,
    divergence,
    golay,
    ownership,
    patricia,
    pitman_yor,
    pivotal_mix,
    product_codes,
    source_audit,
    suffix_trees,
    url_graph,
)
from changefeed.llm.common import table
from changefeed.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the Python workers, once per application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(root.rglob("*")):
            if path.suffix in (".py", ".yaml"):
                archive.write(path, path.relative_to(root.parent))
    # Spark copies the archive to its executors; this folder is the driver's own.
    place = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    place.write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(str(place))
    _SHIPPED.add(spark.sparkContext.applicationId)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pivotal_mix.mix_ids(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.cleaned(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return divergence.judge(documents, with_text=False).drop("lang")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.near_groups(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return patricia.judged(documents, keep="max").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterfactual.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_slack.pack(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.token_files(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.scan(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes.codes(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _prepared(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(configure(spark))
        # Rows of packed arrays are large; a batch for Python is bounded by bytes, too.
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
        return run(spark, sf_dir)

    return prepared


QUERIES: dict[str, Query] = {
    name: _prepared(run)
    for name, run in {
        "op1_url_filter": op1,
        "op2_lm_score": op2,
        "op3_mix": op3,
        "op4_substring_dedup": op4,
        "op5_quality": op5,
        "op6_near_dedup": op6,
        "op7_exact_dedup": op7,
        "op8_toxicity": op8,
        "op9_pack": op9,
        "op10_token_files": op10,
        "op11_secrets": op11,
        "op12_source_audit": op12,
        "op13_vector_codes": op13,
        "pipeline": pipeline,
    }.items()
}
ORACLES: dict[str, str] = {
    "op7_exact_dedup": """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t""",
    "op11_secrets": ownership.oracle(),
    "op12_source_audit": source_audit.oracle(),
    "op13_vector_codes": product_codes.oracle(),
}
