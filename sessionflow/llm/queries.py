"""The registered queries of this subpackage: each applies one operator to its whole table.

ORACLES holds the SQL that must give the same rows, where SQL can express a query on whole tables.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm.align import align
from sessionflow.llm.ann import nearest
from sessionflow.llm.bpe import encode_decode
from sessionflow.llm.frames import table
from sessionflow.llm.language import identify
from sessionflow.llm.line_dedup import dedup_lines
from sessionflow.llm.ngram_join import near_duplicates
from sessionflow.llm.packing import pack_documents
from sessionflow.llm.periodic import collapse_runs
from sessionflow.llm.sharding import shuffle_into_shards
from sessionflow.llm.suffix_dedup import dedup_passages
from sessionflow.llm.token_files import read_token_files, write_token_files
from sessionflow.llm.topk import exact_top_k
from sessionflow.llm.warc import read_pages, write_pages

#: Where the public vocabularies lie; also on every executor.
TOKENIZERS = "/opt/tokenizers"


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per Spark application, so that tasks can import it anywhere."""
    context = spark.sparkContext
    if getattr(context, "_sessionflow_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "sessionflow.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._sessionflow_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, write_pages(table(spark, sf_dir, "pages")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    return encode_decode(documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"), PATTERN, digests=True)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(*write_token_files(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(documents(spark, sf_dir)).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir))
    return found.select("row.doc_id", "n_lines", "n_removed", F.col("sha256").alias("kept_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=1)


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), those of every tenth checksum of doc_id with their words repeating from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(words):
        n, g = F.size(words).cast("bigint"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: words[(a + (i - a) % p).cast("int")])
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")).otherwise("")

    changed = F.element_at(F.transform(F.array(words), repeated), 1)
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_periods(documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = found.select("row", "runs", "text", longest.alias("longest"))
    return best.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(F.col("longest.length") * 1000 / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(documents(spark, sf_dir).select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shuffle_into_shards(documents(spark, sf_dir).select("doc_id", "text"), shards=24)
    text = F.coalesce("row.text", F.lit(""))
    return found.select(
        "row.doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (op1_warc, op2_ngram_join, op3_bpe, op4_token_files, op5_suffix_dedup, op6_line_dedup, op7_language, op8_top_k, op9_packing, op10_ann, op11_periodic_runs, op12_alignment, op13_sharding)
}

ORACLES = {
    "op8_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(list_inner_product(q.c, r.c) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
