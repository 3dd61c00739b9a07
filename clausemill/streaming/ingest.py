"""Resume as a stream: new exhibit files are extracted once, and a restart goes on where it stopped.

Extraction has no shuffle and no window, so it runs on a streaming DataFrame as it is. The stream's
checkpoint plays the part of the resume manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.operators.extract import extract
from clausemill.sources.exhibits import with_path_keys

# Exhibits arrive in any order and may keep old times, so no file may be too old to be read.
ANY_AGE = "36500d"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_exhibits(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """S1 as a stream of new files."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .load(f"{folder.rstrip('/')}/*/*/*.htm")
        .select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("raw"))
    )
    return with_path_keys(files).select("cik", "accession", "filename", "raw")


def append_clauses(documents: DataFrame, out: str, checkpoint: str, taxonomy: Taxonomy = CONTRACTS) -> StreamingQuery:
    """Extract what is new and append it; ends when all files present at the start are done."""
    return (
        extract(documents, taxonomy)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
