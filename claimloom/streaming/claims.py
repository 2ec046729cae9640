"""The first stages over a stream of review files: lines to sentences to citations, with no state; late files are just files.

The batch pipeline has no streams; this is an extension that reuses its stateless operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.operators import citations, textops


def stream_citations(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A streaming frame of review_path, sent_no, cit_no and citation fields from the text files of a folder."""
    texts = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    texts = texts.selectExpr("_metadata.file_path AS review_path", "value AS text")
    return citations.citations(textops.sentences(texts, ["review_path"], "text"), ["review_path", "sent_no"])
