"""Batches of text are bounded by their bytes and not only by their number of rows."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bpe, quality, simhash
from tidewater.llm.common import BATCH_BYTES, BATCH_OPTION

MODEL = quality.QualityModel(b"", b"", (0.0,) * 15, (1.0,) * 15, (0.0,) * 16)


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: bpe.encode_decode(df, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
        lambda df: quality.good_documents(df, MODEL),
        lambda df: simhash.fingerprints(df),
    ],
)
def test_a_batch_of_long_texts_is_small(spark, operator):
    """3,000 texts of 4 kB in one partition are fewer than the rows of a batch; a session's own value stays."""
    texts = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcd"), 1000).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    before = spark.conf.get(BATCH_OPTION)
    try:
        spark.conf.unset(BATCH_OPTION)
        operator(texts)
        assert texts.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0] < 1.25 * BATCH_BYTES
        spark.conf.set(BATCH_OPTION, "8m")
        operator(texts)
        assert spark.conf.get(BATCH_OPTION) in ("8m", f"{8 << 20}b")
    finally:
        spark.conf.set(BATCH_OPTION, before)
