"""Words that a worker of op1 remembers."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidewater.llm import token_files
from tidewater.llm.common import BATCH_BYTES, BATCH_OPTION

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_known_words_are_bounded_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    monkeypatch.setattr(token_files, "_loaded", {})
    tokenizer, known = token_files._tokenizer(PATH)
    for i in range(40):
        texts = [f"always word{i}x{j} Other{j % 7}" for j in range(10)]
        ids, counts = token_files.encode_texts(pa.array(texts, pa.large_string()), PATH, 2)
        want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert ids.tolist() == [x for w in want for x in w]
        assert counts.tolist() == list(map(len, want))
        assert "always" in known[0] or "always" in known[1]
        assert max(map(len, known)) <= 50 + 20
    assert isinstance(ids, np.ndarray)


def test_batches_of_text_are_bounded(spark, tmp_path):
    before = spark.conf.get(BATCH_OPTION)
    spark.conf.unset(BATCH_OPTION)
    try:
        df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
        token_files.tokenised(df, PATH, 2)
        assert spark.conf.get(BATCH_OPTION).removesuffix("b") == str(BATCH_BYTES)
    finally:
        spark.conf.set(BATCH_OPTION, before)
