"""What a worker of the byte-level BPE holds follows the text it works on at a time."""

import tracemalloc

import numpy as np
import public_tokenizers

from tidewater.llm import bpe


def test_decoding_makes_no_number_per_byte():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    replay, ids, counts = bpe.encode_batch(["the quick brown fox jumps over it\n" * 2, "", "naïve 漢字"], path, public_tokenizers.PATTERN)
    assert bytes(replay.decode(ids)).decode() == "the quick brown fox jumps over it\n" * 2 + "naïve 漢字"
    assert len(counts) == 3 and not len(replay.decode(ids[:0]))
    many = np.tile(ids, 20_000)
    tracemalloc.start()
    decoded = replay.decode(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(decoded) > 1_000_000 and peak < 4 * len(decoded)
