"""A worker that decodes holds the tokens only, and a batch is decoded in parts of bounded size."""

import public_tokenizers
import pyarrow as pa
import pytest

from recordbridge.llm import bpe, texts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_decoder_is_the_codec_backwards():
    tool, codec = bpe.decoder(PATH), bpe.codec(PATH, PATTERN)
    assert not hasattr(tool, "ranks") and not hasattr(tool, "pattern")
    for text in ("", "a", "Zwölf Boxkämpfer, 日本 \U0001f600\n\t!! " * 9000):
        ids = codec.encode(text)
        assert tool.decode(ids) == text.encode() == codec.decode(ids)
    for wrong in ([-1], [1 << 30]):
        with pytest.raises(KeyError):
            tool.decode(wrong)


def test_batches_are_decoded_in_parts():
    n = texts.SLICE_BYTES // 4
    batch = pa.record_batch({"ids": pa.array([[1] * (n // 2), None, [2] * (n // 2), [3], [4] * (2 * n), []], pa.list_(pa.int32()))})
    parts = list(bpe._parts(batch, "ids"))
    assert [p.num_rows for p in parts] == [3, 1, 1, 1]
    assert pa.Table.from_batches(parts).combine_chunks().to_batches()[0].equals(batch)
    assert not list(bpe._parts(batch.slice(0, 0), "ids"))
