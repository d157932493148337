"""Special tokens written out in texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywood.llm import wavelet_shards

TEXTS = [
    "<|endoftext|>", "a<|endoftext|>b c", "one <|endoftext|> two", "one  <|endoftext|>  two", "x\n<|endoftext|>\n y",
    " <|endoftext|><|endoftext|> ", "<|endoftext|", "plain words",
]


@pytest.mark.parametrize("split", [False, True])
def test_special_tokens_as_the_library(spark, tmp_path, split):
    name = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(name)
    tokenizer.encode_special_tokens = split
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    wavelet_shards.write_shards(docs, str(tmp_path / "s"), name, 2, **({"split_special": True} if split else {}))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in wavelet_shards.documents(spark, str(tmp_path / "s")).collect()}
    for i, text in enumerate(TEXTS):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
