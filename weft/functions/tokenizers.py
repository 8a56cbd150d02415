"""Tokenizers as Column expressions: texts to arrays of ids (or words), and their vocabularies.

``Words`` splits at white space and stays in the JVM; ``FileTokenizer`` reads a public tokenizer's file in each
worker (SentencePiece .model, tokenizers .json, tiktoken ranks) and works on Arrow batches. Nothing is trained.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import text as X

#: Characters of text that are encoded at once (or one text): what a library holds of each token is a hundred bytes and more.
TEXTS = 1 << 18


class Words:
    """White-space words; the end of a text is ``</s>``."""

    end = "</s>"

    def tokens(self, text: Column) -> Column:
        return X.blank_words(F.coalesce(text, F.lit("")))


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str | None):
    """A function from a list of texts to lists of ids, and the vocabulary {token: id}."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return model.encode, {model.id_to_piece(i): i for i in range(model.get_piece_size())}
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        batch = getattr(model, "encode_batch_fast", model.encode_batch)  # without offsets
        return lambda texts: [e.ids for e in batch(texts, add_special_tokens=False)], model.get_vocab()
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("file", pat_str=pattern or r"\s*\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    return model.encode_ordinary_batch, {k.decode("latin-1"): v for k, v in ranks.items()}


def _encoded(encode, texts: list[str | None]) -> pa.Array:
    """Lists of ids, from some texts at a time."""
    ids, sizes, row = [np.zeros(0, np.int32)], [0], 0
    while row < len(texts):
        held, size = [], 0
        while row < len(texts) and (not held or size + len(texts[row] or "") <= TEXTS):
            held.append(texts[row] or "")
            size += len(held[-1])
            row += 1
        got = encode(held)
        ids += [np.array(x, np.int32) for x in got]
        sizes += map(len, got)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(ids)))


class FileTokenizer:
    """A tokenizer file; ``end`` is the id that closes a text (None: nothing does)."""

    def __init__(self, path: str, end: int | None = None, pattern: str | None = None):
        self.path, self.end, self.pattern = path, end, pattern

    def tokens(self, text: Column) -> Column:
        path, pattern = self.path, self.pattern

        @F.arrow_udf("array<int>")
        def run(s: pa.Array) -> pa.Array:
            return _encoded(_encoder(path, pattern)[0], s.to_pylist())

        return run(text)

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """(token, id) of the file, which bounds its rows."""
        return spark.createDataFrame(list(_encoder(self.path, self.pattern)[1].items()), "token string, id int")
