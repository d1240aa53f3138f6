"""Token counts with a prefix table: the exact token count at every prefix that ends on a token boundary.

Each text is encoded once, by the tokenizer library of its file (`tokenizers` for .json, `sentencepiece` for .model), without
begin, end or added special tokens, without truncation or padding; special strings inside a text are treated as the library
does by default. Besides the count, a document keeps `ends`: the UTF-8 byte offset where each token ends, in order, which is the
prefix table `count(prefix of ends[j] bytes) = j + 1`. Truncation and budget questions are answered from it with column
expressions alone, with no second encoding: `cut_bytes(ends, budget)` is the byte length of the longest prefix of at most `budget`
tokens, `fits(n_tokens, budget)` whether the whole text fits.

Cases: a null text counts as empty (0 bytes, 0 tokens, empty table); an empty text likewise; very long texts are encoded whole;
where one character is split over tokens, they share its end; bytes after the last end (blanks that a tokenizer drops) bring no token; rows are kept as they are, repeated and null ids included; other columns pass through, except that columns named like the
output (`n_bytes`, `n_tokens`, `ends`) are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTPUT = ["n_bytes", "n_tokens", "ends"]
SLICE = 256  # rows encoded and sent back together, so that one Arrow batch of long texts stays small
_LOADED: dict[str, object] = {}


def _byte_lengths(model) -> np.ndarray | None:
    """UTF-8 bytes of every token id, where a token always covers the same bytes: byte-level BPE without a normaliser,
    whose vocabulary has one character for each byte (added tokens stand as they are written). None for other tokenizers."""
    config = json.loads(model.to_str())
    if config.get("normalizer") is not None or (config.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        return None
    vocab = model.get_vocab(with_added_tokens=True)
    added = {t["content"] for t in config.get("added_tokens", [])}
    lengths = np.zeros(max(vocab.values(), default=-1) + 1, dtype=np.int64)
    for token, i in vocab.items():
        lengths[i] = len(token.encode("utf-8")) if token in added else len(token)
    return lengths


def _char_to_byte(text: str, stops: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets: a running sum of UTF-8 lengths."""
    if text.isascii():
        return stops
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(widths)])[stops]


def _encoder(path: str):
    """One tokenizer per Python worker and file: a callable from texts to the byte offsets where their tokens end."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)

            def ends(texts: list[str]) -> list[np.ndarray]:
                # a piece ends where its surface ends, in bytes of the text
                return [
                    np.array([p.end for p in model.encode(text, return_type="proto").pieces], dtype=np.int64)
                    for text in texts
                ]

        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            lengths = _byte_lengths(model)

            def ends(texts: list[str]) -> list[np.ndarray]:
                if lengths is not None:
                    # ids alone give the ends, so the encoder need not track offsets; a slice of texts at a time
                    encoded = model.encode_batch_fast(texts, add_special_tokens=False)
                    return [np.cumsum(lengths[np.asarray(e.ids, dtype=np.int64)]) for e in encoded]
                out = []
                for text in texts:
                    # one text at a time: only its offsets outlive the encoding
                    offsets = model.encode(text, add_special_tokens=False).offsets
                    stops = np.fromiter((end for _, end in offsets), dtype=np.int64, count=len(offsets))
                    out.append(_char_to_byte(text, stops))
                return out

        _LOADED[path] = ends
    return _LOADED[path]


def token_prefixes(
    docs: DataFrame, tokenizer_path: str, text: str = "text", columns: list[str] | None = None
) -> DataFrame:
    """The rows of `docs` with n_bytes, n_tokens and the prefix table `ends` of their text (see the module).

    `columns` names the columns carried along (all by default); naming fewer spares sending them through Python.
    """
    keep = [c for c in (docs.columns if columns is None else columns) if c not in OUTPUT]
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("_text"))
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    schema = T.StructType(
        fields + [T.StructField("n_tokens", T.LongType()), T.StructField("ends", T.ArrayType(T.IntegerType()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task: Spark runs the tasks side by side
        ends_of = _encoder(tokenizer_path)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                ends = ends_of(batch.column("_text").to_pylist())
                counts = np.array([len(e) for e in ends], dtype=np.int64)
                offsets = np.zeros(len(ends) + 1, dtype=np.int32)
                offsets[1:] = np.cumsum(counts)
                flat = np.concatenate(ends).astype(np.int32) if ends else np.zeros(0, dtype=np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))
                carried = [batch.column(f.name) for f in fields]
                names = [f.name for f in fields] + ["n_tokens", "ends"]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(counts), listed], names=names)

    encoded = rows.mapInArrow(encode, schema)
    return encoded.select(*keep, "n_bytes", "n_tokens", "ends")


def cut_bytes(ends: Column, budget: int | Column) -> Column:
    """UTF-8 bytes of the longest prefix of at most `budget` tokens (0 for a budget below 1), from the prefix table alone."""
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    whole = F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0))
    return (
        F.when(budget < 1, F.lit(0))
        .when(budget >= F.size(ends), whole)
        .otherwise(F.element_at(ends, budget.cast("int")))
        .cast("long")
    )


def fits(n_tokens: Column, budget: int) -> Column:
    """Whether a text of n_tokens fits a budget of tokens."""
    return n_tokens <= F.lit(budget)
