"""Encoding of the whole corpus with a public tokenizer."""

from __future__ import annotations

import base64
import heapq
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .pretokens import piece_starts

#: Bytes of text worked on at once, and pieces remembered by a worker.
CHUNK, REMEMBERED = 8_000_000, 1_000_000
BYTE_BPE = ("byte_bpe_50k", "byte_bpe_multi_50k")


def tokenizer_dir() -> str:
    """Folder of the public vocabularies: that of the installed module, else /opt/tokenizers."""
    found = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(found.origin) if found and found.origin else "/opt/tokenizers"


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the adjacent pair of lowest rank is joined, leftmost first, until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, back, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has been joined otherwise since
        alive[j] = False
        end[i] = stop
        after[i] = k = after[j]
        if k < n:
            back[k] = i
            if (r := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(queue, (r, i, end[k]))
        if (h := back[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
            heapq.heappush(queue, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class ByteBPE:
    """A byte-level vocabulary with the merged ids of pieces already met."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def ids(self, piece: bytes) -> tuple[int, ...]:
        got = self.known.get(piece)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = tuple(merge(piece, self.ranks))
            if len(piece) <= 64:
                self.known[piece] = got
        return got

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, index of the first id of each text and the end, piece ends as byte lengths per id)."""
        starts = piece_starts(data, offsets[:-1][np.diff(offsets) > 0])
        bounds = np.r_[starts, len(data)].astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        merged = [self.ids(p) for p in pieces.dictionary.to_pylist()]
        size = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter((i for m in merged for i in m), np.int32, int(size.sum()))
        first = np.r_[0, np.cumsum(size)]
        which = pieces.indices.to_numpy(zero_copy_only=False)
        count = size[which]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(first[which] - (ends - count), count) + np.arange(total)]
        upto = np.r_[0, ends]
        return ids, upto[np.searchsorted(starts, offsets)], starts

    @property
    def lengths(self) -> np.ndarray:
        """Bytes of every id."""
        out = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for piece, i in self.ranks.items():
            out[i] = len(piece)
        return out


@lru_cache(4)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def _text_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive texts, about CHUNK bytes at a time; a null text has no bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, side="right")) - 1)
        yield body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", vocabularies: str | None = None, with_offsets: bool = False) -> DataFrame:
    """(key, ids array<int>[, offsets array<int>]): the token ids of every text, without special tokens.

    A null, empty or zero-byte text has the empty list; strings of special tokens in a text are ordinary
    text; blank texts are encoded like any other. One row per input row, repeated rows included; other
    columns are dropped, so their names don't matter. ``offsets`` are the byte offsets, in the text's
    UTF-8, at which the tokens begin: what is needed to decode any span.

    ``tokenizer`` is a file of ``vocabularies`` (default: the installed folder). The byte-level ones run on
    Arrow buffers: piece boundaries by class arrays, equal pieces found by hashing slices of the buffer,
    each distinct piece merged once and remembered. ``word_bpe_49k`` and ``piece_bpe_32k`` go through their
    own libraries, in batches. No shuffle: one pass over (key, text).
    """
    folder = vocabularies or tokenizer_dir()
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if with_offsets:
        if tokenizer not in BYTE_BPE:
            raise ValueError("offsets are kept by the byte-level tokenizers only")
        schema = schema.add("offsets", T.ArrayType(T.IntegerType()))

    def run(batches):
        encode = _encoder(folder, tokenizer)
        for batch in batches:
            ids, counts, offsets = [], [np.zeros(1, np.int64)], []
            for data, bounds in _text_chunks(batch.column(text)):
                got, upto = encode(data, bounds)
                ids.append(got)
                counts.append(upto[1:] + counts[-1][-1])
                if with_offsets:
                    length = load(f"{folder}/{tokenizer}.tiktoken").lengths[got]
                    begin = np.cumsum(length) - length
                    offsets.append(begin - np.repeat(bounds[:-1], np.diff(upto)))
            upto = pa.array(np.concatenate(counts).astype(np.int32))
            columns = [batch.column(key), pa.ListArray.from_arrays(upto, pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))]
            if with_offsets:
                columns.append(pa.ListArray.from_arrays(upto, pa.array(np.concatenate(offsets) if offsets else np.empty(0), pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", vocabularies: str | None = None) -> DataFrame:
    """(key, n_tokens bigint): as :func:`encode_corpus`, the lengths only."""
    folder = vocabularies or tokenizer_dir()

    def run(batches):
        encode = _encoder(folder, tokenizer)
        for batch in batches:
            sizes = [np.diff(encode(data, bounds)[1]) for data, bounds in _text_chunks(batch.column(text))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(np.concatenate(sizes) if sizes else np.empty(0), pa.int64())], [key, "n_tokens"])

    return df.select(key, text).mapInArrow(run, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType())]))


def _encoder(folder: str, tokenizer: str):
    """A function (bytes, offsets) -> (ids, index of each text's first id)."""
    if tokenizer in BYTE_BPE:
        bpe = load(f"{folder}/{tokenizer}.tiktoken")
        return lambda data, offsets: bpe.encode(data, offsets)[:2]
    many = _library(folder, tokenizer)

    def encode(data, offsets):
        body = data.tobytes()
        lists = many([body[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.int32, int(size.sum())), np.r_[0, np.cumsum(size)]

    return encode


@lru_cache(4)
def _library(folder: str, tokenizer: str):
    if os.path.exists(f"{folder}/{tokenizer}.model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{tokenizer}.model")
        return lambda texts: model.encode(texts, num_threads=1)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(f"{folder}/{tokenizer}.json")
    model.encode_special_tokens = True
    return lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def decode_corpus(df: DataFrame, ids: str = "ids", tokenizer: str = "byte_bpe_50k", vocabularies: str | None = None) -> DataFrame:
    """``df`` with a column ``decoded``: the text of a byte-level tokenizer's ids; null for null ids."""
    path = f"{vocabularies or tokenizer_dir()}/{tokenizer}.tiktoken"
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        piece = {i: p for p, i in load(path).ranks.items()}
        for batch in batches:
            texts = [None if x is None else b"".join(map(piece.__getitem__, x)).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)
