"""Encode and decode whole texts of a table (operator 3).

``encode_decode`` maps a table with a text column to its token ids and back; the
automaton is in ``curata.llm.bpe``.

Defined results: a null or empty text has no ids and decodes to the empty text; very
long texts are whole; repeated rows give repeated results; an empty table gives an empty
one.  Only the key and text columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curata.llm import bpe
from curata.llm.common import arrow_map


def encode_table(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row.  Map-only: no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder = bpe.encoder(vocabulary)
        for b in batches:
            for first, texts in bpe.text_slices(b.column(1)):
                ids, counts = encoder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), out], ["k", "ids"])

    out = arrow_map(docs.select(docs[key], docs[text]), run, f"k {kind}, ids array<int>")
    return out.withColumnRenamed("k", key)


def decode_table(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every row of ids; null ids decode to the empty text."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        labels = bpe.emitted(vocabulary)
        for b in batches:
            texts = [bpe.decode(x.values.to_numpy().tolist() if x.is_valid else [], labels)
                     for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["k", "text"])

    out = arrow_map(encoded.select(encoded[key], encoded[ids]), run, f"k {kind}, text string")
    return out.withColumnRenamed("k", key)


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass; only counts and digests leave the workers.

    Returns (key, n_tokens, ids_sha256, decoded_sha256): SHA-256 of the decimal ids
    joined by commas and of the decoded text in UTF-8.  Map-only."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder, labels = bpe.encoder(vocabulary), bpe.emitted(vocabulary)
        decimal = [str(i).encode() for i in range(len(labels))]
        for b in batches:
            for first, texts in bpe.text_slices(b.column(1)):
                ids, counts = encoder.encode(texts)
                edge = np.concatenate([[0], np.cumsum(counts)]).tolist()
                ids_hash, text_hash = [], []
                for lo, hi in zip(edge[:-1], edge[1:]):
                    own = ids[lo:hi].tolist()
                    ids_hash.append(hashlib.sha256(b",".join(map(decimal.__getitem__, own))).hexdigest())
                    text_hash.append(hashlib.sha256(bpe.decode(own, labels).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(counts.astype(np.int64)),
                     pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                    ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = arrow_map(docs.select(docs[key], docs[text]), run,
                    f"k {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", key)
