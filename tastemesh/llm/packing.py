"""Best-fit packing (operator 1): vector best-fit of token pieces into sequences.

A piece demands three things of a sequence: its tokens, one document place
and its attention cost (tokens squared).  A sequence has a capacity for each.
Pieces are placed in falling length; among the open sequences that can take
a piece under every constraint, the one with the least weighted norm of what
would remain wins (``rule="norm"``), or the one whose remaining capacities
have the least weighted dot product with the demand (``rule="dot"``), i.e. the
tightest in the dimensions the piece uses.  If none can, a sequence opens.

Distribution: pieces are dealt by a hash into buckets of about
``BUCKET_DOCS`` documents and every bucket is packed on its own.  A bucket
leaves at most a few sequences partly empty, among thousands, so the loss
against one global packing stays far below one percent at every input size,
while each task holds one bucket of small rows (no texts, no ids).

Defined cases: a null or empty text is the end id alone (one piece of length
1); a null doc_id is carried as it is; repeated rows are packed once each; an
empty table packs into nothing; other columns of the input are not read.
"""

from __future__ import annotations

import math
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import count_rows, documents, texts
from tastemesh.llm.vocab import byte_encoder, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOKENS = 1024
END_ID = 2
BUCKET_DOCS = 8192
#: weights of (tokens, documents, attention cost), each a share of its capacity
WEIGHTS = (1.0, 0.01, 0.01)


def cut_points(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: one piece if it
    fits, else full pieces behind a first piece with what is left over."""
    if n <= max_tokens:
        return [(0, n)]
    first = n % max_tokens or max_tokens
    return [(0, first)] + [(s, max_tokens) for s in range(first, n, max_tokens)]


def pieces(docs: DataFrame, vocab_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt[, ids]) of every document.

    ``ids`` are the byte-level BPE ids of the whole text, then ``end_id``.
    ``salt`` numbers the rows of a task, so that even repeated rows can be
    dealt to different buckets.
    """
    docs = texts(docs)
    fields = [docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("salt", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches):
        encode = byte_encoder(vocab_path)
        seen = 0
        for batch in batches:
            row, piece, start, length, crc, ids_out = [], [], [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4", copy=False)
                for k, (s, n) in enumerate(cut_points(len(ids), max_tokens)):
                    row.append(r)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n]))
                    if keep_ids:
                        ids_out.append(ids[s:s + n].astype(np.int32))
            cols = [batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(range(seen, seen + len(row)), pa.int64())]
            if keep_ids:
                cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            seen += len(row)
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return docs.mapInArrow(cut, T.StructType(fields))


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray,
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each of ``lengths``, which fall.

    Vector best-fit over (tokens, documents, attention cost).  A piece longer
    than the token capacity, or costlier than the attention capacity, raises.
    """
    n = len(lengths)
    seq, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    demand = np.stack([lengths, np.ones(n, np.int64), lengths * lengths], axis=1)
    if n and (demand > capacity).any():
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    rest = np.empty((max(n, 1), 3), np.int64)      # of the open sequences, densely
    name = np.empty(max(n, 1), np.int64)           # their numbers
    scale = weights / capacity.astype(np.float64) ** 2
    opened = live = 0
    for i in range(n):
        d = demand[i]
        left = rest[:live] - d
        fits = np.flatnonzero((left >= 0).all(axis=1))
        if len(fits):
            if rule == "norm":
                score = (left[fits].astype(np.float64) ** 2) @ scale
            else:
                score = (rest[fits] * d).astype(np.float64) @ scale
            best = fits[np.argmin(score)]
        else:
            best, live = live, live + 1
            rest[best], name[best] = capacity, opened
            opened += 1
        seq[i], offset[i] = name[best], capacity[0] - rest[best, 0]
        rest[best] -= d
        if not rest[best].all():                    # full in one dimension: closed
            live -= 1
            rest[best], name[best] = rest[live], name[live]
    return seq, offset


def pack(cut: DataFrame, n_docs: int, max_tokens: int = MAX_TOKENS, max_docs: int | None = None,
         max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS,
         rule: str = "norm", bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``cut`` (of :func:`pieces`) with sequence_id and offset.

    ``max_docs`` and ``max_cost`` bound the documents and the attention cost of
    a sequence; left out they cannot bind (a sequence of ``max_tokens`` tokens
    has at most as many documents, and a cost of at most their square).
    """
    n_buckets = max(1, math.ceil(n_docs / bucket_docs))
    capacity = np.array([max_tokens, max_docs or max_tokens, max_cost or max_tokens ** 2])
    w = np.array(weights)
    fields = [f for f in cut.schema.fields if f.name != "salt"]
    schema = T.StructType(fields + [T.StructField("sequence_id", T.LongType()),
                                    T.StructField("offset", T.LongType())])

    def pack_bucket(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", "salt"], ascending=[False, True, True],
                              kind="stable")
        seq, offset = best_fit(pdf["length"].to_numpy(), capacity, w, rule)
        return (pdf.drop(columns=["salt", "_bucket"])
                .assign(sequence_id=(int(key[0]) << 32) + seq, offset=offset))

    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(n_buckets))
    return (cut.withColumn("_bucket", bucket).groupBy("_bucket")
            .applyInPandas(pack_bucket, schema))


def pack_documents(docs: DataFrame, vocab_path: str | None = None, max_tokens: int = MAX_TOKENS,
                   end_id: int = END_ID, keep_ids: bool = False, **options) -> DataFrame:
    """Documents to placed pieces: (doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset).  ``keep_ids`` carries the ids for :func:`sequences`."""
    cut = pieces(docs, vocab_path or vocabulary_path("byte_bpe_50k.json"), max_tokens, end_id,
                 keep_ids)
    return pack(cut, count_rows(docs), max_tokens, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the training sequences of a packing that kept
    its ids.  A group is one sequence, so it holds at most ``max_tokens`` ids."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(placed.alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))


def op1_vector_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
