"""Token-ID output (operator 3): one wavelet matrix file per shard.

Documents are range-partitioned by doc_id and sorted, so tasks hold
ascending runs; each task encodes its texts and closes a shard whenever
``shard_tokens`` ids are full (a document is never cut, so a shard holds at
most that many ids and one document).  A shard's ids become a wavelet
matrix: one bit-plane per bit of the vocabulary, most significant first, each
with the count of its zeros and a directory of ones per 512 bits.  That
structure answers token access, counting and occurrence lookup by rank and
select without decoding the shard.  Spark's parquet writer puts every shard
into a compressed file of its own (``maxRecordsPerFile`` = 1) with its commit
protocol, so lost executors and repeated attempts leave no half-written
shard, and every store that Spark reaches works.

A shard row is (part, shard, n_tokens, doc_ids, lengths, matrix).  Ascending
(part, shard) is ascending doc_id.  ``matrix`` is, little-endian: ``WMX1``,
uint64 n, uint32 bits, then per plane uint64 zeros, uint32 directory and
uint64 words.

Defined cases: null and empty texts are the end id alone; null doc_ids come
first; equal doc_ids follow in the order of a hash of their texts; an empty
table writes no shard and reads back as no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import documents, scratch_path, texts
from tastemesh.llm.vocab import WordEncoder, once_per_worker, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 1
BITS = 16                     # word_bpe_49k ids are below 2^16
SHARD_TOKENS = 1 << 20
BATCH_TEXTS = 2048            # texts encoded together
_BLOCK = 512                  # bits per directory entry


class WaveletMatrix:
    """Rank/select structure over an array of ids below ``2 ** bits``."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.planes, self.bits = n, planes, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, cur = [], ids
        n_words = -(-len(ids) // _BLOCK) * (_BLOCK // 64)
        for level in range(bits - 1, -1, -1):
            one = (cur & cur.dtype.type(1 << level)) != 0
            packed = np.zeros(n_words * 8, np.uint8)
            bytes_ = np.packbits(one, bitorder="little")
            packed[:len(bytes_)] = bytes_
            words = packed.view("<u8")
            ones = np.bitwise_count(words).reshape(-1, _BLOCK // 64).sum(axis=1)
            directory = (np.cumsum(ones) - ones).astype("<u4")
            planes.append((int(len(cur) - one.sum()), directory, words))
            cur = np.concatenate([cur[~one], cur[one]])
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        out = [b"WMX1", struct.pack("<QI", self.n, self.bits)]
        for zeros, directory, words in self.planes:
            out += [struct.pack("<Q", zeros), directory.tobytes(), words.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != b"WMX1":
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", data, 4)
        at, blocks, planes = 16, -(-n // _BLOCK), []
        for _ in range(bits):
            zeros, = struct.unpack_from("<Q", data, at)
            directory = np.frombuffer(data, "<u4", blocks, at + 8)
            words = np.frombuffer(data, "<u8", blocks * (_BLOCK // 64), at + 8 + 4 * blocks)
            at += 8 + 4 * blocks + 8 * len(words)
            planes.append((zeros, directory, words))
        return cls(n, planes)

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits of a plane: the directory entry, then
        the popcounts of at most eight words."""
        zeros, directory, words = self.planes[level]
        i = np.asarray(i, np.int64)
        if self.n == 0:
            return np.zeros_like(i)
        block = np.minimum(i // _BLOCK, len(directory) - 1)
        inside = i - block * _BLOCK
        w = words.reshape(-1, _BLOCK // 64)[block]
        take = np.clip(inside[..., None] - 64 * np.arange(_BLOCK // 64), 0, 64)
        # the low `take` bits of every word; a shift by 64 is undefined, so two shifts
        half = (take // 2).astype(np.uint64)
        low = ~((~np.uint64(0) << half) << (take.astype(np.uint64) - half))
        return directory[block].astype(np.int64) + np.bitwise_count(w & low).sum(
            axis=-1, dtype=np.int64)

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        words = self.planes[level][2]
        return (words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def access(self, positions) -> np.ndarray:
        """The ids at ``positions``."""
        i = np.asarray(positions, np.int64).copy()
        out = np.zeros(len(i), np.int64)
        for level in range(self.bits):
            one = self._bit(level, i)
            r = self._rank1(level, i)
            out = out * 2 + one
            i = np.where(one, self.planes[level][0] + r, i - r)
        return out

    def _interval(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the ``token``s of positions lo..hi-1 end up below the last plane."""
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            r = self._rank1(level, np.array([lo, hi]))
            if (token >> (self.bits - 1 - level)) & 1:
                lo, hi = (self.planes[level][0] + r).tolist()
            else:
                lo, hi = lo - int(r[0]), hi - int(r[1])
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` at positions lo..hi-1."""
        a, b = self._interval(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) ``bit``: a binary search on rank."""
        lo, hi = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            r = self._rank1(level, mid + 1)
            below = (r if bit else mid + 1 - r) <= k
            lo, hi = np.where(below & (lo < hi), mid + 1, lo), np.where(below, hi, mid)
        return lo

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of ``token``, ascending: select, plane by plane upwards."""
        a, b = self._interval(token, 0, self.n)
        at = np.arange(a, b)
        for level in range(self.bits - 1, -1, -1):
            if (token >> (self.bits - 1 - level)) & 1:
                at = self._select(level, 1, at - self.planes[level][0])
            else:
                at = self._select(level, 0, at)
        return np.sort(at)

    def decode(self) -> np.ndarray:
        """All ids: the stable splits undone from the last plane upwards."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for level, (zeros, _, words) in reversed(list(enumerate(self.planes))):
            one = np.unpackbits(words.view(np.uint8), count=self.n,
                                bitorder="little").astype(bool)
            up = np.empty(self.n, kind)
            up[~one] = cur[:zeros]
            up[one] = cur[zeros:] | kind(1 << (self.bits - 1 - level))
            cur = up
        return cur.astype(np.uint32)


def shard_rows(docs: DataFrame, vocab_path: str, end_id: int = END_ID, bits: int = BITS,
               shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(part, shard, n_tokens, doc_ids, lengths, matrix), in ascending doc_id."""
    docs = texts(docs).withColumn("tie", F.xxhash64("text"))
    ranged = (docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
              .select("doc_id", "text", F.spark_partition_id().alias("part")))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("matrix", T.BinaryType())])

    def build(batches):
        encoder = once_per_worker("words", vocab_path, lambda: WordEncoder(vocab_path))
        shard, n, ids, lengths, doc_ids, part, kind = 0, 0, [], [], [], 0, None

        def close():
            every = np.concatenate(ids)
            if int(every.max()) >> bits:
                raise ValueError(f"id {every.max()} does not fit in {bits} bits")
            matrix = WaveletMatrix.build(every.astype(np.uint16 if bits <= 16 else np.uint32), bits)
            lens = np.concatenate(lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([n], pa.int64()), pa.array([doc_ids], pa.list_(kind)),
                 pa.array([lens], pa.list_(pa.int64())),
                 pa.array([matrix.to_bytes()], pa.binary())], names=schema.names)

        for batch in batches:
            kind = batch.column("doc_id").type
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                b = batch.slice(lo, BATCH_TEXTS)
                part = b.column("part")[0].as_py()
                flat, size = encoder.encode(b.column("text"))
                ends = np.cumsum(size)
                size = size + 1
                flat = np.insert(flat, ends, np.uint32(end_id))  # behind each document
                ends = np.cumsum(size)
                keys, first, base = b.column("doc_id").to_pylist(), 0, 0
                while first < len(keys):
                    # as many documents as it takes to fill the shard
                    last = int(np.searchsorted(ends, base + shard_tokens - n)) + 1
                    last = min(max(last, first + 1), len(keys))
                    ids.append(flat[base:ends[last - 1]])
                    lengths.append(size[first:last])
                    doc_ids += keys[first:last]
                    n += int(ends[last - 1] - base)
                    first, base = last, int(ends[last - 1])
                    if n >= shard_tokens:
                        yield close()
                        shard, n, ids, lengths, doc_ids = shard + 1, 0, [], [], []
        if doc_ids:
            yield close()

    return ranged.mapInArrow(build, schema)


def write_shards(docs: DataFrame, path: str, vocab_path: str | None = None, **options) -> None:
    """Write the documents' shards under ``path``, one file per shard."""
    (shard_rows(docs, vocab_path or vocabulary_path("word_bpe_49k.json"), **options)
     .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path))


def read_shards(spark, path: str) -> DataFrame:
    """The shards under ``path``."""
    return spark.read.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): the ids in all shards before.

    Prefix sums run within parts (a task's shards) and then over one row per
    part, never over all shards in one task.
    """
    per_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    sizes = shards.select("part", "shard", "n_tokens").join(offsets, "part")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    return sizes.select("part", "shard", (F.col("part_start") + F.coalesce(
        F.sum("n_tokens").over(within), F.lit(0))).alias("shard_start"))


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) -- decoded from the matrices."""
    return _decode(shards, with_ids=True)


def document_digests(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) -- decoded from the matrices."""
    return _decode(shards, with_ids=False)


def _decode(shards: DataFrame, with_ids: bool) -> DataFrame:
    id_type = shards.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
              T.StructField("doc_id", id_type), T.StructField("inside", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def read(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                flat = WaveletMatrix.from_bytes(batch.column("matrix")[r].as_py()).decode()
                flat = flat.astype("<u4", copy=False)
                size = np.asarray(batch.column("lengths")[r].values)
                ends = np.cumsum(size)
                begin = ends - size
                n = len(size)
                cols = [pa.repeat(batch.column("part")[r], n),
                        pa.repeat(batch.column("shard")[r], n),
                        batch.column("doc_ids")[r].values, pa.array(begin, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array([zlib.crc32(flat[a:b]) for a, b in zip(begin, ends)],
                                 pa.int64())]
                if with_ids:
                    cols.append(pa.array([flat[a:b].astype(np.int32)
                                          for a, b in zip(begin, ends)], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    # a shard's start joins the decoded rows, so no matrix is ever shuffled
    decoded = (shards.select("part", "shard", "doc_ids", "lengths", "matrix")
               .mapInArrow(read, T.StructType(fields)))
    return (decoded.join(shard_starts(shards), ["part", "shard"])
            .select("doc_id", (F.col("shard_start") + F.col("inside")).alias("start"),
                    *[f.name for f in fields[4:]]))


def _over_matrices(shards: DataFrame, schema: str, look) -> DataFrame:
    def run(frames):
        for pdf in frames:
            for part, shard, data in zip(pdf["part"], pdf["shard"], pdf["matrix"]):
                found = look(WaveletMatrix.from_bytes(data))
                yield found.assign(part=part, shard=shard)
    return (shards.select("part", "shard", "matrix")
            .mapInPandas(run, f"{schema}, part int, shard int"))


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """(n): occurrences of ``token`` in all shards, by rank."""
    return (_over_matrices(shards, "n long", lambda m: pd.DataFrame({"n": [m.count(token)]}))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """(position): every place of ``token`` in the whole corpus, by select."""
    return (_over_matrices(shards, "inside long",
                           lambda m: pd.DataFrame({"inside": m.occurrences(token)}))
            .join(shard_starts(shards), ["part", "shard"])
            .select((F.col("shard_start") + F.col("inside")).alias("position")))


def tokens_at(shards: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token): the ids at the places that ``positions`` (position) lists, by
    rank; only shards with a wanted place are opened."""
    spans = shards.select("part", "shard", "n_tokens").join(shard_starts(shards),
                                                            ["part", "shard"])
    per_shard = (positions.distinct().join(
        spans, (F.col("position") >= F.col("shard_start"))
        & (F.col("position") < F.col("shard_start") + F.col("n_tokens")))
        .groupBy("part", "shard").agg(F.collect_list("position").alias("position"),
                                      F.first("shard_start").alias("shard_start")))

    def run(frames):
        for pdf in frames:
            for at, start, data in zip(pdf["position"], pdf["shard_start"], pdf["matrix"]):
                at = np.asarray(at, np.int64)
                yield pd.DataFrame({"position": at, "token": WaveletMatrix.from_bytes(data)
                                    .access(at - start)})
    return (per_shard.join(shards.select("part", "shard", "matrix"), ["part", "shard"])
            .select("position", "shard_start", "matrix")
            .mapInPandas(run, "position long, token long"))


def op3_wavelet_matrix_shards(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    write_shards(documents(spark, sf_dir), path)
    return document_digests(read_shards(spark, path))
