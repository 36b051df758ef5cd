"""MinHash near-dedup (operator 10): BagMinHash over multisets of word shingles.

A text is a bag: each shingle of five words with its number of occurrences (a
text of one to four words is one shingle).  Two texts are near-duplicates when
their weighted Jaccard similarity, sum of minima over sum of maxima, is at
least 0.8.

*Signatures.*  Weights are discretised at the integers and grouped into the
dyadic blocks (0,1], (1,2], (2,4], (4,8], ...  Every (shingle, block) runs a
Poisson process at the rate of its width, seeded by the shingle's hash; a point
has a time, one of ``SLOTS`` slots and a level within its block, which counts
only if the weight reaches it (splitting a block at the weight thins its
process).  A slot's value is its earliest point, so two texts agree in a slot
with a probability equal to their weighted Jaccard similarity.  A process stops
when its time passes the latest slot value of its text, which after the first
few points is nearly at once.

*Bands.*  128 slots make 32 bands of 4; a pair of similarity 0.8 shares no band
with a probability of 5e-8.

*Verification.*  Texts are first collapsed to distinct texts.  Within a band
every member is paired with the band's least member -- as many pairs as members,
never all pairs -- and pairs are verified on their whole bags.  Then bands that
still hold several classes are looked at again, as long as that finds a link:
members of a band, in chunks ordered by their next band, compare signatures,
and each class, however many members it has there, offers its best-looking pair with
each of the two classes most like it (if the estimate is within five standard errors
of the threshold).  One verified pair joins two classes, so more would be wasted.
When a round finds no link, what is left is tested whole: every pair of a band
whose classes differ and whose estimate is within the margin, across all blocks of
the band.  There the bags travel with the members, a pair is verified in the task that
meets it, and only links leave the task.  So the rounds only save work,
and the classes are those of all pairs that share a band and reach the margin.
Pairs are dealt by their centre, big centres in several salts, and read as a
stream that holds one centre's bag.

*Classes* are the connected components of the verified links, by min-label
propagation with pointer jumping over tables in the shared folder.

Defined cases: null texts are empty; equal texts, empty ones too, are one
class; texts without words have no other link; a null doc_id belongs to its
text's class, whose class_id is the least doc_id it has; repeated rows get a row
each; an empty table gives no rows; other columns are not read by
:func:`near_duplicates`; :func:`drop_near_duplicates` returns exactly the
input's columns.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import documents, texts, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
THRESHOLD = 0.8
SLOTS = 128
BAND_ROWS = 4
BATCH_TEXTS = 512
SALT_MEMBERS = 2048           # members of one centre that are verified in one stream
CHUNK = 512                   # members of one band that compare signatures
OFFERS = 2
BLOCK = 4096                  # members of one band that a task of the last pass compares
BLOCK_BYTES = 1 << 25         # bytes of bags of such a block, where they come with the members
SEEN_PAIRS = 500_000          # offered pairs that a task remembers
MARGIN = 0.18                 # five standard errors of an estimate from 128 slots
SMALL_ROWS = 250_000          # rows of a small table that one task writes

_C1, _C2, _C3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bags(texts_: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, occurrences), sorted by text and hash."""
    import xxhash
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts_]
    n = np.fromiter(map(len, words), np.int64, len(words))
    index: dict[bytes, int] = {}
    at = np.fromiter((index.setdefault(w, len(index)) for ws in words for w in ws), np.int64,
                     int(n.sum()))
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))[at]
    doc = np.repeat(np.arange(len(words)), n)
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    short = np.minimum(n, shingle)
    starts = np.flatnonzero(place <= (n - short)[doc])   # a shingle begins here
    value = np.zeros(len(starts), np.uint64)
    length = short[doc[starts]]
    for k in range(shingle):
        more = length > k
        value[more] = mix(value[more] * np.uint64(_C1) + h[starts[more] + k] + np.uint64(k + 1))
    doc = doc[starts]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])]
                           [:len(doc)])
    return doc[first], value[first], np.diff(np.r_[first, len(doc)])


def _points(seed, block, time, k0, count, slots):
    """The next ``count`` points of processes: times, slots and raw bits, one row each."""
    k = k0[:, None] + np.arange(count, dtype=np.uint64)[None, :]
    x = mix(mix(seed ^ (block * np.uint64(_C3)))[:, None] + k * np.uint64(_C2))
    rate = np.where(block < 2, 1.0, np.exp2(block.astype(np.float64) - 1))
    step = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / rate[:, None]
    step[:, 0] += time                 # one sum from left to right: the same bits in any batch
    y = mix(x ^ np.uint64(_C1))
    return np.cumsum(step, axis=1), (y % np.uint64(slots)).astype(np.int64), y >> np.uint64(32)


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n_docs: int,
               slots: int = SLOTS) -> np.ndarray:
    """BagMinHash: an (n_docs, slots) array of earliest times; inf for empty bags."""
    out = np.full((n_docs, slots), np.inf)
    # block b > 0 covers the levels 2^(b-1)+1 .. 2^b: a weight w reaches into blocks 0..ceil(log2 w)
    n_blocks = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    block = (np.arange(int(n_blocks.sum())) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
    d, seed, w = (np.repeat(a, n_blocks) for a in (doc, value, weight))
    n_proc = np.bincount(d, minlength=n_docs)
    # texts with few processes need many points of each: such texts draw them together
    for low, high, count in ((1, 9, 128), (9, 65, 24), (65, 513, 4), (513, 1 << 62, 1)):
        mine = (n_proc[d] >= low) & (n_proc[d] < high)
        pd_, ps, pw, pb = d[mine], seed[mine], w[mine], block[mine].astype(np.uint64)
        t, k = np.zeros(len(pd_)), np.zeros(len(pd_), np.uint64)
        while len(pd_):
            times, slot, bits = _points(ps, pb, t, k, count, slots)
            low_level = np.where(pb > 0, 1 << np.maximum(pb.astype(np.int64) - 1, 0), 0)
            width = np.maximum(low_level, 1)
            level = low_level[:, None] + 1 + (bits.astype(np.int64) % width[:, None])
            ok = level <= pw[:, None]
            flat = (pd_[:, None] * slots + slot)[ok]
            np.minimum.at(out.reshape(-1), flat, times[ok])
            t, k = times[:, -1], k + np.uint64(count)
            live = t < out.max(axis=1)[pd_]
            pd_, ps, pw, pb, t, k = (a[live] for a in (pd_, ps, pw, pb, t, k))
    return out


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """(n_docs, bands) 64-bit keys of the bands of signatures."""
    n, slots = sig.shape
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(n, slots // rows, rows)
    key = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64) + np.uint64(1),
                          (n, slots // rows)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(_C1) + bits[:, :, r])
    return key.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of sorted hashes and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / max(int(a[1].sum()) + int(b[1].sum()) - least, 1)


def band_table(docs: DataFrame, shingle: int = SHINGLE, slots: int = SLOTS,
               rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, copy, bands, sig): ``copy`` is the md5 of the text, ``bands`` its keys,
    ``sig`` two bytes of every slot."""
    docs = texts(docs).withColumn("copy", F.md5("text"))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("copy", T.StringType()),
                           T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("sig", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                b = batch.slice(lo, BATCH_TEXTS)
                doc, value, weight = bags(b.column("text").to_pylist(), shingle)
                sig = signatures(doc, value, weight, b.num_rows, slots)
                keys = band_keys(sig, rows)
                has = np.isfinite(sig[:, 0])
                size = np.where(has, keys.shape[1], 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(size)], pa.int32()),
                    pa.array(keys[has].reshape(-1), pa.int64()))
                short = (mix(sig.view(np.uint64)) >> np.uint64(48)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("copy"), lists,
                     pa.array([r.tobytes() for r in short], pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float = THRESHOLD,
           shingle: int = SHINGLE) -> DataFrame:
    """``pairs`` (node, centre) and whether their bags are similar: (node, centre, similar).

    Every pair goes to its centre's stream; a centre of many members is
    repeated once per ``SALT_MEMBERS`` members, so no stream is long.
    """
    per_centre = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("m"))
    salts = F.ceil(F.col("m") / F.lit(SALT_MEMBERS)).cast("int")
    members = (pairs.join(per_centre, "centre").select(
        "centre", F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt"),
        "node", F.lit(1).alias("role")))
    centres = per_centre.select(
        "centre", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        F.col("centre").alias("node"), F.lit(0).alias("role"))
    wanted = (members.unionByName(centres).join(nodes.select("node", "first_id", "copy"), "node")
              .withColumn("key", row_key(F.col("first_id"), F.col("copy"))))
    text = texts(docs).select(row_key(F.col("doc_id"), F.md5("text")).alias("key"), "text")
    dealt = (wanted.join(text, "key").select("centre", "salt", "role", "node", "text")
             .repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role"))

    def run(batches):
        at, centre_bag = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                b = batch.slice(lo, BATCH_TEXTS)
                doc, value, weight = bags(b.column("text").to_pylist(), shingle)
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                node, centre, similar = [], [], []
                for r, (c, s, role, x) in enumerate(zip(*(b.column(k).to_pylist() for k in (
                        "centre", "salt", "role", "node")))):
                    bag = value[cut[r]:cut[r + 1]], weight[cut[r]:cut[r + 1]]
                    if role == 0:
                        at, centre_bag = (c, s), (bag[0].copy(), bag[1].copy())
                    elif at == (c, s):
                        node.append(x)
                        centre.append(c)
                        similar.append(overlap(centre_bag, bag) >= threshold)
                    else:
                        raise ValueError(f"no text of centre {c} came before its members")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(centre, pa.int64()),
                     pa.array(similar, pa.bool_())], names=["node", "centre", "similar"])

    return dealt.mapInArrow(run, "node long, centre long, similar boolean").distinct()


def row_key(doc_id, copy):
    """One string for a (doc_id, text hash), null doc_ids included."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(" "), copy)


def _small(df: DataFrame, name: str, rows: int) -> DataFrame:
    """A written table of about ``rows`` rows, in as many tasks as they need."""
    return written(df.coalesce(max(1, math.ceil(rows / SMALL_ROWS))), name)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component of ``edges`` (a, b)."""
    edges = written(edges.select("a", "b"), "edges")
    n = 2 * edges.count()
    both = _small(edges.union(edges.select("b", "a")).distinct(), "edges", n)
    label = _small(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels", n)
    while True:
        near = (both.join(label, both["b"] == label["node"]).groupBy("a")
                .agg(F.min("label").alias("near")))
        step = (label.join(near, label["node"] == near["a"])
                .select("node", F.col("label").alias("old"),
                        F.least("label", "near").alias("label")))
        jump = label.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        new = _small(step.join(jump, step["label"] == jump["at"], "left")
                     .select("node", "old", F.least("label", F.coalesce("beyond", "label"))
                             .alias("label")), "labels", n)
        if not new.filter("old <> label").head(1):
            return new.select("node", "label")
        label = new.select("node", "label")


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after further ``links`` (a, b) between labels; nodes that are their
    own class may be absent from ``label``."""
    over = components(links).select(F.col("node").alias("at"), F.col("label").alias("beyond"))
    moved = (label.join(over, label["label"] == over["at"], "left")
             .select("node", F.coalesce("beyond", "label").alias("label")))
    fresh = (over.join(label.select("node"), over["at"] == label["node"], "left_anti")
             .select(F.col("at").alias("node"), F.col("beyond").alias("label")))
    both = moved.union(fresh)
    return _small(both, "classes", label.count() + over.count())


def mixed_bands(member: DataFrame, label: DataFrame, most: int) -> DataFrame:
    """(band, chunks, following, node, label): members of bands of several classes, and in how
    many parts of about ``most`` members a band is read."""
    at = (member.join(label, "node", "left")
          .select("band", "following", "node", F.coalesce("label", "node").alias("label")))
    mixed = (at.groupBy("band").agg(F.min("label").alias("l0"), F.max("label").alias("l1"),
                                    F.count(F.lit(1)).alias("m")).filter("l0 < l1")
             .select("band", F.ceil(F.col("m") / F.lit(most)).cast("int").alias("chunks")))
    return at.join(mixed, "band")


def best_offers(member: DataFrame, nodes: DataFrame, label: DataFrame,
                threshold: float = THRESHOLD) -> DataFrame:
    """(node, centre): in bands of several classes, each class's pairs with the classes whose
    signatures look most like its own."""
    rows = (mixed_bands(member, label, CHUNK)
            .withColumn("chunk", F.pmod(F.col("following"), F.col("chunks")))
            .select("band", "chunk", "following", "node", "label")
            .join(nodes.select("node", "sig"), "node"))
    least = threshold - MARGIN

    def offers(node, label_, sig):
        """The best-looking pair of each class with each of the OFFERS classes most like it."""
        node, label_ = np.asarray(node, np.int64), np.asarray(label_, np.int64)
        order = np.argsort(label_, kind="stable")
        node, label_ = node[order], label_[order]
        sig = np.frombuffer(b"".join(sig), "<u2").reshape(len(node), -1)[order]
        starts = np.flatnonzero(np.r_[True, label_[1:] != label_[:-1]])
        n, c = len(node), len(starts)
        own = np.repeat(np.arange(c), np.diff(np.r_[starts, n]))
        # slots that agree, member and other member in one number, so that a maximum keeps all
        best = np.full((c, c), -1, np.int64)
        for i in range(n):
            look = (np.count_nonzero(sig == sig[i], axis=1) * n + i) * n + np.arange(n)
            np.maximum(best[own[i]], np.maximum.reduceat(look, starts), out=best[own[i]])
        np.fill_diagonal(best, -1)
        top = np.sort(best, axis=1)[:, -OFFERS:].ravel()
        top = top[top >= math.ceil(least * sig.shape[1]) * n * n]
        x, y = node[top // n % n], node[top % n]
        return set(zip(np.maximum(x, y).tolist(), np.minimum(x, y).tolist()))

    def batch_of(pairs):
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          names=["node", "centre"])

    def run(batches):
        # a pair that several bands offer leaves the task once, as far as memory goes
        key, node, label_, sig, seen = None, [], [], [], set()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("band", "chunk", "node", "label", "sig")]
            for band, chunk, n, own, s in zip(*cols):
                # a chunk that its band's key could not split goes on in pieces
                if (band, chunk) != key or len(node) == 4 * CHUNK:
                    if len(node) > 1:
                        new = offers(node, label_, sig) - seen
                        yield batch_of(new)
                        if len(seen) > SEEN_PAIRS:
                            seen = set()
                        seen |= new
                    key, node, label_, sig = (band, chunk), [], [], []
                node.append(n)
                label_.append(own)
                sig.append(s)
        if len(node) > 1:
            yield batch_of(offers(node, label_, sig) - seen)

    return (rows.repartition("band", "chunk").sortWithinPartitions("band", "chunk", "following",
                                                                   "node")
            .mapInArrow(run, "node long, centre long").distinct())


def _groups(batches):
    """The rows of one (band, one, two) at a time, as arrays."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.num_rows
        t = {k: batch.column(k).to_numpy() for k in ("band", "one", "two", "block", "node", "label")}
        t["sig"] = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(n, -1)
        t["bands"] = batch.column("bands").flatten().to_numpy().reshape(n, -1)
        if "bag" in batch.schema.names:
            t["bag"] = batch.column("bag").to_numpy(zero_copy_only=False)
        if held is not None:
            t = {k: np.concatenate([held[k], t[k]]) for k in t}
        new = np.flatnonzero(np.r_[True, (t["band"][1:] != t["band"][:-1])
                                   | (t["one"][1:] != t["one"][:-1])
                                   | (t["two"][1:] != t["two"][:-1])])
        for lo, hi in zip(new[:-1], new[1:]):
            yield {k: v[lo:hi] for k, v in t.items()}
        held = {k: v[new[-1]:] for k, v in t.items()}
    if held is not None:
        yield held


def _alike(t: dict, least: float):
    """(row, its partners behind it) of one group: other classes, estimates of ``least`` or more,
    in the first band that both share; of two blocks only pairs across."""
    label, sig, bands = t["label"], t["sig"], t["bands"]
    cross = t["one"][0] != t["two"][0]
    second = int(np.searchsorted(t["block"], t["two"][0])) if cross else len(label)
    for i in range(second):
        j = second if cross else i + 1
        j += np.flatnonzero(label[j:] != label[i])
        j = j[np.count_nonzero(sig[j] == sig[i], axis=1) >= least * sig.shape[1]]
        if len(j):
            shared = bands[j] == bands[i]
            j = j[bands[i][shared.argmax(axis=1)] == t["band"][0]]
            if len(j):
                yield i, j


def _block_pairs(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (band, chunks, node, ...) cut into blocks by their nodes' hashes, every two
    blocks of a band in one group."""
    block = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    return (rows.withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("band", F.least("block", "other").alias("one"),
                    F.greatest("block", "other").alias("two"), "block", *columns))


def _by_group(rows: DataFrame) -> DataFrame:
    return (rows.repartition("band", "one", "two")
            .sortWithinPartitions("band", "one", "two", "block", "node"))


def candidates(member: DataFrame, nodes: DataFrame, label: DataFrame,
               threshold: float = THRESHOLD) -> DataFrame:
    """(band, node): members that in this band meet another class within the margin."""
    rows = (_block_pairs(mixed_bands(member, label, BLOCK), ["node", "label"])
            .join(nodes.select("node", "sig", "bands"), "node"))
    least = threshold - MARGIN

    def run(batches):
        for t in _groups(batches):
            has = np.zeros(len(t["node"]), bool)
            for i, j in _alike(t, least):
                has[i] = True
                has[j] = True
            if has.any():
                yield pa.RecordBatch.from_arrays([pa.array(t["band"][has]), pa.array(t["node"][has])],
                                                 names=["band", "node"])

    return _by_group(rows).mapInArrow(run, "band long, node long").distinct()


def bag_table(wanted: DataFrame, nodes: DataFrame, docs: DataFrame,
              shingle: int = SHINGLE) -> DataFrame:
    """(node, bag) of the ``wanted`` nodes: the sorted hashes of a text, then their counts."""
    keyed = (wanted.join(nodes.select("node", "first_id", "copy"), "node")
             .select("node", row_key(F.col("first_id"), F.col("copy")).alias("key")))
    text = texts(docs).select(row_key(F.col("doc_id"), F.md5("text")).alias("key"), "text")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                b = batch.slice(lo, BATCH_TEXTS)
                doc, value, weight = bags(b.column("text").to_pylist(), shingle)
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("node"), pa.array(
                        [value[x:y].astype("<u8").tobytes() + weight[x:y].astype("<u4").tobytes()
                         for x, y in zip(cut[:-1], cut[1:])], pa.binary())], names=["node", "bag"])

    return (keyed.join(text, "key").select("node", "text").mapInArrow(run, "node long, bag binary")
            .dropDuplicates(["node"]))


def last_links(member: DataFrame, nodes: DataFrame, label: DataFrame, docs: DataFrame,
               threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """(a, b): links between the classes of ``label`` that all pairs of a band give, once in the
    first band that a pair shares.

    The members that meet another class within the margin travel with their bags to every
    two blocks of their band (blocks of about ``BLOCK_BYTES``); a pair is verified there
    unless the links that the task has found join it already, so a group gives fewer
    links than it has classes.
    """
    found = written(candidates(member, nodes, label, threshold), "candidates")
    bag = written(bag_table(found.select("node").distinct(), nodes, docs, shingle), "bags")
    size = (found.join(bag.select("node", F.length("bag").alias("bytes")), "node").groupBy("band")
            .agg(F.ceil(F.sum("bytes") / F.lit(BLOCK_BYTES)).cast("int").alias("chunks")))
    size = size.withColumn("chunks", F.greatest("chunks", F.lit(1)))
    rows = (_block_pairs(found.join(size, "band"), ["node"]).join(label, "node", "left")
            .withColumn("label", F.coalesce("label", "node"))
            .join(nodes.select("node", "sig", "bands"), "node").join(bag, "node"))
    least = threshold - MARGIN

    def links(t):
        above = {}

        def root(x):
            while above.get(x, x) != x:
                above[x] = x = above.get(above[x], above[x])
            return x

        bag = []
        for x in t["bag"]:
            n = len(x) // 12
            bag.append((np.frombuffer(x, "<u8", n), np.frombuffer(x, "<u4", n, 8 * n).astype(np.int64)))
        total = np.array([int(w.sum()) for _, w in bag])
        name = t["label"].tolist()
        for i, j in _alike(t, least):
            j = j[np.minimum(total[j], total[i]) >= threshold * np.maximum(total[j], total[i])]
            for k in j.tolist():
                x, y = root(name[i]), root(name[k])
                if x != y and overlap(bag[i], bag[k]) >= threshold:
                    above[max(x, y)] = min(x, y)
                    yield name[i], name[k]

    def run(batches):
        for t in _groups(batches):
            out = list(links(t))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 names=["a", "b"])

    return _by_group(rows).mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE,
            slots: int = SLOTS, rows: int = BAND_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): (doc_id, copy) of every document, and (copy, node, label) of
    every distinct text."""
    table = written(band_table(docs, shingle, slots, rows), "bands")
    nodes = written(table.groupBy("copy").agg(F.min("doc_id").alias("first_id"),
                                              F.first("bands").alias("bands"),
                                              F.first("sig").alias("sig"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    # only bands with two distinct texts or more matter
    turned = F.concat(F.slice("bands", 2, slots), F.slice("bands", 1, 1))
    member = nodes.select("node", F.explode(F.arrays_zip(
        F.col("bands").alias("band"), turned.alias("following"))).alias("k")).select("node", "k.*")
    shared = (member.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .filter("least < most"))
    member = written(member.join(shared.select("band", "least"), "band"), "members")
    tested = written(verify(member.filter("node <> least").select(
        "node", F.col("least").alias("centre")).distinct(), nodes, docs, threshold, shingle),
        "tested")
    links = tested.filter("similar").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    label = components(links)
    while True:
        offer = written(best_offers(member, nodes, label, threshold)
                        .join(tested.select("node", "centre"), ["node", "centre"], "left_anti"),
                        "offers")
        if not offer.head(1):
            break
        new = written(verify(offer, nodes, docs, threshold, shingle), "tested")
        one = label.select(F.col("node").alias("x"), F.col("label").alias("lx"))
        two = label.select(F.col("node").alias("y"), F.col("label").alias("ly"))
        links = (new.filter("similar").join(one, F.col("node") == F.col("x"), "left")
                 .join(two, F.col("centre") == F.col("y"), "left")
                 .select(F.coalesce("lx", "node").alias("a"), F.coalesce("ly", "centre").alias("b"))
                 .filter("a <> b").distinct())
        links = written(links, "links")
        if not links.head(1):
            break
        label = merged(label, links)
        tested = written(tested.union(new), "tested")
    links = written(last_links(member, nodes, label, docs, threshold, shingle), "links")
    if links.head(1):
        label = merged(label, links)
    label = (nodes.select("copy", "node").join(label, "node", "left")
             .select("copy", "node", F.coalesce("label", "node").alias("label")))
    return table.select("doc_id", "copy"), label


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, class_key, class_size) of every document."""
    rows_, nodes = classes(docs, **options)
    keyed = rows_.join(nodes.select("copy", F.col("label").alias("class_key")), "copy")
    per_class = keyed.groupBy("class_key").agg(F.min("doc_id").alias("class_id"),
                                               F.count(F.lit(1)).alias("class_size"))
    return keyed.join(per_class, "class_key").select("doc_id", "class_id", "class_key",
                                                     "class_size")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """One document of every class: the one with the least doc_id (nulls last), ties
    by the hash of the text; of fully equal rows any one."""
    rows_, nodes = classes(docs.select(F.col(id_col).alias("doc_id"),
                                       F.col(text_col).alias("text")), **options)
    key = "__near_key"
    while key in docs.columns:
        key += "_"
    keep = (rows_.join(nodes.select("copy", "label"), "copy").groupBy("label")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy"))
                 .alias("k")).select(row_key(F.col("k.doc_id"), F.col("k.copy")).alias(key)))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return (docs.withColumn(key, row_key(docs[id_col], F.md5(text))).join(keep, key, "left_semi")
            .dropDuplicates([key]).drop(key))


def op10_bagminhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
