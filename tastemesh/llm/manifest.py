"""Merkle dataset manifest as a postorder append log (operator 11).

Every row of the documents is a leaf digest.  The leaves of one language, in
ascending order of doc_id, form a tree in which each run of two neighbours becomes
one node per level (a last run may hold a single node); the languages' subroots, in
order, form the top tree in the same way.

A tree is kept as its *postorder log*: nodes in the order in which they are complete
when leaves are appended one by one.  Two closed forms address the log without any
pointer (:func:`nodes_before`, :func:`position`):

* before leaf s stand 2 s - popcount(s) nodes, because every subtree to its left is full;
* node (level, j) covers m leaves from s = j 2^level on and is the last of its
  subtree, so it stands at 2 s - popcount(s) + (sum over t <= level of ceil(m / 2^t)) - 1.

Building runs in tiers of ``TIER`` levels.  A builder owns an aligned range of
2^TIER leaves and appends its nodes in completion order; its last node is a leaf of
the next tier.  The first tier's nodes stay as *segments* (one binary value per
range), the few nodes above them as rows (tree, position, digest).  A proof takes
the siblings inside the leaf's segment and, from the rows, the siblings of the
segment's root, both by computed position.

Hot trees: a language is no unit of work.  Leaves are numbered by range partitions
over (tree, id, digest) and per-partition counts; builders get 2^TIER leaves each.

Defined cases: a null or empty field is ``-`` or ``0:``; a null doc_id comes first
in its tree and has no decimal form, so it is never tampered with; rows that tie in
doc_id are ordered by their leaf digest, equal rows are leaves of their own and get
equal digests but proofs of their own places; a null language is a tree of its own,
first of all; very long texts are hashed whole by Spark; an empty table has no root
and gives no rows; columns beyond the five named ones are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemesh.llm.common import documents, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TIER = 10                 # levels a builder closes: ranges of 1,024 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7                # rows whose crc32(doc_id) it divides are changed in the query
SHA = 32


# ------------------------------------------------------------------ closed forms

def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def nodes_before(s: int) -> int:
    """Nodes of the log before leaf ``s``."""
    return 2 * s - s.bit_count()


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree of ``level`` levels over ``leaves`` leaves."""
    return sum((leaves + (1 << t) - 1) >> t for t in range(level + 1))


def position(level: int, j: int, n: int) -> int:
    """Place of node ``j`` of ``level`` in the log of a tree of ``n`` leaves."""
    s = j << level
    return nodes_before(s) + subtree_size(level, min(1 << level, n - s)) - 1


def sibling_places(leaf: int, low: int, high: int, n: int) -> list[tuple[int, int, bool]]:
    """(level, place, sibling is left) of the siblings on the way of ``leaf`` from
    level ``low`` up to level ``high``; a lone node has none."""
    out = []
    for level in range(low, high):
        j = (leaf >> level) ^ 1
        if j << level < n:
            out.append((level, position(level, j, n), j & 1 == 0))
    return out


# ------------------------------------------------------------------ digests

def digest(*parts: bytes) -> bytes:
    """sha256 of the parts' lowercase hex texts, one behind the other."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


class LogBuilder:
    """Appends leaves to the log of one aligned range and closes it.

    ``open`` holds the last complete node per level, as the digits of a binary
    counter; ``log`` the digests in completion order, ``made`` (level, j) of each.
    """

    def __init__(self):
        self.log, self.made, self.open, self.n = [], [], [], 0

    def _put(self, level: int, j: int, node: bytes) -> None:
        self.log.append(node)
        self.made.append((level, j))

    def append(self, leaf: bytes) -> None:
        level, j, node = 0, self.n, leaf
        self._put(0, j, node)
        while j & 1:
            node = digest(self.open[level], node)
            level, j = level + 1, j >> 1
            self._put(level, j, node)
        if level == len(self.open):
            self.open.append(node)
        else:
            self.open[level] = node
        self.n += 1

    def close(self, levels: int) -> bytes:
        """Completes the right edge up to ``levels`` and returns the root there."""
        node = None                       # the ragged last node of the level below
        for level in range(levels):
            if self.n % (2 << level) == 0:
                continue                  # the last node above is full: it is in the log
            nodes = (self.n + (1 << level) - 1) >> level
            last = self.open[level] if self.n % (1 << level) == 0 else node
            node = digest(last) if nodes & 1 else digest(self.open[level], last)
            self._put(level + 1, (nodes - 1) >> 1, node)
        return self.log[-1]


def fold(leaf: bytes, way: list[tuple[bytes | None, bool]]) -> bytes:
    """The root that ``leaf`` and the siblings of its way (sibling or None, is left) give."""
    for sibling, left in way:
        leaf = (digest(leaf) if sibling is None else
                digest(sibling, leaf) if left else digest(leaf, sibling))
    return leaf


def way_of(leaf: int, low: int, high: int, n: int, node_at) -> list[tuple[bytes | None, bool]]:
    """The siblings of ``leaf`` from level ``low`` to ``high``; ``node_at(place)`` reads the log."""
    there = {level: (node_at(place), left)
             for level, place, left in sibling_places(leaf, low, high, n)}
    return [there.get(level, (None, False)) for level in range(low, high)]


# ------------------------------------------------------------------ leaves

def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**fields: Column) -> Column:
    """Binary sha256 of a row's fields, each ``-`` or its UTF-8 length, ``:``, its value."""
    return F.unhex(F.sha2(F.concat(*[_field(fields[f]) for f in FIELDS]), 256))


def tree_key(lang: Column) -> Column:
    """The key of a language's tree: never null, in the order of the languages (null
    first, then bytewise)."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def leaf_rows(docs: DataFrame, **more: Column) -> DataFrame:
    """(tree, doc_id, leaf) of every row, and ``more`` columns, as a written table: the
    texts are hashed once and stay behind."""
    return written(docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id",
                               leaf_digest(**{f: F.col(f) for f in FIELDS}).alias("leaf"),
                               *[c.alias(name) for name, c in more.items()]), "leaf-rows")


def numbered(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves`` with ``place`` (0-based in its tree, in the given order) and ``n``
    (leaves of the tree).  Rows are dealt by ranges over tree and order; a running row
    id as the last key spreads rows that are equal in all others."""
    keys = ["tree", *order]
    tied = leaves.withColumn("_row", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys)
              .withColumn("_range", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id()).drop("_row"))
    ranged = written(ranged, "leaves")
    # one row per range and tree: small, whatever the number of leaves
    counts = ranged.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_in"),
                                                  F.min("_at").alias("_from"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select("tree", "_range", "_from",
                           F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_base"),
                           F.sum("_in").over(Window.partitionBy("tree")).alias("n"))
    return (ranged.join(counts, ["tree", "_range"])
            .withColumn("place", F.col("_base") + F.col("_at") - F.col("_from"))
            .drop("_range", "_at", "_from", "_base"))


# ------------------------------------------------------------------ building

_BUILT = "tree string, part long, n long, root binary, log binary, places array<long>"


def _builders(tier: int, keep_segments: bool):
    """A mapInArrow over rows (tree, part, place, n, leaf) sorted by them: one
    :class:`LogBuilder` per (tree, part)."""
    base = tier * TIER

    def finish(key, n, builder):
        tree, part = key
        total = height(n)
        levels = min(TIER, total - base)
        root = builder.close(levels)
        places = None
        if not keep_segments:
            # the range's own leaves are nodes that the tier below has written
            first = part << TIER
            kept = [(level, j, node) for (level, j), node in zip(builder.made, builder.log)
                    if level > 0]
            places = [position(base + level, (first >> level) + j, n) for level, j, _ in kept]
            log = b"".join(node for _, _, node in kept)
        else:
            log = b"".join(builder.log)
        return tree, part, n, root, log, places

    def run(batches: Iterator):
        import pyarrow as pa
        schema = pa.schema([("tree", pa.string()), ("part", pa.int64()), ("n", pa.int64()),
                            ("root", pa.binary()), ("log", pa.binary()),
                            ("places", pa.list_(pa.int64()))])
        key, builder, size, done = None, None, 0, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "part", "n", "leaf")]
            for tree, part, n, leaf in zip(*columns):
                if builder is None or key != (tree, part):
                    if builder is not None:
                        done.append(finish(key, size, builder))
                    key, builder, size = (tree, part), LogBuilder(), n
                builder.append(leaf)
            if len(done) >= 64:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if builder is not None:
            done.append(finish(key, size, builder))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    return run


def _tier(rows: DataFrame, tier: int, keep_segments: bool) -> DataFrame:
    """One tier of builders over rows (tree, place, n, leaf)."""
    part = F.shiftright("place", TIER).alias("part")
    dealt = (rows.select("tree", part, "place", "n", "leaf").repartition("tree", "part")
             .sortWithinPartitions("tree", "part", "place").select("tree", "part", "n", "leaf"))
    return written(dealt.mapInArrow(_builders(tier, keep_segments), _BUILT), f"tier-{tier}")


class Forest:
    """Postorder logs of many trees.

    ``segments`` (tree, part, n, root, log): the nodes of each range of 2^TIER
    leaves; ``upper`` (tree, place, node): the nodes above, by place in the tree's
    log; ``roots`` (tree, n, root).
    """

    def __init__(self, segments: DataFrame, upper: DataFrame, roots: DataFrame):
        self.segments, self.upper, self.roots = segments, upper, roots

    @staticmethod
    def build(leaves: DataFrame) -> "Forest":
        """From numbered leaves (tree, place, n, leaf)."""
        tier = _tier(leaves, 0, keep_segments=True)
        segments, whole, upper = tier, [], []
        built = tier.select("tree", "part", "n", "root")
        biggest = built.agg(F.max("n")).first()[0] or 0
        k = 0
        while True:
            done = F.col("n") <= (1 << (TIER * (k + 1)))
            whole.append(built.filter(done).select("tree", "n", "root"))
            k += 1
            if biggest <= 1 << (TIER * k):
                break
            rest = built.filter(~done).select("tree", F.col("part").alias("place"), "n",
                                              F.col("root").alias("leaf"))
            tier = _tier(rest, k, keep_segments=False)
            # the roots of the tier below are leaves here: their places are closed-form too
            upper.append(tier.select("tree", "places", "log"))
            built = tier.select("tree", "part", "n", "root")
        roots = whole[0]
        for more in whole[1:]:
            roots = roots.unionByName(more)
        spark = leaves.sparkSession
        nodes = spark.createDataFrame([], "tree string, place long, node binary")
        for t in upper:
            each = t.select("tree", F.posexplode("places").alias("_k", "place"), "log")
            nodes = nodes.unionByName(each.select(
                "tree", "place", F.expr(f"substring(log, _k * {SHA} + 1, {SHA})").alias("node")))
        # roots of ranges are siblings of one another, too
        tops = segments.filter(F.col("n") > 1 << TIER).select(
            "tree", _root_place().alias("place"), F.col("root").alias("node"))
        return Forest(segments, nodes.unionByName(tops), roots)

    def ways(self) -> DataFrame:
        """(tree, part, n, above): for every segment the siblings on the way of its root,
        lowest first, as (level, node) of those that exist."""
        seg = self.segments.select("tree", "part", "n")
        wanted = seg.filter(F.col("n") > 1 << TIER).select(
            "tree", "part", F.explode(_upper_siblings_udf()("part", "n")).alias("w")).select(
            "tree", "part", F.col("w.level").alias("level"), F.col("w.place").alias("place"))
        above = (wanted.join(self.upper, ["tree", "place"]).groupBy("tree", "part").agg(
            F.sort_array(F.collect_list(F.struct("level", "node"))).alias("above")))
        return seg.join(above, ["tree", "part"], "left")      # at most one a level

    def save(self, path: str) -> None:
        for name in ("segments", "upper", "roots"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        return Forest(*[spark.read.parquet(f"{path}/{name}")
                        for name in ("segments", "upper", "roots")])


def _root_place() -> Column:
    """Place of a segment's root (level TIER, node ``part``) in its tree's log, by the
    closed form of :func:`position`."""
    s = F.shiftleft("part", TIER)
    m = F.least(F.lit(1 << TIER), F.col("n") - s)
    size = m
    for t in range(1, TIER + 1):
        size = size + F.shiftright(m + ((1 << t) - 1), t)
    return 2 * s - F.bit_count(s) + size - 1


def _upper_siblings_udf():
    schema = "array<struct<level:int,place:long>>"

    @F.pandas_udf(schema)
    def places(part: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([[{"level": level, "place": place} for level, place, _ in sibling_places(
            p << TIER, TIER, height(size), size)] for p, size in zip(part.tolist(), n.tolist())])
    return places


# ------------------------------------------------------------------ the manifest

class Manifest:
    """The logs of all languages and of the top tree over their subroots.

    ``tops`` (tree, name, leaf, place, n): the subroot of every language and its
    place in the top tree; ``root``: the root of the whole dataset, None if it is empty.
    """

    def __init__(self, forest: Forest, top: Forest, tops: DataFrame):
        self.forest, self.top, self.tops = forest, top, tops
        row = top.roots.select("root").first()
        self.root = None if row is None else bytes(row[0])

    @staticmethod
    def build(leaves: DataFrame) -> "Manifest":
        """From numbered leaves (tree, place, n, leaf)."""
        forest = Forest.build(leaves)
        tops = numbered(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                            F.col("root").alias("leaf")), "name")
        return Manifest(forest, Forest.build(tops), tops)

    def save(self, path: str) -> None:
        self.forest.save(f"{path}/forest")
        self.top.save(f"{path}/top")
        self.tops.write.parquet(f"{path}/tops")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Manifest":
        return Manifest(Forest.load(spark, f"{path}/forest"), Forest.load(spark, f"{path}/top"),
                        spark.read.parquet(f"{path}/tops"))

    def _top_ways(self) -> DataFrame:
        """(tree, subroot, tplace, tway): every language's way in the top tree, 32 bytes a
        level (zero bytes: no sibling)."""
        ways = self.top.ways().join(self.top.segments.select("tree", "part", "log"),
                                    ["tree", "part"])
        rows = (self.tops.withColumn("part", F.shiftright("place", TIER))
                .join(ways.select("part", "log", "above"), "part"))

        def run(batches: Iterator):
            import pyarrow as pa
            for batch in batches:
                packed = [_packed(SegmentReader(place >> TIER, n, log).way(place)
                                  + _upper_way(place >> TIER, n, above))
                          for place, n, log, above in zip(*(
                              batch.column(c).to_pylist() for c in ("place", "n", "log", "above")))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("name"), batch.column("leaf"), batch.column("place"),
                     pa.array(packed, pa.binary())], ["tree", "subroot", "tplace", "tway"])
        return rows.select("name", "leaf", "place", "n", "log", "above").mapInArrow(
            run, "tree string, subroot binary, tplace long, tway binary")

    def proofs(self, requests: DataFrame) -> DataFrame:
        """For requests (tree, place, leaf, and any columns): those columns with subroot,
        root, siblings (binary, 32 bytes each, from the leaf upwards) and folded (the
        root that ``leaf`` gives with these siblings)."""
        from pyspark.sql import types as T
        # ways are narrow; the logs join them by (tree, part), which is unique
        ways = self.forest.ways().join(self._top_ways(), "tree")
        segments = self.forest.segments.select("tree", "part", "log").join(ways, ["tree", "part"])
        kept = [c for c in requests.columns if c not in ("tree", "place", "leaf")]
        schema = requests.select(*kept).schema
        for name in ("subroot", "root", "siblings", "folded"):
            schema = schema.add(name, T.BinaryType())
        root = self.root

        def answer(asked, segment):
            import pyarrow as pa
            siblings, folded, subroot = [], [], None
            if asked.num_rows:
                if segment.num_rows != 1:
                    raise ValueError("a request for a leaf that is not in the manifest")
                seg = segment.to_pylist()[0]
                subroot = seg["subroot"]
                inner = SegmentReader(seg["part"], seg["n"], seg["log"])
                outer = (_upper_way(seg["part"], seg["n"], seg["above"])
                         + _unpacked(seg["tway"], seg["tplace"]))
                for place, leaf in zip(asked["place"].to_pylist(), asked["leaf"].to_pylist()):
                    way = inner.way(place) + outer
                    siblings.append(b"".join(s for s, _ in way if s is not None))
                    folded.append(fold(leaf, way))
            out = asked.select(kept)
            for name, col in (("subroot", [subroot] * len(folded)), ("root", [root] * len(folded)),
                              ("siblings", siblings), ("folded", folded)):
                out = out.append_column(name, pa.array(col, pa.binary()))
            return out

        left = requests.withColumn("part", F.shiftright("place", TIER))
        return (left.groupBy("tree", "part").cogroup(segments.groupBy("tree", "part"))
                .applyInArrow(answer, schema))


class SegmentReader:
    """Ways of leaves inside one segment, read by closed-form places in its log."""

    def __init__(self, part: int, n: int, log: bytes):
        self.first = part << TIER
        self.m = min(1 << TIER, n - self.first)
        self.levels, self.log = min(TIER, height(n)), log

    def way(self, place: int) -> list[tuple[bytes | None, bool]]:
        return way_of(place - self.first, 0, self.levels, self.m,
                      lambda at: self.log[at * SHA:(at + 1) * SHA])


def _upper_way(part: int, n: int, above) -> list[tuple[bytes | None, bool]]:
    """The way of a segment's root to the root of its tree, from the joined siblings."""
    there = {a["level"]: a["node"] for a in above or []}
    wanted = sibling_places(part << TIER, TIER, height(n), n)
    if len(wanted) != len(there):
        raise ValueError("a node of the log is missing")
    left = {level: is_left for level, _, is_left in wanted}
    return [(there.get(level), left.get(level, False)) for level in range(TIER, height(n))]


def _packed(way) -> bytes:
    return b"".join(bytes(SHA) if s is None else s for s, _ in way)


def _unpacked(packed: bytes, place: int) -> list[tuple[bytes | None, bool]]:
    out = []
    for level in range(len(packed) // SHA):
        s = packed[level * SHA:(level + 1) * SHA]
        out.append((None if s == bytes(SHA) else s, (place >> level) & 1 == 1))
    return out


def op11_postorder_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every row; rows whose crc32(doc_id) seven divides
    are folded from a leaf with n_chars one larger."""
    docs = documents(spark, sf_dir)
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    changed = leaf_digest(**{f: F.col(f) for f in FIELDS} | {"n_chars": F.col("n_chars") + 1})
    rows = numbered(leaf_rows(docs, changed=F.when(struck, changed)), "doc_id", "leaf")
    manifest = Manifest.build(rows.select("tree", "place", "n", "leaf"))
    out = manifest.proofs(rows.select("tree", "place", "doc_id", F.col("leaf").alias("original"),
                                      F.coalesce("changed", "leaf").alias("leaf")))

    def text(c: str) -> Column:
        return F.lower(F.hex(c))
    return out.select("doc_id", text("original").alias("leaf"), text("subroot").alias("subroot"),
                      text("root").alias("root"),
                      F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"),
                      text("folded").alias("folded_root"),
                      (F.col("folded") == F.col("root")).alias("verified"))


#: the same rows by levels and grouping in SQL, with neither logs nor places
OP11_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, i:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b))),
fields AS (
  SELECT doc_id, lang, n_chars, text, coalesce('=' || lang, '') AS tree,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         xor(list_reduce([4294967295] || list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
             lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 7 = 0 AS struck
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, tree,
         sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')
                || tail) AS leaf,
         CASE WHEN struck AND n_chars IS NOT NULL THEN
           sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1)
                  || tail) END AS changed
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2),
subroots AS (
  SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS tidx,
         count(*) OVER () AS trees
  FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, tidx AS idx, subroot AS h, trees AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, idx // 2),
root AS (SELECT level AS height, h AS root FROM top WHERE n = 1),
below AS (
  SELECT p.tree, p.idx, l.level AS step, s.h AS sibling, (p.idx >> l.level) & 1 = 1 AS on_left
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) l ON l.tree = p.tree
  LEFT JOIN nodes s ON s.tree = p.tree AND s.level = l.level AND s.idx = xor(p.idx >> l.level, 1)),
above AS (
  SELECT r.tree, r.height + l.level AS step, s.h AS sibling, (r.tidx >> l.level) & 1 = 1 AS on_left
  FROM subroots r CROSS JOIN (SELECT DISTINCT level FROM top WHERE n > 1) l
  LEFT JOIN top s ON s.level = l.level AND s.idx = xor(r.tidx >> l.level, 1)),
way AS (
  SELECT * FROM below
  UNION ALL SELECT a.tree, p.idx, a.step, a.sibling, a.on_left
  FROM above a JOIN placed p ON p.tree = a.tree),
folds AS (
  SELECT tree, idx, 0 AS step, coalesce(changed, leaf) AS h FROM placed
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1,
         sha256(CASE WHEN w.sibling IS NULL THEN f.h
                     WHEN w.on_left THEN w.sibling || f.h ELSE f.h || w.sibling END)
  FROM folds f JOIN way w ON w.tree = f.tree AND w.idx = f.idx AND w.step = f.step),
proofs AS (
  SELECT p.tree, p.idx, coalesce(string_agg(w.sibling, '' ORDER BY w.step), '') AS siblings
  FROM placed p LEFT JOIN way w ON w.tree = p.tree AND w.idx = p.idx GROUP BY p.tree, p.idx)
SELECT p.doc_id, p.leaf, r.subroot, t.root, sha256(q.siblings) AS proof_sha256,
       f.h AS folded_root, f.h = t.root AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree CROSS JOIN root t
JOIN proofs q ON q.tree = p.tree AND q.idx = p.idx
JOIN folds f ON f.tree = p.tree AND f.idx = p.idx AND f.step = r.height + t.height
"""
