"""Document fingerprints (operator 2): invertible Bloom lookup sketches of paragraphs.

A text is the multiset of its paragraphs: its lines, long lines at sentence
ends.  The o-th occurrence of a paragraph is a key of 60 bits (from md5), so the
multiset is a set of keys.  A sketch has three parts of w cells (w a power of
two); a key adds itself to one cell of each part: the cell counts, xors the
keys and xors a check value of each key that xor cannot mix up.  Only cells in
use are kept, in order, so the sketch of a text does not depend on the order of
its paragraphs.

Two sketches of equal w subtract cell by cell: common paragraphs vanish.  Peeling
then takes cells that hold one key (count 1 or -1, check right), removes the
key from its other cells, and goes on until nothing is left: the keys found are
exactly the paragraphs only one version has.  If cells remain, the pair is
sketched again four times as large, and again; a pair that resists three sizes
(hardly ever) is compared by its keys themselves.  Likeness is the share of
common paragraphs among all: Jaccard similarity of the multisets.

All of it is DataFrame and SQL functions; every step is a sort or one pass over
arrays of one document, n log n in its paragraphs.

The next document comes from one shuffle of the texts, without a global window:
doc_ids fall into ranges cut at approximate quantiles (a bounded number); each
range also receives the first document of the following range, and a window
within ranges reads the next text.

Defined cases: a null text is empty; an empty text has no paragraphs, and two
such are alike (1.0); null doc_ids come last in the order; equal doc_ids follow
in the order of their texts; a single document is its own next; an empty table
gives no rows; other columns are not read.  doc_id must be an integer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemesh.llm.common import count_rows, documents, texts

LONG_LINE = 400               # code points from which a line is cut at its sentence ends
LEAST_CELLS = 8               # least cells of a part
ROUNDS = 64                   # peeling rounds; a sketch that can be peeled needs about log log n
GROWTH = (1, 4, 16)           # sizes tried, as multiples of the first
RANGES = 1024                 # most quantile ranges
RANGE_ROWS = 1000             # documents aimed at per window
SUBRANGES = 256               # most equal cuts of a quantile range: at most 2^18 windows


# ---------------------------------------------------------------- SQL of the sketch

def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once under ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _check(x: str) -> str:
    return f"((({x}) % 2147483647L) * 40692L + shiftright({x}, 31)) % 2147483399L"


def _cell(part: int, x: str, w: str, count: str) -> str:
    place = f"{part} * {w} + cast(shiftright({x}, {20 * part}) & ({w} - 1L) as int)"
    return (f"named_struct('c', {place}, 'n', {count}, 'k', {x}, 'h', {_check(x)})")


def _cells_of(x: str, w: str, count: str) -> str:
    return "array(" + ", ".join(_cell(p, x, w, count) for p in range(3)) + ")"


def _merge(cells: str, v: str = "v") -> str:
    """Cells of one place added up (input in any order), empty ones dropped."""
    starts = (f"filter(sequence(0, size({v}) - 1), i -> i = 0 or {v}[i].c <> {v}[i - 1].c)")
    run = f"if(j + 1 < size(st), st[j + 1], size({v})) - b"
    summed = (f"if({run} = 1, {v}[b], aggregate(slice({v}, b + 2, {run} - 1), {v}[b], (acc, e) -> "
              f"named_struct('c', acc.c, 'n', acc.n + e.n, 'k', acc.k ^ e.k, 'h', acc.h ^ e.h)))")
    used = "z -> z.n <> 0 or z.k <> 0L or z.h <> 0L"
    body = _let(starts, "st", f"filter(transform(st, (b, j) -> {summed}), {used})")
    return _let(f"sort_array({cells})", v, f"if(size({v}) = 0, {v}, {body})")


def _signed(keys: str, w: str, count: str) -> str:
    return f"flatten(transform({keys}, x -> {_cells_of('x', w, count)}))"


def _sketch(keys: str, w: str) -> str:
    return _merge(_signed(keys, w, "1"))


def _peel(left: str, right: str, w: str) -> str:
    """The keys of one side only, as 2 * key + (1 if left), or null if peeling fails.

    Sketches are sums, so one merge of the left cells and the negated right cells
    is the difference of the two sketches.
    """
    diff = _merge(f"concat({_signed(left, w, '1')}, {_signed(right, w, '-1')})")
    pure = f"filter(s.t, u -> abs(u.n) = 1 and u.h = {_check('u.k')})"
    found = f"array_distinct(transform({pure}, u -> u.k * 2L + if(u.n > 0, 1L, 0L)))"
    gone = (f"flatten(transform(r, q -> "
            + _let("shiftright(q, 1)", "x", _cells_of("x", w, "if(q % 2 = 1, -1, 1)")) + "))")
    rest = _merge(f"concat(s.t, {gone})")
    step = _let(found, "r", f"if(size(r) = 0, s, named_struct('t', {rest}, 'r', concat(s.r, r)))")
    start = f"named_struct('t', {diff}, 'r', cast(array() as array<bigint>))"
    return (f"aggregate(sequence(1, {ROUNDS}), {start}, (s, turn) -> if(size(s.t) = 0, s, {step}), "
            f"s -> if(size(s.t) = 0, s.r, null))")


def _digest(text: str) -> str:
    return f"cast(conv(substr(md5({text}), 1, 15), 16, 10) as bigint)"


def paragraphs(text: Column) -> Column:
    """The lines of a text, long ones cut behind their sentences; no empty ones."""
    return F.filter(F.flatten(F.transform(F.split(text, "\n"), lambda line: F.when(
        F.length(line) <= LONG_LINE, F.array(line)).otherwise(
        F.split(F.regexp_replace(line, r"([.!?]) +", "$1\n"), "\n")))), lambda p: p != "")


def _keys_sql(pieces: str) -> str:
    starts = "filter(sequence(0, size(d) - 1), i -> i = 0 or d[i] <> d[i - 1])"
    run = "if(j + 1 < size(st), st[j + 1], size(d)) - b"
    numbered = (f"flatten(transform(st, (b, j) -> transform(sequence(1, {run}), o -> "
                f"if(o = 1, d[b], {_digest("concat(d[b], ':', o)")}))))")
    body = _let(starts, "st", f"sort_array(array_distinct({numbered}))")
    return _let(f"sort_array(transform({pieces}, p -> {_digest('p')}))", "d",
                f"if(size(d) = 0, d, {body})")


def _width_sql(n: str) -> str:
    """The least power of two that is at least ``n`` (8 at least, 2^20 at most)."""
    return (f"least(1048576, greatest({LEAST_CELLS}, "
            f"shiftleft(1, length(bin(greatest({n}, 2) - 1)))))")


# ---------------------------------------------------------------- DataFrame steps

def with_keys(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` and the key set of a text column."""
    tmp = f"{out}__pieces"
    return (df.withColumn(tmp, paragraphs(F.col(text))).withColumn(out, F.expr(_keys_sql(tmp)))
            .drop(tmp))


def fingerprint(keys_col: str) -> Column:
    """The sketch of a key set at its own size, as text: ``w:cell.count.key.check,...``."""
    sketch = _let(_width_sql(f"size({keys_col})"), "w", _sketch(keys_col, "w"))
    shown = f"transform({sketch}, e -> concat_ws('.', e.c, e.n, lower(hex(e.k)), lower(hex(e.h))))"
    return F.expr(f"concat({_width_sql(f'size({keys_col})')}, ':', array_join({shown}, ','))")


def difference(left: str, right: str) -> Column:
    """The keys of one side only (2 * key + 1 if ``left`` has it), by subtracting and
    peeling sketches, larger on failure."""
    first = _width_sql(f"2 * greatest(size({left}), size({right}))")
    tries = [_let(f"least(1048576, {grow} * {first})", "w",
                  _peel(left, right, "w")) for grow in GROWTH]
    exact = (f"concat(transform(array_except({left}, {right}), q -> q * 2L + 1L), "
             f"transform(array_except({right}, {left}), q -> q * 2L))")
    return F.expr(f"coalesce({', '.join(tries)}, {exact})")


def likeness(left: str, right: str, diff: str) -> Column:
    """Common keys among all keys, from the recovered difference; 1.0 for two empty sets."""
    return F.expr(f"if(size({left}) + size({right}) = 0, 1.0D, "
                  f"(size({left}) + size({right}) - size({diff})) / 2 / "
                  f"((size({left}) + size({right}) + size({diff})) / 2))")


def compare(df: DataFrame, left: str, right: str) -> DataFrame:
    """``df`` and, for two text columns, only_left and only_right (recovered paragraph
    digests) and likeness."""
    df = with_keys(with_keys(df, left, "left__keys"), right, "right__keys")
    df = df.withColumn("diff__", difference("left__keys", "right__keys"))
    return (df.withColumn("only_left", F.expr(
                "transform(filter(diff__, q -> q % 2 = 1), q -> shiftright(q, 1))"))
            .withColumn("only_right", F.expr(
                "transform(filter(diff__, q -> q % 2 = 0), q -> shiftright(q, 1))"))
            .withColumn("likeness", likeness("left__keys", "right__keys", "diff__"))
            .drop("left__keys", "right__keys", "diff__"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each document with the next one's text, in ascending
    (doc_id, text), the last with the first one's."""
    docs = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = count_rows(docs)
    ranges = max(1, min(RANGES, n // RANGE_ROWS))
    subs = max(1, min(SUBRANGES, n // (RANGE_ROWS * ranges)))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5],
                                        100 * ranges), F.min("doc_id"), F.max("doc_id")).first()
    points = sorted(set(cuts[0] or []))                       # fewer than `ranges` numbers
    low, high = (cuts[1] or 0), (cuts[2] or 0)
    lows = F.array(*[F.lit(int(p)).cast("long") for p in [low, *points]])
    highs = F.array(*[F.lit(int(p)).cast("long") for p in [*points, high + 1]])
    at = F.lit(0) if not points else F.size(F.filter(
        F.array(*[F.lit(int(p)).cast("long") for p in points]), lambda p: p <= F.col("doc_id")))
    docs = docs.withColumn("at", at)
    a, b = F.get(lows, F.col("at")), F.get(highs, F.col("at"))
    share = (F.col("doc_id").cast("double") - a) / F.greatest(b.cast("double") - a, F.lit(1.0))
    cell = (F.col("at").cast("long") * subs
            + F.least(F.floor(share * subs), F.lit(subs - 1)).cast("long"))
    last_cell = F.lit((len(points) + 1) * subs).cast("long")
    docs = docs.withColumn("cell", F.when(F.col("doc_id").isNull(), last_cell)
                           .otherwise(cell)).drop("at")
    # the first document of each range also goes to the range before: at most 2^18 rows
    firsts = docs.groupBy("cell").agg(F.min("doc_id").alias("first_id"))
    before = F.lag("cell").over(Window.orderBy("cell"))
    last = F.max("cell").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select("cell", "first_id", F.coalesce(before, last).alias("to"))
    f = F.broadcast(firsts)
    joined = docs.join(f.withColumnRenamed("cell", "own"),
                       (F.col("cell") == F.col("own")) & F.col("doc_id").eqNullSafe(
                           F.col("first_id")), "left")
    here = F.struct(F.col("cell").alias("cell"), F.lit(False).alias("copy"))
    there = F.struct(F.col("to").alias("cell"), F.lit(True).alias("copy"))
    placed = joined.select("doc_id", "text", F.explode(
        F.when(F.col("to").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("p"))
    order = Window.partitionBy("p.cell").orderBy("p.copy", F.col("doc_id").asc_nulls_last(),
                                                 "text")
    return (placed.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("p.copy"))
            .select("doc_id", "text", "next_text"))


def op2_invertible_bloom_fingerprints(spark, sf_dir: str) -> DataFrame:
    df = with_next(documents(spark, sf_dir))
    n = F.length("text")
    df = df.withColumn("edited", F.concat(F.expr("left(text, cast(length(text) - length(text) div 2 as int))"),
                                          F.expr("left(next_text, cast(length(text) div 2 as int))")))
    df = df.select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text", "edited",
                   F.sha2("edited", 256).alias("edited_sha256"))
    for text, out in (("text", "own_keys"), ("edited", "edited_keys"), ("next_text", "next_keys")):
        df = with_keys(df, text, out)
    df = df.select("doc_id", "n_chars", "edited_sha256", "own_keys", "edited_keys", "next_keys",
                   difference("own_keys", "edited_keys").alias("d_edited"),
                   difference("own_keys", "next_keys").alias("d_next"))
    return df.select("doc_id", "n_chars", "edited_sha256",
                     fingerprint("own_keys").alias("fingerprint"),
                     fingerprint("edited_keys").alias("edited_fingerprint"),
                     likeness("own_keys", "edited_keys", "d_edited").alias("near_edited"),
                     likeness("own_keys", "next_keys", "d_next").alias("near_next"))


OP2_SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), pair AS (
  SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id, t), first_value(t) OVER (
    ORDER BY doc_id, t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nx FROM doc
), texts AS (
  SELECT doc_id, t, nx, left(t, length(t) - length(t) // 2) || left(nx, length(t) // 2) AS ed
  FROM pair
), side AS (
  SELECT doc_id, 'own' AS side, t AS x FROM texts
  UNION ALL SELECT doc_id, 'edited', ed FROM texts
  UNION ALL SELECT doc_id, 'next', nx FROM texts
), line AS (
  SELECT doc_id, side, unnest(string_split(x, chr(10))) AS line FROM side
), piece AS (
  SELECT doc_id, side, unnest(CASE WHEN length(line) <= 400 THEN [line] ELSE string_split(
    regexp_replace(line, '([.!?]) +', '\\1' || chr(10), 'g'), chr(10)) END) AS p FROM line
), counted AS (
  SELECT doc_id, side, CAST('0x' || substr(md5(p), 1, 15) AS BIGINT) AS d, count(*) AS m
  FROM piece WHERE p <> '' GROUP BY doc_id, side, d
), numbered AS (
  SELECT doc_id, side, d, unnest(generate_series(1, m)) AS o FROM counted
), keys AS (
  SELECT DISTINCT doc_id, side, CASE WHEN o = 1 THEN d
    ELSE CAST('0x' || substr(md5(d || ':' || o), 1, 15) AS BIGINT) END AS k FROM numbered
), size AS (
  SELECT s.doc_id, s.side, count(k.k) AS n, least(1048576, greatest(8,
    1 << length(bin(greatest(count(k.k), 2) - 1)))) AS w
  FROM side s LEFT JOIN keys k ON s.doc_id = k.doc_id AND s.side = k.side GROUP BY s.doc_id, s.side
), cell AS (
  SELECT k.doc_id, k.side, part * w + ((k.k >> CAST(20 * part AS BIGINT)) & (w - 1)) AS c,
         count(*) AS n, bit_xor(k.k) AS k,
         bit_xor(((k.k % 2147483647) * 40692 + (k.k >> CAST(31 AS BIGINT))) % 2147483399) AS h
  FROM keys k JOIN size s ON k.doc_id = s.doc_id AND k.side = s.side,
       (VALUES (0), (1), (2)) AS parts(part)
  GROUP BY k.doc_id, k.side, c
), print AS (
  SELECT s.doc_id, s.side, any_value(s.n) AS n, any_value(s.w) || ':' || coalesce(string_agg(
    c.c || '.' || c.n || '.' || lower(hex(c.k)) || '.' || lower(hex(c.h)), ',' ORDER BY c.c), '')
    AS f
  FROM size s LEFT JOIN cell c ON s.doc_id = c.doc_id AND s.side = c.side
  GROUP BY s.doc_id, s.side
), common AS (
  SELECT a.doc_id, b.side, count(*) AS both
  FROM keys a JOIN keys b ON a.doc_id = b.doc_id AND a.k = b.k
  WHERE a.side = 'own' AND b.side <> 'own' GROUP BY a.doc_id, b.side
)
SELECT t.doc_id, length(t.t) AS n_chars, sha256(t.ed) AS edited_sha256, o.f AS fingerprint,
       e.f AS edited_fingerprint,
       CASE WHEN o.n + e.n = 0 THEN 1.0::DOUBLE ELSE CAST(coalesce(ce.both, 0) AS DOUBLE)
            / (o.n + e.n - coalesce(ce.both, 0)) END AS near_edited,
       CASE WHEN o.n + x.n = 0 THEN 1.0::DOUBLE ELSE CAST(coalesce(cx.both, 0) AS DOUBLE)
            / (o.n + x.n - coalesce(cx.both, 0)) END AS near_next
FROM texts t
JOIN print o ON o.doc_id = t.doc_id AND o.side = 'own'
JOIN print e ON e.doc_id = t.doc_id AND e.side = 'edited'
JOIN print x ON x.doc_id = t.doc_id AND x.side = 'next'
LEFT JOIN common ce ON ce.doc_id = t.doc_id AND ce.side = 'edited'
LEFT JOIN common cx ON cx.doc_id = t.doc_id AND cx.side = 'next'
"""
