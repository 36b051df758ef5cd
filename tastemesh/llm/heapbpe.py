"""Token counts by heap-and-linked-list byte-pair merging (operator 12).

A text's symbols form a linked list; a heap holds every adjacent pair whose
concatenation is a piece of the vocabulary.  The pair of the lowest rank (ties:
the leftmost) is popped and merged, its two new neighbour pairs are pushed, and
the count is the number of initial symbols minus the merges.  No identifier is
made.  A character without a piece of its own counts as its UTF-8 bytes (byte
fallback).

Merges never cross a place where no piece of the vocabulary has the two
characters side by side.  So a text is cut into units -- a run of word marks with
the joinable characters behind it, or a run of characters that join nothing --
each distinct unit is merged once per worker, and counts are added.  The cut is
exact for any vocabulary whose pieces have the word mark in front only, which is
checked when the vocabulary is read; for another, a text is one unit.

Defined cases: a null text counts as empty, an empty text has 0 bytes and 0
tokens; a very long text is read unit by unit and is never cut short (one unit of
n symbols takes n log n steps); repeated rows and tied or null ids are counted row by row;
an empty table gives an empty result; extra columns stay behind at the scan.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemesh.llm import vocab
from tastemesh.llm.common import documents, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_MODEL = "piece_bpe_32k.model"
LIMIT = 4096
MOST_UNITS = 1_000_000    # units kept per worker; past that they are counted anew
WORD_MARK = "▁"      # fixed value: how the vocabulary writes a blank
PLACE_BITS = 40           # a heap entry is rank << PLACE_BITS | place


class HeapCounts(dict):
    """unit -> tokens, filled on demand by heap merging.

    Blanks stand for word marks, so that plain texts stay one byte a character.
    """

    def __init__(self, path: str, most: int = MOST_UNITS):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.most = most
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i).replace(WORD_MARK, " "): -model.get_score(i)
                  for i in plain}
        # a rank per distinct score: pieces of one score tie, and ties go to the left
        order = {s: k for k, s in enumerate(sorted(set(pieces.values())))}
        self.rank = {p: order[s] << PLACE_BITS for p, s in pieces.items()}
        self.single = {p for p in pieces if len(p) == 1}
        self.units_of = re.compile(self._pattern(pieces), re.DOTALL)

    @staticmethod
    def _pattern(pieces) -> str:
        long = [p for p in pieces if len(p) > 1]
        if any(" " in p.lstrip(" ") for p in long):
            return ".+"
        joinable = "".join(sorted(set("".join(long)) - {" "}))
        inside = "".join(map(re.escape, joinable))
        return f" *[{inside}]+| +|[^{inside} ]+" if joinable else " +|[^ ]+"

    def __missing__(self, unit: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[unit] = self.merge(unit)
        return n

    def merge(self, unit: str) -> int:
        """Tokens of ``unit``: symbols minus merges, plus the extra bytes of
        characters without a piece."""
        rank, count = self.rank, len(unit)
        extra = sum(len(c.encode("utf-8", "surrogatepass")) - 1
                    for c in unit if c not in self.single)
        if count == 1:
            return 1 + extra
        symbols = list(unit)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        last = count
        heap = [r | k for k in range(count - 1)
                if (r := rank.get(unit[k:k + 2])) is not None]
        heapify(heap)
        place = (1 << PLACE_BITS) - 1
        while heap:
            top = heappop(heap)
            at = top & place
            left, nxt = symbols[at], after[at]
            if left is None or nxt == last:
                continue                                # merged into another symbol since
            joined = left + symbols[nxt]
            if rank.get(joined) != top - at:
                continue                                # a pair that has changed since
            symbols[at], symbols[nxt] = joined, None
            count -= 1
            beyond = after[at] = after[nxt]
            if beyond != last:
                before[beyond] = at
                r = rank.get(joined + symbols[beyond])
                if r is not None:
                    heappush(heap, r | at)
            ahead = before[at]
            if ahead >= 0:
                r = rank.get(symbols[ahead] + joined)
                if r is not None:
                    heappush(heap, r | ahead)
        return count + extra

    def count(self, text: str) -> int:
        """Tokens of a whole text (0 for an empty one)."""
        if not text:
            return 0
        marked = " " + text.replace(WORD_MARK, " ")
        if len(marked) < 1 << 20:
            return sum(map(self.__getitem__, self.units_of.findall(marked)))
        return sum(self[m[0]] for m in self.units_of.finditer(marked))


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text under the
    sentencepiece BPE model at ``vocabulary`` (a path)."""
    path = vocabulary or vocab.vocabulary_path(PIECE_MODEL)

    def counts(batches: Iterator):
        import pyarrow as pa
        table = vocab.once_per_worker(f"heap {path}", path, lambda: HeapCounts(path))
        for col in batches:
            yield pa.array([table.count(t.as_py()) for t in col], pa.int64())

    # annotations are read when the function is made, so they are given plainly
    import pyarrow as pa
    counts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    n_tokens = F.arrow_udf(counts, "long")
    rows = texts(docs, id_col, text_col)
    return rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                       n_tokens("text").alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit)


def op12_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
