"""BPE encoding and decoding (operator 8) over a minimal acyclic transducer.

The frequent words of the corpus (pre-tokens of the byte-level vocabulary) are
merged to ids once and compiled into a minimal acyclic automaton: states with
equal right languages are one state, so words share prefixes and suffixes.
Transitions carry outputs; their sum along a word is the word's number, under
which its ids lie in one flat array.  The automaton is a handful of flat
arrays in one file of bounded size (``LEXICON_WORDS`` words of at most
``LEXICON_BYTES`` bytes).  Spark's own file distribution puts it beside every
executor and tasks memory-map it.  A batch's distinct words run through it
together, one transition per step; words it lacks are merged exactly, pair by
pair in rank order.

Word counts cover all documents: tasks count, a shuffle adds up, a histogram of
at most a thousand classes of counts finds how frequent a word must be for at
most ``LEXICON_WORDS`` words to qualify, and only those reach the driver.

Defined cases: null and empty texts have no ids and decode to the empty text;
the special token's spelling in a text is its id; a run without spaces is
merged by a heap, in n log n steps; repeated rows get equal rows; an empty
table gives an empty lexicon and no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import math
import mmap
import struct
import sys
import uuid
from array import array
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import documents, scratch_path, texts, written
from tastemesh.llm.vocab import (BYTE_PATTERN, Stretches, byte_alphabet, gather,
                                 once_per_worker, vocabulary_path)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEXICON_WORDS = 300_000
LEXICON_BYTES = 64            # longer pre-tokens are never frequent words worth a path
CACHE_WORDS = 300_000         # merged unseen words that a worker remembers
BATCH_TEXTS = 4096
COUNT_TEXTS = 8192


class Merges:
    """The merge rules of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_id = [0] * 256
        for shown, b in alphabet.items():
            self.byte_id[b] = vocab[shown]
        self.rank: dict[int, int] = {}             # both ids of a pair in one number
        self.merged: list[int] = []                # rank -> new id
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a] << 32 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked adjacent pair, leftmost first,
        is replaced until no rule applies."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 64:
            return self._merge_long(ids)
        rank, none = self.rank, len(self.merged)
        ranks = [rank.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            ids[i:i + 2] = [self.merged[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] << 32 | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n, rank = len(ids), self.rank
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = self.merged[r], False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for left, right in ((prv[i], i), (i, nxt[i])):
                if left >= 0 and right < n:
                    r = rank.get(ids[left] << 32 | ids[right])
                    if r is not None:
                        heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x, ok in zip(ids, alive) if ok]


# ---------------------------------------------------------------- the automaton

def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file of a minimal acyclic transducer: word -> its ids.

    Words are added in order; once a state can get no further transition, it is
    replaced by an equal state if there is one.  Outputs number the words: a
    transition adds how many words come before those that pass through it.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []          # finished: (final, ((byte, target), ...))

    def finish(node) -> int:
        key = (node[0], tuple((b, t) for b, t in node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]               # open states of the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            ended = finish(path.pop())
            edges = path[-1][1]
            edges[-1] = (edges[-1][0], ended)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for b in word[common:]:
            path[-1][1].append((b, None))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = finish(path[0])
    below = [0] * len(states)                      # words from a state; targets come first
    key, target, output = [], [], []
    for s, (final, edges) in enumerate(states):
        n = int(final)
        for b, t in edges:
            key.append(s * 256 + b)
            target.append(t)
            output.append(n)
            n += below[t]
        below[s] = n
    ids = [entries[w] for w in words]
    ends = np.cumsum([0, *map(len, ids)])
    arrays = [np.array(key, "<i8"), np.array(target, "<i8"), np.array(output, "<i8"),
              np.array([f for f, _ in states], "<i8"), ends.astype("<i8"),
              np.array([i for x in ids for i in x], "<u4")]
    head = struct.pack("<4sQ6Q", b"MAT1", root, *map(len, arrays))
    return head + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon over a buffer (a memory map of its file)."""

    def __init__(self, buffer):
        magic, self.root, *sizes = struct.unpack_from("<4sQ6Q", buffer, 0)
        if magic != b"MAT1":
            raise ValueError("not a lexicon")
        at, arrays = struct.calcsize("<4sQ6Q"), []
        for n, kind in zip(sizes, ("<i8",) * 5 + ("<u4",)):
            arrays.append(np.frombuffer(buffer, kind, n, at))
            at += arrays[-1].nbytes
        self.key, self.target, self.output, self.final, self.ends, self.ids = arrays

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if the lexicon lacks it."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        state, out = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        number = np.full(n, -1, np.int64)
        live = np.arange(n)
        step = 0
        while len(live) and len(self.key):
            done = size[live] == step
            if done.any():
                ended = live[done]
                number[ended] = np.where(self.final[state[ended]] == 1, out[ended], -1)
                live = live[~done]
                if not len(live):
                    break
            want = state[live] * 256 + flat[begin[live] + step]
            edge = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[edge] == want
            live, edge = live[ok], edge[ok]
            state[live] = self.target[edge]
            out[live] += self.output[edge]
            step += 1
        return number


# ---------------------------------------------------------------- encoder, decoder

class Encoder:
    """Texts to ids through a lexicon, exact merging behind it.

    In a text whose white space is single blanks and line feeds within words, a
    pre-token never crosses from a blank's left to its right, so Arrow cuts such
    texts before their blanks and only distinct stretches are looked at.  Other
    texts, and texts with a special token, are cut by the pattern as a whole.
    """

    def __init__(self, vocab_path: str, lexicon: Lexicon | None):
        import regex
        self.find = regex.compile(BYTE_PATTERN).findall
        self.merges = Merges(vocab_path)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")")
        self.odd = "|".join([r"^\s", r"\s$", r"\s\s", r"[^\S\n ]",
                             *map(regex.escape, self.merges.special)])
        self.lexicon = lexicon
        self.unseen: dict[bytes, bytes] = {}       # word -> its ids as 32-bit numbers
        self.known = Stretches()

    def stretches(self, texts_):
        """(stretches of regular texts as an Arrow list array, which texts are odd)."""
        import pyarrow.compute as pc
        texts_ = texts_.cast(pa.large_string())
        ascii_odd = pc.match_substring_regex(texts_, self.odd)
        # RE2's classes hold ASCII white space only; other white space is odd as well
        wide = pc.match_substring_regex(
            texts_, r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
                    r"\x{202f}\x{205f}\x{3000}\x{0}]")
        odd = pc.or_(ascii_odd, wide).to_numpy(zero_copy_only=False)
        # a mark before each blank, then cut at the marks: blanks stay in front of words
        marked = pc.replace_substring(texts_, " ", "\x00 ")
        return pc.split_pattern(marked, "\x00"), odd

    def pieces(self, text: str) -> list[str]:
        """All pre-tokens of a text; a special token is marked by a leading NUL."""
        special = self.merges.special
        if not any(s in text for s in special):
            return self.find(text)
        out = []
        for part in self.special.split(text):
            out += ["\0" + part] if part in special else self.find(part)
        return out

    def _merge_pieces(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all lists in one array, number of ids per list)."""
        special = {"\0" + s: array("I", [i]).tobytes() for s, i in self.merges.special.items()}
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        coded = pa.array(list(chain.from_iterable(pieces)), pa.large_string()).dictionary_encode()
        at = coded.indices.to_numpy()
        shown = coded.dictionary.to_pylist()
        words = [w.encode() for w in shown]
        lex = self.lexicon
        number = lex.numbers(words)
        known = number >= 0
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[known] = lex.ends[number[known]]
        size[known] = lex.ends[number[known] + 1] - start[known]
        own: list[bytes] = []
        if len(self.unseen) > 2 * CACHE_WORDS:
            self.unseen.clear()
        for k in np.flatnonzero(~known):
            word = words[k]
            ids = special.get(shown[k]) or self.unseen.get(word)
            if ids is None:
                ids = array("I", self.merges.merge(word)).tobytes()
                if len(word) <= LEXICON_BYTES:
                    self.unseen[word] = ids
            own.append(ids)
        # the ids of words beyond the lexicon lie behind the lexicon's own
        size[~known] = np.fromiter(map(len, own), np.int64, len(own)) // 4
        start[~known] = len(lex.ids) + np.cumsum(size[~known]) - size[~known]
        flat = np.concatenate([lex.ids, np.frombuffer(b"".join(own), np.uint32)])
        size = size[at]
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n)]]
        return gather(flat, start[at], size), np.diff(upto)

    def encode(self, texts_) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, number of ids per text); ``texts_`` is an
        Arrow string array without nulls."""
        import pyarrow.compute as pc
        lists, odd = self.stretches(texts_)
        if len(self.known.index) > CACHE_WORDS:
            self.known = Stretches()
        regular = lists.filter(pa.array(~odd))
        coded = regular.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known.index
        new = [w for w in distinct if w not in known]
        if new:
            self.known.add(new, *self._merge_pieces([self.find(w) for w in new]))
        at = self.known.places(distinct, len(distinct))[coded.indices.to_numpy()]
        size = self.known.size[at]
        n = pc.list_value_length(regular).to_numpy(zero_copy_only=False)
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n)]]
        ids, per_text = gather(self.known.flat, self.known.start[at], size), np.diff(upto)
        if not odd.any():
            return ids, per_text
        others = texts_.filter(pa.array(odd)).to_pylist()
        more, n_more = self._merge_pieces([self.pieces(t) for t in others])
        # put both kinds back in the order of the texts
        count = np.empty(len(odd), np.int64)
        begin = np.empty(len(odd), np.int64)
        count[~odd], count[odd] = per_text, n_more
        begin[~odd] = np.cumsum(per_text) - per_text
        begin[odd] = len(ids) + np.cumsum(n_more) - n_more
        return gather(np.concatenate([ids, more]), begin, count), count


def count_words(docs: DataFrame, vocab_path: str) -> DataFrame:
    """(word binary, n): all pre-tokens of all documents of at most
    ``LEXICON_BYTES`` bytes, counted per batch and then added up."""
    def count(batches):
        import pyarrow.compute as pc
        cutter = once_per_worker("cutter", vocab_path, lambda: Encoder(vocab_path, None))
        for batch in batches:
            for lo in range(0, batch.num_rows, COUNT_TEXTS):
                b = batch.column("text").slice(lo, COUNT_TEXTS)
                lists, odd = cutter.stretches(b)
                met = pc.value_counts(lists.filter(pa.array(~odd)).flatten())
                pieces = [cutter.find(w) for w in met.field("values").to_pylist()]
                pieces += [cutter.pieces(t) for t in b.filter(pa.array(odd)).to_pylist()]
                times = np.r_[met.field("counts").to_numpy(), np.ones(int(odd.sum()), np.int64)]
                times = np.repeat(times, np.fromiter(map(len, pieces), np.int64, len(pieces)))
                coded = pa.array(list(chain.from_iterable(pieces)),
                                 pa.large_string()).dictionary_encode()
                words = coded.dictionary.cast(pa.large_binary()).cast(pa.binary())
                n = np.bincount(coded.indices.to_numpy(), weights=times, minlength=len(words))
                size = pc.binary_length(words)
                keep = pc.and_(pc.greater(size, 0), pc.less_equal(size, LEXICON_BYTES))
                yield pa.RecordBatch.from_arrays(
                    [words.filter(keep), pa.array(n.astype(np.int64)).filter(keep)],
                    names=["word", "n"])
    return (texts(docs).select("text").mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(docs: DataFrame, vocab_path: str, most: int = LEXICON_WORDS) -> list[bytes]:
    """Words met twice or more, as frequent as keeps their number within ``most``."""
    grade = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    counts = written(count_words(docs, vocab_path).filter("n >= 2").withColumn("grade", grade), "words")
    least, room = math.inf, most
    for r in sorted(counts.groupBy("grade").count().collect(), reverse=True):  # <= 1024 rows
        if r["count"] > room:
            break
        least, room = r["grade"], room - r["count"]
    if least is math.inf:
        return []
    return [bytes(r["word"]) for r in counts.filter(F.col("grade") >= least)
            .select("word").collect()]


def share_lexicon(spark, data: bytes) -> str:
    """Put the lexicon file beside every executor; returns its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.mat"
    path = scratch_path(spark, "lexicon") + f"/{name}"
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(p)
    for lo in range(0, len(data), 1 << 20):
        out.write(bytearray(data[lo:lo + (1 << 20)]))
    out.close()
    sc.addFile(fs.makeQualified(p).toString())
    return name


def lexicon_for(docs: DataFrame, vocab_path: str, most: int = LEXICON_WORDS) -> str:
    """Compile the documents' frequent words and share the file; returns its name."""
    merges = Merges(vocab_path)
    return share_lexicon(docs.sparkSession, compile_lexicon(
        {w: merges.merge(w) for w in frequent_words(docs, vocab_path, most)}))


def _encoded(docs: DataFrame, vocab_path: str | None, most: int, decoded: bool) -> DataFrame:
    vocab_path = vocab_path or vocabulary_path("byte_bpe_50k.json")
    name = lexicon_for(docs, vocab_path, most)
    docs = texts(docs)
    fields = [docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches):
        encoder = once_per_worker("transducer", name, lambda: Encoder(
            vocab_path, Lexicon.open(SparkFiles.get(name))))
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                b = batch.slice(lo, BATCH_TEXTS)
                flat, size = encoder.encode(b.column("text"))
                upto = np.r_[0, np.cumsum(size)]
                cols = [b.column("doc_id"), pa.ListArray.from_arrays(
                    pa.array(upto, pa.int32()), pa.array(flat.astype(np.int32)))]
                if decoded:
                    cols.append(pa.array([spell(flat[x:y], encoder.merges.bytes_of)
                                          for x, y in zip(upto[:-1], upto[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def encode(docs: DataFrame, vocab_path: str | None = None, most: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, ids array<int>) of every document."""
    return _encoded(docs, vocab_path, most, decoded=False)


def round_trip(docs: DataFrame, vocab_path: str | None = None,
               most: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every document, and what they decode to."""
    return _encoded(docs, vocab_path, most, decoded=True)


def spell(ids: np.ndarray, bytes_of: list[bytes]) -> str:
    """The text of some ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join([bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace")


def decode(encoded: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``encoded`` (with ids) and its ``text``."""
    vocab_path = vocab_path or vocabulary_path("byte_bpe_50k.json")

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        table = once_per_worker("merges", vocab_path, lambda: Merges(vocab_path)).bytes_of
        return ids.map(lambda x: spell(x, table))
    return encoded.withColumn("text", run("ids"))


def op8_transducer_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
