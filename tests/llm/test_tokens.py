"""Operators 1, 3, 4 and 8 against the tokenizers library and plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tastemesh.llm import fertility, packing, transducer, vocab, wavelet
from tastemesh.llm.common import scratch_path
from llm_cases import pairs


@pytest.fixture(scope="module")
def byte_tok():
    return Tokenizer.from_file(vocab.vocabulary_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_tok():
    return Tokenizer.from_file(vocab.vocabulary_path("word_bpe_49k.json"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_packing(request, table, byte_tok):
    docs = request.getfixturevalue(table)
    got = packing.pack_documents(docs).collect()
    want = collections.Counter()
    total = 0
    for i, t in pairs(docs):
        ids = byte_tok.encode(t, add_special_tokens=False).ids + [2]
        total += len(ids)
        for k, (s, n) in enumerate(packing.cut_points(len(ids), 1024)):
            want[i, k, s, n, crc(ids[s:s + n])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
                               for r in got) == want
    per = collections.defaultdict(list)
    for r in got:
        per[r.sequence_id].append((r.offset, r.length))
    for placed in per.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(per) <= -(-total // 1024) * 1.02 + 1


def test_cut_points():
    assert packing.cut_points(1, 4) == [(0, 1)] and packing.cut_points(4, 4) == [(0, 4)]
    assert packing.cut_points(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_capacity(rule):
    rnd = random.Random(3)
    lengths = np.array(sorted((rnd.randint(1, 60) for _ in range(400)), reverse=True))
    cap = np.array([64, 5, 2500])
    if (lengths ** 2 > cap[2]).any():
        lengths = np.minimum(lengths, 50)
    seq, offset = packing.best_fit(lengths, cap, np.array([1.0, 0.2, 0.2]), rule)
    for s in set(seq.tolist()):
        own = lengths[seq == s]
        assert own.sum() <= 64 and len(own) <= 5 and (own ** 2).sum() <= 2500
        assert sorted(offset[seq == s]) == sorted(np.cumsum(own) - own)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([65]), cap, np.ones(3))


def test_best_fit_takes_the_tightest_sequence():
    # 6 and 5 open two sequences of 10; the 4 fits only behind the 6 without waste
    seq, _ = packing.best_fit(np.array([6, 5, 4, 4]), np.array([10, 10, 100]),
                              np.array([1.0, 0.01, 0.01]))
    assert seq.tolist() == [0, 1, 0, 1]


def test_sequences_hold_their_ids(odd, byte_tok):
    packed = packing.pack_documents(odd, keep_ids=True)
    rows = packing.sequences(packed).collect()
    assert all(len(r.ids) <= 1024 for r in rows)
    total = sum(len(byte_tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in pairs(odd))
    assert sum(len(r.ids) for r in rows) == total


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_wavelet_shards_read_back(spark, request, table, word_tok):
    docs = request.getfixturevalue(table)
    path = scratch_path(spark, "test-wavelet")
    wavelet.write_shards(docs, path, shard_tokens=700)
    shards = wavelet.read_shards(spark, path)
    assert shards.count() >= 3
    got = sorted(wavelet.read_documents(shards).collect(), key=lambda r: r.start)
    # ascending doc_id (nulls first), gapless, all ids right
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    want = collections.Counter(
        (i, tuple(word_tok.encode(t, add_special_tokens=False).ids + [1])) for i, t in pairs(docs))
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    flat = [x for r in got for x in r.ids]
    for token in {flat[0], flat[len(flat) // 2], 1, 49_000}:
        assert wavelet.count_token(shards, token).first().n == flat.count(token)
    token = collections.Counter(flat).most_common(3)[2][0]
    assert sorted(r.position for r in wavelet.find_token(shards, token).collect()) == [
        i for i, x in enumerate(flat) if x == token]
    places = [0, 5, len(flat) // 3, len(flat) - 1]
    at = spark.createDataFrame([(p,) for p in places], "position long")
    assert {r.position: r.token for r in wavelet.tokens_at(shards, at).collect()} == {
        p: flat[p] for p in places}


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 3000])
def test_wavelet_matrix(n):
    rnd = np.random.default_rng(n)
    ids = rnd.integers(0, 40, n).astype(np.uint16)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, 6).to_bytes())
    assert (m.decode() == ids).all() and (m.access(np.arange(n)) == ids).all()
    for t in (0, 7, 39, 41, 63, 64):
        assert m.count(t) == (ids == t).sum()
        assert m.occurrences(t).tolist() == np.flatnonzero(ids == t).tolist()
        assert m.count(t, n // 3, n // 2) == (ids[n // 3:n // 2] == t).sum()


def random_texts(alphabet, n, length, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(length)) for _ in range(n)]


def test_word_encoder_equals_the_library(word_tok):
    alphabet = ["a", "B", "'", "é", "́", " ", ".", "\n", "\t", "1", "٣", "ß", "Σ", "İ", "k",
                "<|endoftext|>", "x", "日", "\xa0", "\x1c"]
    texts = ["", " ", "It's 'sx ''s don't", "K Å ﬁ", *random_texts(alphabet, 500, 50, 1)]
    enc = vocab.WordEncoder(vocab.vocabulary_path("word_bpe_49k.json"), most_words=200,
                            most_units=100)
    for lo in range(0, len(texts), 100):
        part = texts[lo:lo + 100]
        ids, n = enc.encode(pa.array(part, pa.string()))
        at = np.r_[0, np.cumsum(n)]
        for t, a, b in zip(part, at[:-1], at[1:]):
            assert ids[a:b].tolist() == word_tok.encode(t, add_special_tokens=False).ids, t


def test_byte_encoder_equals_the_library(byte_tok):
    encode = vocab.byte_encoder(vocab.vocabulary_path("byte_bpe_50k.json"))
    for t in ["", " " * 100, "a<|endoftext|>b", *random_texts("aB é\n1'日 \t", 300, 60, 2)]:
        assert encode(t).tolist() == byte_tok.encode(t, add_special_tokens=False).ids


def test_transducer_is_minimal_and_exact(byte_tok):
    path = vocab.vocabulary_path("byte_bpe_50k.json")
    merges = transducer.Merges(path)
    words = [w.encode() for w in ["walking", "talking", "walked", "talked", " the", "a", "ab"]]
    data = transducer.compile_lexicon({w: merges.merge(w) for w in words})
    lex = transducer.Lexicon(data)
    # states are equal to the distinct right languages of all prefixes
    right = {frozenset(w[len(p):] for w in words if w.startswith(p))
             for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lex.final) == len(right)
    assert lex.numbers(sorted(words)).tolist() == list(range(len(words)))
    assert lex.numbers([b"walk", b"", b"zz", b"walkings"]).tolist() == [-1] * 4
    alphabet = ["a", "B", "'", "é", " ", " ", ".", "\n", "\t", "1", " the", "<|endoftext|>", "日",
                "\xa0", "\x00"]
    texts = ["", " ", "a  b", "x" * 500, "ab" * 200, *random_texts(alphabet, 600, 40, 4)]
    for enc in (transducer.Encoder(path, lex),
                transducer.Encoder(path, transducer.Lexicon(transducer.compile_lexicon({})))):
        ids, n = enc.encode(pa.array(texts, pa.string()))
        at = np.r_[0, np.cumsum(n)]
        for t, a, b in zip(texts, at[:-1], at[1:]):
            want = byte_tok.encode(t, add_special_tokens=False).ids
            assert ids[a:b].tolist() == want, t
            assert transducer.spell(ids[a:b], merges.bytes_of) == byte_tok.decode(
                want, skip_special_tokens=False)
    cut = np.array([byte_tok.encode("日", add_special_tokens=False).ids[0]])
    assert transducer.spell(cut, merges.bytes_of) == byte_tok.decode(cut.tolist())


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_transducer_round_trip(request, table, byte_tok):
    docs = request.getfixturevalue(table)
    got = collections.Counter((r.doc_id, tuple(r.ids), r.decoded)
                              for r in transducer.round_trip(docs, most=300).collect())
    want = collections.Counter()
    for i, t in pairs(docs):
        ids = byte_tok.encode(t, add_special_tokens=False).ids
        want[i, tuple(ids), byte_tok.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


def test_frequent_words_fit_their_number(sample):
    path = vocab.vocabulary_path("byte_bpe_50k.json")
    n = collections.Counter()
    import regex
    for _, t in pairs(sample):
        n.update(regex.findall(vocab.BYTE_PATTERN, t))
    few = transducer.frequent_words(sample, path, 100)
    assert 0 < len(few) <= 100
    least = min(n[w.decode()] for w in few)
    assert all(n[w] <= least * 1.1 or w.encode() in few for w in n)


def plain_base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside))


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_fertility(request, table):
    import sentencepiece
    docs = request.getfixturevalue(table)
    sp = sentencepiece.SentencePieceProcessor(
        model_file=vocab.vocabulary_path("piece_bpe_32k.model"))
    got = collections.Counter()
    for r in fertility.measure(docs).collect():
        got[r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
            r.base_failed, r.n_tokens] += 1
        assert not (r.base_failed and r.kept)
        assert r.n_tokens == 0 or 0 <= r.byte_share <= 1
    want = collections.Counter()
    for i, t in pairs(docs):
        n, *rest = plain_base(t)
        want[(i, n, *rest, n < 10 or 100 * rest[3] > 20 * n, len(sp.encode(t)))] += 1
    assert got == want
    kept = fertility.quality_filter(docs)
    assert kept.schema == docs.schema


def test_fertility_keeps_clean_documents_and_rejects_odd_ones(spark):
    clean = ("The committee met on Tuesday and agreed that the bridge should be repaired before "
             "winter, although some members asked for a second estimate of the cost.")
    rows = [(1, clean, "en"), (2, " ".join("###$$$%%%&&&" for _ in range(40)), "en"),
            (3, "ab " * 200, "en"), (4, " ".join("ҧҩҵԥԝ" for _ in range(40)), None),
            (5, " ".join(f"qz{i}xj%kv" for i in range(60)), "en")]
    got = {r.doc_id: r.kept for r in fertility.measure(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1] and not got[3] and not got[5] and not got[2]


def test_measures_by_hand():
    ids = np.array([1, 1, 2, 3])
    is_byte = np.array([False, False, True, False])
    chars, share, entropy = fertility.token_measures("abcdefgh", ids, is_byte)
    assert (chars, share) == (2.0, 0.25) and abs(entropy - 1.5) < 1e-12
    assert fertility.token_measures("", np.zeros(0, int), is_byte) == (None, None, None)
    assert fertility.script_of("hello wörld") == "latin" and fertility.script_of("привет") == "other"


@pytest.mark.parametrize("run", [
    packing.pack_documents, transducer.round_trip, fertility.measure, fertility.quality_filter])
def test_empty_tables(none, run):
    assert run(none).collect() == []


def test_empty_table_has_no_shards(spark, none):
    path = scratch_path(spark, "test-none")
    wavelet.write_shards(none, path)
    assert wavelet.document_digests(wavelet.read_shards(spark, path)).collect() == []
