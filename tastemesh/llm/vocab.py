"""Encoders over public vocabulary files, for use inside Spark tasks.

Every encoder is made once per Python worker and takes the path of its
vocabulary file as a parameter; nothing is trained or copied.
"""

from __future__ import annotations

import json
import os
import sys
import types
import unicodedata

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the pre-tokenizer pattern of the byte-level vocabulary.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                r"|\s+(?!\S)|\s+")


_CACHE_MODULE = "_tastemesh_worker_cache"


def once_per_worker(kind: str, name: str, make):
    """``make()``, kept for the life of this Python process, one per ``kind``: another
    ``name`` replaces it.

    Functions of this package reach Python workers by value, so their module
    globals are made anew for every task; an entry of ``sys.modules`` stays.
    """
    kept = sys.modules.setdefault(_CACHE_MODULE, types.ModuleType(_CACHE_MODULE)).__dict__
    if kept.get(kind, (None,))[0] != name:
        kept[kind] = (name, make())
    return kept[kind][1]


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, as byte-level vocabularies spell
    bytes: printable Latin-1 characters stand for themselves, the other bytes
    take the code points from 256 on, in order."""
    shown = [b for b in range(256)
             if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(bytes -> id, special text -> id) of a byte-level BPE JSON file.  Ids of
    such a vocabulary follow merge order, so an id is also a merge rank."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in tok): i
             for tok, i in spec["model"]["vocab"].items() if tok not in special}
    return ranks, special


def hf_tokenizer(path: str):
    """The tokenizers library over ``path``, without truncation and padding."""
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok
    return once_per_worker(f"hf {path}", path, make)


def byte_encoder(path: str):
    """text -> uint32 ids of the byte-level vocabulary at ``path``.

    tiktoken runs the same merges of the same file about five times as fast as
    the tokenizers library; texts on which its regex engine gives up (a run of
    a million spaces) go to the tokenizers library.
    """
    def make():
        import tiktoken
        ranks, special = byte_vocabulary(path)
        return tiktoken.Encoding("byte_bpe", pat_str=BYTE_PATTERN, mergeable_ranks=ranks,
                                 special_tokens=special)
    enc = once_per_worker("tiktoken", path, make)

    def encode(text: str) -> np.ndarray:
        try:
            return enc.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(hf_tokenizer(path).encode(text, add_special_tokens=False).ids,
                            dtype=np.uint32)
    return encode


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start:start + size]``, one behind the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(start - (ends - size), size)
    at += np.arange(total)
    return flat[at]


class Stretches:
    """Keys with a stretch of ids each, in flat arrays."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def add(self, keys: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.index)
        self.index.update(zip(keys, range(n, n + len(keys))))
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, ids]

    def places(self, keys, n: int) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, n)


class WordEncoder:
    """Batch encoder over a vocabulary with word ends, whose tokens never cross
    white space: the tokenizers library's ids at a fraction of its calls.

    A batch's distinct blank-separated words are found by Arrow.  Words that are
    not yet known are cut into the units of the vocabulary's own pattern, and
    only units not yet known go to the tokenizers library, many as one text
    (each ends at an id that closes a word).  Words beyond plain composed Latin,
    or with a special token, go to the library whole, as one text cut again by
    its offsets.  Past ``most_words`` and ``most_units`` the caches are emptied.
    """

    def __init__(self, path: str, most_words: int = 1_000_000,
                 most_units: int = 1_000_000):
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tok, self.most_words, self.most_units = hf_tokenizer(path), most_words, most_units
        # the same model for units, which are normalised and cut already
        self.cut_tok = Tokenizer.from_file(path)
        self.cut_tok.normalizer = normalizers.Sequence([])
        self.cut_tok.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        # no unit holds a blank, so blanks can be listed among the units
        self.units_of = regex.compile(split["pattern"]["Regex"] + "| ").findall
        self.marks = [t["content"][:2] for t in spec["added_tokens"]]
        end, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.closes = np.zeros(1 + max(vocab.values()), bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(end)]] = True
        self.words, self.units = Stretches(), Stretches()
        self._no_units()

    def _no_units(self) -> None:
        self.units = Stretches()
        self.units.add([" "], np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _plain(self, text: str) -> bool:
        return (max(text, default="") < "\u0250" and not any(m in text for m in self.marks)
                and (text.isascii() or unicodedata.is_normalized("NFC", text)))

    def _learn_units(self, units: list[str]) -> None:
        enc = self.cut_tok.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0]
        ids = np.array(enc.ids, dtype=np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(units):
            raise ValueError("units and word ends differ in number")
        self.units.add(units, ids, np.diff(np.r_[0, ends]))

    def _learn(self, words: list[str]) -> None:
        plain = words if self._plain(" ".join(words)) else [w for w in words if self._plain(w)]
        if plain:
            units = self.units_of(" ".join(plain).lower() + " ")
            known = self.units.index
            new = [u for u in dict.fromkeys(units) if u not in known]
            if new:
                self._learn_units(new)
            at = self.units.places(units, len(units))
            size = self.units.size[at]
            upto = np.cumsum(size)[np.flatnonzero(at == 0)]     # at the blank behind a word
            self.words.add(plain, gather(self.units.flat, self.units.start[at], size),
                           np.diff(np.r_[0, upto]))
        other = [] if plain is words else [w for w in words if w not in self.words.index]
        if other:
            enc = self.tok.encode(" ".join(other), add_special_tokens=False)
            begin = np.fromiter((o[0] for o in enc.offsets), np.int64, len(enc.ids))
            ends = np.cumsum(np.fromiter((len(w) + 1 for w in other), np.int64, len(other)))
            upto = np.searchsorted(begin, ends)
            self.words.add(other, np.array(enc.ids, dtype=np.uint32), np.diff(np.r_[0, upto]))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, number of ids per text); ``texts`` is an
        Arrow string array without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.words.index) > self.most_words:
            self.words = Stretches()
        if len(self.units.index) > self.most_units:
            self._no_units()
        lists = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "),
                                 " ")
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.words.index
        new = [w for w in distinct if w not in known]
        if new:
            self._learn(new)
        at = self.words.places(distinct, len(distinct))[coded.indices.to_numpy()]
        size = self.words.size[at]
        ids = gather(self.words.flat, self.words.start[at], size)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n)]]
        return ids, np.diff(upto)
