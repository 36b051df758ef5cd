"""Quality rules (operator 4): tokeniser fertility with bands per language or script.

Every text gets base counts and, per public vocabulary, three measures:

* characters per token of each vocabulary (``chars_per_token``);
* the share of byte-fallback tokens (a vocabulary of pieces that falls back to
  bytes spells unknown characters as bytes);
* the entropy of the token distribution, in bits per token.

A document is rejected when a measure leaves the band of its language, or, if
its language has none, the band of its dominant script.  Bands say what text
of a kind can look like at all; they are wide on purpose, so ordinary
documents stay.  Entropy needs tokens to be measured, so its band holds from
``ENTROPY_TOKENS`` tokens on.

Defined cases: a null or empty text has no words: all counts are 0, the
measures are null and it fails the base rule; a null or unknown language
takes its script's band; repeated rows get equal rows; an empty table gives
no rows.  Columns of the input beside doc_id, text and lang are not read by
:func:`measure`; :func:`quality_filter` returns exactly the input's columns.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import documents
from tastemesh.llm.vocab import byte_encoder, once_per_worker, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The six ASCII white-space characters and the symbol class.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
ENTROPY_TOKENS = 64

#: (chars_per_token low, high), byte share high, (entropy low, high), tokens per word high.
#: Alphabets with spaces cut words into pieces of one to eight characters.
BANDS = {
    "en": ((1.5, 8.0), 0.20, (3.0, 13.0), 3.4),
    "de": ((1.4, 8.0), 0.20, (3.0, 13.0), 3.6),
    "fr": ((1.3, 8.0), 0.20, (3.0, 13.0), 3.6),
    "es": ((1.3, 8.0), 0.20, (3.0, 13.0), 3.8),
}
SCRIPT_BANDS = {
    "latin": ((1.3, 8.0), 0.25, (3.0, 13.0), 4.5),
    "other": ((0.2, 8.0), 0.98, (1.5, 13.0), None),   # few pieces, mostly bytes; often no spaces
}


def script_of(text: str) -> str:
    """``latin`` if most letters of the text are Latin, else ``other``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    latin = int(((codes | 32) - 97 < 26).sum() + ((codes >= 0xC0) & (codes < 0x250)).sum())
    wide = np.unique(codes[codes >= 0x250], return_counts=True)
    letters = sum(int(n) for c, n in zip(*wide) if unicodedata.category(chr(c))[0] == "L")
    return "latin" if latin >= letters else "other"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    # bytes.split() splits at exactly the six ASCII white-space bytes
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    n = len(words)
    if n < WINDOW:
        return n, chars, symbols, dup_lines, 0
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    windows = list(zip(ids, ids[1:], ids[2:], ids[3:], ids[4:]))
    if len(set(windows)) == len(windows):
        return n, chars, symbols, dup_lines, 0
    place: dict[tuple, int] = {}
    code = np.fromiter((place.setdefault(w, len(place)) for w in windows), np.int64, len(windows))
    twice = np.bincount(code)[code] > 1
    inside = np.zeros(n, bool)
    for k in range(WINDOW):
        inside[k:n - WINDOW + 1 + k] |= twice
    return n, chars, symbols, dup_lines, int(inside.sum())


def token_measures(text: str, ids: np.ndarray, is_byte: np.ndarray) -> tuple[float, float, float]:
    """(characters per token, byte-fallback share, entropy in bits) of one text."""
    n = len(ids)
    if n == 0:
        return None, None, None
    p = np.unique(ids, return_counts=True)[1] / n
    return (len(text) / n, float(is_byte[ids].sum()) / n, float(-(p * np.log2(p)).sum()))


def verdict(measures: tuple, n_tokens: int, n_words: int, byte_chars: float | None, band: tuple
            ) -> str | None:
    """The first measure that leaves its band, or None."""
    (low, high), max_byte, (ent_low, ent_high), max_fertility = band
    chars, byte_share, entropy = measures
    if chars is None:
        return None
    if not low <= chars <= high or not low <= byte_chars <= high:
        return "chars_per_token"
    if byte_share > max_byte:
        return "byte_share"
    if n_tokens >= ENTROPY_TOKENS and not ent_low <= entropy <= ent_high:
        return "entropy"
    if max_fertility is not None and n_tokens > max_fertility * n_words:
        return "tokens_per_word"
    return None


_MEASURED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("chars_per_token", T.DoubleType()),
    T.StructField("byte_share", T.DoubleType()), T.StructField("token_entropy", T.DoubleType()),
    T.StructField("byte_chars_per_token", T.DoubleType()),
    T.StructField("script", T.StringType()), T.StructField("rejected_by", T.StringType())])


def _piece_encoder(path: str):
    def make():
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return sp, np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    return once_per_worker("pieces", path, make)


def measures_udf(piece_path: str, byte_path: str, bands: dict | None = None):
    """A pandas UDF (text, lang) -> struct of counts, measures and verdict."""
    bands = BANDS if bands is None else bands
    script_bands = SCRIPT_BANDS

    @F.pandas_udf(_MEASURED)
    def run(text: pd.Series, lang: pd.Series) -> pd.DataFrame:
        sp, is_byte = _piece_encoder(piece_path)
        encode = byte_encoder(byte_path)
        rows = []
        for t, language in zip(text, lang):
            t = t or ""
            n, chars, symbols, dup, repeat = base_counts(t)
            failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
            ids = np.array(sp.encode(t), dtype=np.int64)
            measures = token_measures(t, ids, is_byte)
            n_byte = len(encode(t))
            byte_chars = len(t) / n_byte if n_byte else None
            script = script_of(t)
            band = bands.get(language) or script_bands[script]
            why = "base" if failed else verdict(measures, len(ids), n, byte_chars, band)
            rows.append((n, chars, symbols, dup, repeat, failed, why is None, len(ids),
                         *measures, byte_chars, script, why))
        out = pd.DataFrame(rows, columns=_MEASURED.names)
        return out.astype({c: "float64" for c in ("chars_per_token", "byte_share",
                                                  "token_entropy", "byte_chars_per_token")})
    return run


def _measured(docs: DataFrame, text_col: str, lang_col: str | None, piece_path: str | None,
              byte_path: str | None, bands: dict | None):
    run = measures_udf(piece_path or vocabulary_path("piece_bpe_32k.model"),
                       byte_path or vocabulary_path("byte_bpe_50k.json"), bands)
    lang = docs[lang_col].cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return run(docs[text_col].cast("string"), lang)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str | None = "lang", piece_path: str | None = None,
            byte_path: str | None = None, bands: dict | None = None) -> DataFrame:
    """doc_id, the base counts, the measures and the verdict of every document."""
    m = _measured(docs, text_col, lang_col, piece_path, byte_path, bands)
    return docs.select(F.col(id_col).alias("doc_id"), m.alias("m")).select("doc_id", "m.*")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang",
                   **options) -> DataFrame:
    """The documents that :func:`measure` keeps, with all columns of the input."""
    m = _measured(docs, text_col, lang_col, options.get("piece_path"), options.get("byte_path"),
                  options.get("bands"))
    return docs.filter(m["kept"])


def op4_tokeniser_fertility(spark, sf_dir: str) -> DataFrame:
    return measure(documents(spark, sf_dir))
