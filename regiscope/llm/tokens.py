"""Token counts: Arrow batches in, lengths out.

A word between white space is encoded once per Python worker and remembered
(bounded), because the vocabulary's pre-tokenizer never joins two words. Its
plain part (Latin letters with punctuation around them) goes to the tokenizer's
own BPE model; any other word goes through the whole tokenizer. Texts holding
characters on which Python and the tokenizer disagree about white space are
encoded whole. Other tokenizer files are encoded text by text.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, lists

#: Words and word parts remembered by a worker; all are forgotten when there are more.
REMEMBERED_WORDS, REMEMBERED_PARTS = 500_000, 800_000
#: White space for Python's split() but not for the tokenizer, or the reverse.
_ODD_SPACE = re.compile("[\\x1c-\\x1f\\u180e\\ufeff\\u200b]").search
_NOT_LATIN = re.compile("[^\x00-\xff]").search
_PLAIN = re.compile(r"""([.,;:!?()"\-*#%&$/]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?()"\-*#%&$/]*)""").fullmatch
#: Byte-level alphabet: a printable Latin-1 byte is its own character, the
#: others follow from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
#: The normaliser and pre-tokenizer for which words may be encoded one by one.
_BY_WORD = (
    '{"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\\\s+"}, '
    '"content": " "}, {"type": "Lowercase"}]}',
    '{"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": '
    '"\'s|\'t|\'re|\'ve|\'m|\'ll|\'d|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+"}, "behavior": "Removed", '
    '"invert": true}, {"type": "ByteLevel", "add_prefix_space": false, "trim_offsets": true, "use_regex": false}]}')


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(text: str, limit: int = CHUNK_BYTES) -> Iterator[str]:
    """Cut a long text at white space into pieces of about ``limit``
    characters; a single longer word stays whole."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class WordIds(dict):
    """Word -> its token ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        #: Found in the raw text, case-sensitively, before it is lower-cased.
        self.added = [t["content"].lower() for t in conf.get("added_tokens") or ()]
        self.by_word = (json.dumps(conf.get("normalizer")), json.dumps(conf.get("pre_tokenizer"))) == _BY_WORD

    def whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        return [np.asarray(x.ids, "<u4").tobytes()
                for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            chars = s if s.isascii() else s.encode().decode("latin-1").translate(_BYTE_CHARS)
            ids = [t.id for t in self.model.tokenize(chars)]
            got = self.parts[s] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def _run(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            got = self.parts[s] = self.whole([s])[0]
        return got

    def __missing__(self, w: str) -> bytes:
        if w.isalpha() and (w.isascii() or not _NOT_LATIN(w)):
            got = self._letters(w.lower())
        elif m := _PLAIN(w):
            got = self._letters(m[2].lower())
            if m[1]:
                got = self._run(m[1]) + got
            if m[3]:
                got += self._run(m[3])
        else:
            got = self.whole([w])[0]
        self[w] = got
        return got

    def _by_words(self, text: str) -> bytes:
        if text.isascii() or not _NOT_LATIN(text):
            low = text.lower()  # one character each here, as in the tokenizer
            if not any(t in low for t in self.added):
                text = low
        return b"".join(map(self.__getitem__, text.split()))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text, NULL as the empty text."""
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        if len(self.parts) > REMEMBERED_PARTS:
            self.parts.clear()
        texts = [t or "" for t in texts]
        apart = [not self.by_word or bool(_ODD_SPACE(t)) for t in texts]
        whole = iter(self.whole([t for t, a in zip(texts, apart) if a]))
        return [next(whole) if a else self._by_words(t) if len(t) <= CHUNK_BYTES
                else b"".join(self._by_words(p) for p in pieces(t)) for t, a in zip(texts, apart)]


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's one encoder for ``path``."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def _counter(path: str):
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode([t or "" for t in texts], num_threads=1)]
    known = word_ids(path)
    return lambda texts: [len(b) // 4 for b in known.ids(texts)]


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``df``.

    ``n_tokens`` is what the vocabulary's library gives without special tokens
    around the text, truncation or padding. A NULL text counts as empty (0
    bytes, 0 tokens), repeated rows are counted each, other columns are not
    read, an empty table gives no rows. Inside a task the Arrow batches are
    recut into ranges of about 1 MB of text and longer texts at white space,
    so memory does not follow the longest run of rows."""
    path = vocabulary or default_vocabulary()
    key = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, key), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        count = _counter(path)
        for b in batches:
            sizes = pc.fill_null(pc.cast(pc.binary_length(b.column(1)), pa.int64()), 0)
            n: list[int] = []
            for part in lists(b, "__text"):
                n += count(part["__text"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=schema.names)

    return df.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


__all__ = ["count_tokens", "word_ids", "pieces", "default_vocabulary"]
