"""Byte-level BPE ids of whole texts, every distinct piece of a batch encoded once.

The splitting rule of byte-level vocabularies never joins a character with a following blank, and a
single blank between two characters that are no white space always begins the next token. So a text
may be cut there, and every piece has the same ids alone as in its text. The texts of a batch are
cut in Arrow, their distinct pieces encoded in one call and the ids gathered by piece.

Pieces are encoded by tiktoken from the vocabulary of the given tokenizers file, which is several
times faster and gives the same ids when the file is plain byte-level BPE with merges in the order
of their ids. That is checked on loading; any other file is left to tokenizers itself.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the splitting rule of byte-level BPE vocabularies.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as bytes, or None if it is not plain byte-level BPE."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, before = made["model"], made.get("pre_tokenizer") or {}
    plain = (
        made.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and model.get("type", "BPE") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not model.get("ignore_merges")
    )
    if not plain:
        return None
    vocab = model["vocab"]
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(order, order[1:])):
        return None
    special = {t["content"] for t in made.get("added_tokens", [])}
    symbols = _bytes_of_symbols()
    return {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t not in special}


class Tokens:
    """Ids of texts as ``dtype``; nothing is kept from one call to the next."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A control string inside a text is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 2**16 else "<u4")
        ranks = _ranks(path)
        self.cut = ranks is not None
        if self.cut:
            import tiktoken

            made = tiktoken.Encoding("pieces", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.ordinary = made.encode_to_numpy
            self.opens = np.zeros(max(ranks.values()) + 1, bool)
            self.opens[[i for symbol, i in ranks.items() if symbol.startswith(b" ")]] = True

    def _encoded(self, text: str) -> np.ndarray:
        return self.ordinary(text).astype(self.dtype)

    def one(self, text: str) -> np.ndarray:
        if self.cut:
            return self._encoded(text)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), one text after another, and how many each has."""
        if not self.cut:
            return _joined([self.one(t or "") for t in texts.to_pylist()], self.dtype)
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        count = np.diff(lists.offsets.to_numpy())
        pieces = lists.flatten()
        coded = pieces.dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary
        bare = pc.equal(pc.utf8_trim_whitespace(distinct), distinct)
        regular = pc.and_(bare, pc.not_equal(distinct, "")).to_numpy(zero_copy_only=False)
        ids, size = self._behind_blank(distinct, regular)
        # A text's first piece has no blank before it; a text with white space beside a blank, or with
        # a blank at an end, is not cut at all.
        whole = np.minimum.reduceat(regular[code], first) if len(first) else np.zeros(0, bool)
        starts = np.cumsum(size) - size
        at, n = starts[code], size[code]
        own = [self.one(p) for p in pieces.take(pa.array(first[whole])).to_pylist()]
        own += [self.one(t or "") for t in texts.filter(pa.array(~whole)).to_pylist()]
        apart, apart_size = _joined(own, self.dtype)
        n[np.repeat(~whole, count)] = 0
        order = np.r_[first[whole], first[~whole]]
        n[order] = apart_size
        at[order] = len(ids) + np.cumsum(apart_size) - apart_size
        ends = np.cumsum(n)
        taken = np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return np.concatenate([ids, apart])[taken], np.add.reduceat(n, first) if len(first) else n

    def _behind_blank(self, pieces: pa.Array, regular: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the regular pieces, each behind a blank, and how many each piece has.

        All are encoded in one call: a piece has no blank of its own, so its first id is the only one
        whose bytes begin with a blank.
        """
        size = np.zeros(len(pieces), np.int64)
        wanted = pieces.filter(pa.array(regular))
        if not len(wanted):
            return np.zeros(0, self.dtype), size
        line = pa.ListArray.from_arrays(pa.array([0, len(wanted)], pa.int32()), wanted)
        ids = self._encoded(" " + pc.binary_join(line, " ")[0].as_py())
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) == len(wanted):
            size[regular] = np.diff(np.r_[starts, len(ids)])
        else:
            ids, size[regular] = _joined([self.one(" " + p) for p in wanted.to_pylist()], self.dtype)
        return ids, size


def _joined(made: list[np.ndarray], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, dtype), *made]), np.array([len(m) for m in made], np.int64)
