"""Token ids and token bytes of two kinds of public vocabularies.

``ByteBpe`` reads a byte-level BPE of the ``tokenizers`` library. Its merges are
also run by ``tiktoken``, which is quicker, where that gives the same ids: the
merges stand in the order of their ids, and every token, encoded alone, is that
token. (Two neighbours whose letters make up a token are then always the pair of
its merge: what happened inside them is what happens to the token alone.) Other
vocabularies, and texts with special strings that count, use ``tokenizers``.

``PieceBpe`` reads a ``sentencepiece`` model; it puts a space before a text.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed values of byte-level vocabularies: these bytes stand for themselves, the others for the letters from 256 on, in order.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _OWN} | {chr(n): b for n, b in enumerate((b for b in range(256) if b not in _OWN), 256)}


class Vocabulary:
    """Bytes of the tokens, in a row."""

    def __init__(self, entries: dict[int, bytes]):
        self.size = max(entries) + 1
        self.lengths = np.zeros(self.size, np.int64)
        for i, b in entries.items():
            self.lengths[i] = len(b)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(entries.get(i, b"") for i in range(self.size)), np.uint8)

    def text(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for, joined."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(total)]


class ByteBpe:
    """``special``: strings of special tokens in a text count as these; otherwise they are plain text."""

    def __init__(self, path: str, special: bool):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        words = kind["model"]["vocab"]
        added = {t["content"]: t["id"] for t in kind.get("added_tokens", [])}
        self.special = list(added) if special else []
        pre, model = kind.get("pre_tokenizer") or {}, kind["model"]
        byte_level = pre.get("type") == "ByteLevel"
        own = {i: bytes(_BYTE[c] for c in w) for w, i in words.items() if w not in added} if byte_level else {i: w.encode() for w, i in words.items()}
        self.vocabulary = Vocabulary(own | {i: w.encode() for w, i in added.items()})
        plain = byte_level and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not any(
            kind.get(k) for k in ("normalizer", "truncation", "padding")) and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        merged = [words["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])] if plain else []
        if plain and merged == sorted(set(merged)) and all(
                [t.id for t in self.tokenizer.model.tokenize(w)] == [i] for w, i in words.items() if w not in added):
            import tiktoken

            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={b: i for i, b in own.items()}, special_tokens={})
        else:
            self.quick = None

    def ids(self, text: str) -> list[int]:
        if self.quick and not any(s in text for s in self.special):
            return self.quick.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceBpe:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                entries[i] = bytes([int(piece[1:-1], 16)])
            else:
                entries[i] = piece.replace("▁", " ").encode()
        self.vocabulary = Vocabulary(entries)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_LOADED: dict[tuple, ByteBpe | PieceBpe] = {}


def byte_bpe(path: str, special: bool) -> ByteBpe:
    """One for each worker process."""
    key = (path, special)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(path, special)
    return _LOADED[key]


def piece_bpe(path: str) -> PieceBpe:
    if (path,) not in _LOADED:
        _LOADED[(path,)] = PieceBpe(path)
    return _LOADED[(path,)]
