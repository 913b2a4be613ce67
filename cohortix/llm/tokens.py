"""Whole texts to token ids with a public tokenizer, remembering the pieces already seen.

A space after a non-space ends a token in both public tokenizers used here, so what lies
between such spaces encodes on its own. Each worker keeps the ids of the pieces it has met
in a table of two generations of bounded size and gives the tokenizer only new ones; pieces
that were met in the last generation move on to the next. A plain word with
punctuation behind it is cut by any of the two into the word and the punctuation, so these
go to the tokenizer's model directly, without its pattern and offsets.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortix.llm.common import sole_cache

CACHE_PIECES = 400_000  # of both generations
CACHE_TAILS = 10_000
GATHERED = 1 << 16
_inner_space = re.compile(r"\s ")
# Latin-1 letters, then ASCII punctuation but the apostrophe, which contractions begin with
_letter, _mark = "[A-Za-zªµºÀ-ÖØ-öø-ÿ]", r"[!-&(-/:-@\[-`{-~]"
_plain = re.compile(f"({_letter}+)({_mark}*)")
_plain_named = f"^(?P<word>{_letter}+)(?P<tail>{_mark}*)$"


def byte_letters() -> dict[int, str]:
    """The characters by which byte-level models write bytes: printable ones stay, others move up from 256."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in stay]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(moved)}


_letters = byte_letters()


def _as_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_letters)


def _listed(strings: pa.Array) -> list[str]:
    """``to_pylist`` of strings without a null, in a fraction of its time."""
    return strings.to_numpy(zero_copy_only=False).tolist()


_encoders: dict[str, Encoder] = {}


class Encoder(dict):
    """``encode`` returns, per text, its ids as little-endian unsigned 32-bit integers.

    As a dictionary it holds the ids of the pieces met, each with the space before it.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # strings that are tokens of their own wherever they stand; texts with one are encoded whole
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = self.tokenizer.model.tokenize
        self.before: dict[str, bytes] = {}  # the last generation
        self.tails: dict[str, bytes] = {"": b""}
        shape = json.loads(self.tokenizer.to_str())
        before, rule = shape["pre_tokenizer"], shape["normalizer"]
        self.keeps_space = before.get("type") == "ByteLevel" and rule is None
        self.lowers = "Lowercase" in json.dumps(rule) and "Split" in json.dumps(before)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The texts together: a piece that comes in many of them is looked up once."""
        out: list[bytes | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if any(mark in text for mark in self.marks):
                out[i] = self._text_ids(text)
            elif text.startswith(" ") or _inner_space.search(text):
                first, *rest = self._pieces(text)
                out[i] = self._text_ids(first) + b"".join(map(self.__getitem__, rest))
            else:
                plain.append(i)
        for i, ids in zip(plain, self._encode_plain([texts[i] for i in plain])):
            out[i] = ids
        return out

    def _encode_plain(self, texts: list[str]) -> Iterator[bytes]:
        """Texts whose spaces all follow a non-space, cut at every space, and plain words from what stands behind them."""
        if not texts:
            return
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begun = parts.offsets.to_numpy()
        first = [text.split(" ", 1)[0] for text in texts]
        pieces = parts.flatten().dictionary_encode()
        place = pieces.indices.to_numpy().astype(np.int64)
        ids, word, tail = self._ids_of(pieces.dictionary)
        # two entries of ids a piece; the first piece of a text has no space before it and an entry of its own
        entries = np.stack([word[place], tail[place]], axis=1)
        entries[begun[:-1]] = np.stack([len(ids) + np.arange(len(texts)), np.zeros(len(texts), np.int64)], axis=1)
        ids += [self._text_ids(p) for p in first]
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start, flat = np.cumsum(length) - length, np.frombuffer(b"".join(ids), "<u4")
        # as many texts at a time as have GATHERED pieces
        cuts = np.flatnonzero(np.diff(begun[1:] // GATHERED)) + 1
        for some in np.split(np.arange(len(texts)), cuts):
            a, b = begun[some[0]], begun[some[-1] + 1]
            taken = entries[a:b].ravel()
            each = length[taken]
            ends = np.cumsum(each)
            shift = start[taken] - (ends - each)
            whole = flat[np.repeat(shift, each) + np.arange(ends[-1])]
            upto = [0, *ends[2 * (begun[some + 1] - a) - 1].tolist()]
            for begin, end in zip(upto, upto[1:]):
                yield whole[begin:end].tobytes()

    def _ids_of(self, pieces: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of different pieces as entries of a list: for each piece the entry of its word and that of its tail.

        The first entry is empty. What is no plain word with punctuation is an entry as a whole.
        """
        if not (self.keeps_space or self.lowers):
            return [b"", *map(self.__getitem__, _listed(pieces))], 1 + np.arange(len(pieces)), np.zeros(len(pieces), np.int64)
        split = pc.extract_regex(pieces, _plain_named)
        other = split.is_null()
        words, tails = (split.field(i).dictionary_encode() for i in range(2))
        word, tail = (d.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for d in (words, tails))
        ids = [b""]
        word += len(ids)
        ids += self._words_ids(_listed(words.dictionary))
        tail += len(ids)
        ids += map(self._tail_ids, _listed(tails.dictionary))
        at = np.flatnonzero(other.to_numpy(zero_copy_only=False))
        word[at], tail[at] = len(ids) + np.arange(len(at)), 0
        ids += map(self.__getitem__, _listed(pieces.filter(other)))
        return ids, word, tail

    def _words_ids(self, words: list[str]) -> list[bytes]:
        if len(self) >= CACHE_PIECES // 2:
            self._age()
        found = list(map(self.get, words))
        before, cut, space = self.before.get, self._cut_ids, "Ġ" if self.keeps_space else None
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = before(word)
            if ids is None:
                if word.isascii():
                    ids = cut(space + word if space else word.lower())
                else:
                    ids = self._word_ids(" " + word if space else word)
            self[word] = found[i] = ids
        return found

    def _age(self) -> None:
        self.before = dict(self)
        self.clear()

    def _pieces(self, text: str) -> list[str]:
        """The text cut at spaces that follow a non-space; those spaces are left out."""
        out = text.split(" ")
        joined = out[:1]
        for p in out[1:]:
            if not joined[-1] or joined[-1][-1].isspace():
                joined[-1] += " " + p
            else:
                joined.append(p)
        return joined

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES // 2:
            self._age()
        ids = self.before.get(piece)
        if ids is None:
            ids = self._piece_ids(piece)
        self[piece] = ids
        return ids

    def _piece_ids(self, piece: str) -> bytes:
        if not (self.keeps_space or self.lowers):
            return self._text_ids(" " + piece)
        if "\n" in piece:
            return self._line_ids(piece)
        if piece.isascii() and piece.isalpha():  # its bytes and its characters are the same
            return self._cut_ids("Ġ" + piece if self.keeps_space else piece.lower())
        plain = _plain.fullmatch(piece)
        if plain is None:
            return self._text_ids(" " + piece)
        word, tail = plain.groups()
        if tail:  # the word alone is met with other punctuation too
            return self[word] + self._tail_ids(tail)
        return self._word_ids(" " + word if self.keeps_space else word)

    def _line_ids(self, piece: str) -> bytes:
        """A piece that goes over line ends: a single one between plain words stands alone."""
        first, *rest = piece.split("\n")
        later = [_plain.fullmatch(p) for p in rest]
        if None in later or not _plain.fullmatch(first):
            return self._text_ids(" " + piece)
        end = self._tail_ids("\n") if self.keeps_space else b""
        return self[first] + b"".join(end + self._line_word(p[1]) + self._tail_ids(p[2]) for p in later)

    def _line_word(self, word: str) -> bytes:
        """A word at the beginning of a line, remembered under a key that is no piece's."""
        if not self.keeps_space:
            return self[word]
        key = "\n" + word
        ids = self.get(key) or self.before.get(key)
        if ids is None:
            self[key] = ids = self._word_ids(word)
        return ids

    def _word_ids(self, word: str) -> bytes:
        return self._cut_ids(_as_bytes(word.lower() if self.lowers else word))

    def _tail_ids(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) >= CACHE_TAILS:
                self.tails = {"": b""}
            self.tails[tail] = self._cut_ids(_as_bytes(tail))
        return self.tails[tail]

    def _cut_ids(self, written: str) -> bytes:
        return array("I", [t.id for t in self.cut(written)]).tobytes()

    def _text_ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def encoder(path: str) -> Encoder:
    sole_cache("tokens", _encoders.clear)
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
