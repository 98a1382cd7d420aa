"""Token ids by a public tokenizer file, with a memo per word, so that a word is encoded once and not each time it occurs."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from tidewell.llm._common import words_of

END_ID = 2

# The normaliser and split of a tokenizer file by which a word's ids don't depend on the words around it.
NORMALISER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: Letters that NFC leaves alone and that lower-case to one letter, and printable ASCII: such words are split here.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ňŊ-ž]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")


def by_words(spec: dict) -> bool:
    """Whether a tokenizer file (its JSON) has just the normaliser and split above, and added tokens that match as they stand."""
    loose = ("single_word", "lstrip", "rstrip", "normalized")
    added = all(not any(t[k] for k in loose) and not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    plain = not any(spec[k] for k in ("truncation", "padding", "post_processor"))
    return added and plain and spec["normalizer"] == NORMALISER and spec["pre_tokenizer"] == SPLIT


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level BPE writes bytes: printable Latin-1 as it is, the others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


class Encoder(dict):
    """Word (UTF-8, no white space) to its slot in a table of ids; ids are the library's with add_special_tokens=False.

    For a file whose split never crosses white space (``by_words``) a text's ids are those of its words in order. Beyond
    ``memo`` words a new table begins, and the full one stays beside it until that is full in turn: words that come again
    are taken over from it, which never changes the ids. A word that holds an added token's string goes to the library, as
    do words beyond plain letters. Any other file encodes whole texts by the library. ``pieces``
    (``memo`` if 0) bounds the memo of parts of words in the same way.
    """

    def __init__(self, path: str, memo: int = 400_000, pieces: int = 0) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        spec = json.loads(self.full.to_str())
        self.by_words = by_words(spec)
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)").search
        self.bare = not any(t["content"].isalpha() for t in spec["added_tokens"])  # no word of letters holds one
        self.model, self.memo, self.most_pieces, self.letters = self.full.model, memo, pieces or memo, _byte_letters()
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("q")
        self.pieces: dict[str, bytes] = {}  # ids as they lie in the table
        self.old_pieces: dict[str, bytes] = {}
        self._start()

    def _start(self) -> None:
        self.old, self.old_ids, self.old_starts, self.old_lengths = dict(self), self.ids, self.starts, self.lengths
        self.clear()
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("q")

    def _piece(self, p: str) -> bytes:
        found = self.pieces.get(p)
        if found is None and (found := self.old_pieces.get(p)) is not None:
            self.pieces[p] = found
        elif found is None:
            if len(self.pieces) >= self.most_pieces:
                self.pieces, self.old_pieces = {}, self.pieces
            written = p if p.isascii() else p.encode().decode("latin1").translate(self.letters)
            found = self.pieces[p] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return found

    def _encoded(self, word: bytes) -> bytes:
        if self.bare and word.isalpha():  # ASCII
            return self._piece(word.lower().decode())
        s = word.decode("utf-8", "replace")
        if (s.isascii() and s.isprintable() or _PLAIN.fullmatch(s)) and not self.added(s):
            s = s.lower()
            return self._piece(s) if s.isalpha() else b"".join(map(self._piece, _PIECE.findall(s)))
        return array("I", self.full.encode(s, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self.starts)
        self.starts.append(len(self.ids))
        known = self.old.get(word)
        if known is None:
            self.ids.frombytes(self._encoded(word))
        else:
            begin = self.old_starts[known]
            self.ids.extend(self.old_ids[begin : begin + self.old_lengths[known]])
        self.lengths.append(len(self.ids) - self.starts[slot])
        return slot

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts, each text closed by the end id, and the number of ids of each text."""
        if not self.by_words:
            whole = [x.ids for x in self.full.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
            return np.fromiter(
                (i for x in whole for i in (*x, END_ID)), np.uint32,
            ), np.fromiter((len(x) + 1 for x in whole), np.int64, len(whole))
        codes, distinct, ends = words_of(texts)
        if len(self) > self.memo:
            self._start()
        slots = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[codes] if len(distinct) else codes
        starts, sizes = np.array(self.starts, np.int64), np.array(self.lengths, np.int64)
        lengths = sizes[slots] if len(slots) else np.zeros(0, np.int64)
        upto = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(lengths, out=upto[1:])
        kind = np.int32 if max(upto[-1], len(self.ids)) < 1 << 31 else np.int64
        at = np.repeat(((starts[slots] if len(slots) else lengths) - upto[:-1]).astype(kind), lengths)
        at += np.arange(upto[-1], dtype=kind)
        ids = np.array(self.ids, np.uint32)[at] if upto[-1] else np.zeros(0, np.uint32)
        stops = upto[ends[1:]]
        return np.insert(ids, stops, np.uint32(END_ID)), np.diff(upto[ends]) + 1


_ENCODERS: dict[tuple[str, int, int], Encoder] = {}


def encoder(path: str, memo: int = 400_000, pieces: int = 0) -> Encoder:
    """The one encoder of a worker process, kept between tasks until one with another file or memo is asked for."""
    key = path, memo, pieces
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
