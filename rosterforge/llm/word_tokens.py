"""Token ids of whole texts by the tokenizers library, a word at a time.

For vocabularies whose pre-tokenizer never joins across ASCII whitespace (the
one of `word_bpe_49k.json` drops white space), a text's ids are those of its
whitespace-separated parts one after another.  The library's normaliser,
pre-tokenizer and model see every distinct part once per worker; texts are
joined from the kept ids, as bytes of little-endian unsigned 32-bit numbers.
What is kept is bounded by bytes, in two generations: a part that is met again
moves to the young one; when that is full, the old one is dropped.

Most parts are a run of Latin letters and perhaps a run of signs.  Where the
loaded tokenizer is seen to treat those as two pieces (it is tried on examples
when loaded), each piece goes straight to its model.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from itertools import filterfalse

import numpy as np

MOST_BYTES = 256 << 20
ENTRY_BYTES = 170  # two byte strings and their place in a table, without their contents
# letters of ASCII and of the Latin-1 block in UTF-8, then signs that are neither letters, digits nor apostrophes
_PLAIN = re.compile(rb"((?:[a-z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)([!-&(-/:-@\[-`{-~]*+)")
_LATIN = "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
_EXAMPLES = [b"the", b"thndhain***", b"it.", b"gr\xc3\xb6\xc3\x9fe,!!", b"\xc3\x89au\xc3\xaa|", _LATIN.encode() + b"&&&", b"a$$$", b"zzz%%%@"]
_OTHER_SPACE = re.compile(r"[^\S ]")
_LOADED: dict[tuple[str, int], WordTokens] = {}


class WordTokens:
    def __init__(self, path: str, most_bytes: int = MOST_BYTES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most_bytes = most_bytes
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the young generation
        self.pieces: dict[str, bytes] = {}
        self.spelled: dict[int, str] | None = None
        self._try_plain()

    def _try_plain(self) -> None:
        """Take the short way for plain parts if it gives the library's ids on all examples."""
        spelled = {}
        for letter in _LATIN:
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(letter))
            if len(found) != 1:
                return
            spelled[ord(letter)] = found[0][0]
        self.spelled = spelled
        for example in _EXAMPLES:
            if self._plain(example) != _bytes(self.tokenizer.encode(example.decode(), add_special_tokens=False).ids):
                self.spelled = None
                break
        self.known.clear()
        self.held = 0

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        if word not in self.known:
            self.held += ENTRY_BYTES + len(word) + len(ids)
            self.known[word] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        """Ids of letters or of signs only, which are words of their own too."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                text = piece.decode()
                # letters of ASCII are spelled as they are
                text = text if piece.isascii() else text.translate(self.spelled)
                ids = _bytes([t.id for t in self.tokenizer.model.tokenize(text)])
            self._keep(piece, ids)
        return ids

    def _plain(self, word: bytes) -> bytes | None:
        parts = _PLAIN.fullmatch(word)
        if parts is None:
            return None
        letters, signs = parts.groups()
        return self._piece(letters) + self._piece(signs) if signs else self._piece(letters)

    def encode(self, text: bytes) -> bytes:
        # special tokens are told by their exact case; elsewhere A-Z and a-z give the same ids
        parts = (text if b"<|" in text else text.lower()).split()
        found, older = self.known, self.older
        fresh = set(filterfalse(found.__contains__, parts))
        if fresh:
            again = [p for p in fresh if p in older]
            for part in again:
                self._keep(part, older.pop(part))
            self.learn(list(fresh.difference(again)))
        out = b"".join(map(found.__getitem__, parts))
        if 2 * self.held > self.most_bytes:
            self.known, self.older, self.held = {}, found, 0
            self.pieces.clear()
        return out

    def learn(self, words: list[bytes]) -> None:
        if not words:
            return
        if self.spelled is not None:
            rest = []
            for word in words:
                ids = self._plain(word)
                if ids is None:
                    rest.append(word)
                else:
                    self._keep(word, ids)
            words = rest
            if not words:
                return
        whole = [w for w in words if b"<|" in w]
        words = [w for w in words if b"<|" not in w]
        texts = [w.decode("utf-8", "replace") for w in words]
        odd = [_OTHER_SPACE.search(t) is not None for t in texts] if _OTHER_SPACE.search(" ".join(texts)) else None
        if odd:  # white space of other scripts within words
            whole += [w for w, o in zip(words, odd, strict=True) if o]
            words = [w for w, o in zip(words, odd, strict=True) if not o]
            texts = [t for t, o in zip(texts, odd, strict=True) if not o]
        normal = self.tokenizer.normalizer.normalize_str(" ".join(texts))
        parts = normal.split(" ")
        for word in whole:
            self._keep(word, _bytes(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids))
        if not words:
            return
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        owner = np.searchsorted(begins, [at for _, (at, _) in found], side="right") - 1
        ids: list[list[bytes]] = [[] for _ in words]
        pieces, model = self.pieces, self.tokenizer.model
        for (piece, _), i in zip(found, owner.tolist(), strict=True):
            known = pieces.get(piece)
            if known is None:
                known = pieces[piece] = _bytes([t.id for t in model.tokenize(piece)])
                self.held += ENTRY_BYTES + len(piece) + len(known)
            ids[i].append(known)
        for word, found_ids in zip(words, ids, strict=True):
            self._keep(word, b"".join(found_ids))


def _bytes(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def loaded(path: str, most_bytes: int = MOST_BYTES) -> WordTokens:
    """The tokenizer of this file; a worker loads it once and keeps it between tasks."""
    key = (path, most_bytes)
    if key not in _LOADED:
        _LOADED[key] = WordTokens(path, most_bytes)
    return _LOADED[key]
