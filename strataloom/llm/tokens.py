"""Token ids of texts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
# Texts beyond these characters are left to the tokenizer whole: there its notion of a
# letter, digit or white space may be that of another version of Unicode.
OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-\u024f]")


def _pieces() -> re.Pattern:
    """How the vocabulary's tokenizer splits a text, for the characters below U+0250."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x250)]
    letters, digits = (
        "".join(re.escape(chr(c)) for c, k in enumerate(kinds) if k == wanted) for wanted in "LN"
    )
    return re.compile(
        rf" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{digits}]+| ?[^\s{letters}{digits}]+|\s+(?!\S)|\s+"
    )


def _byte_characters() -> str:
    """The characters that stand for bytes 0 to 255 in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


PIECES, BYTES = _pieces(), _byte_characters()
# A byte that no UTF-8 text has, so that no merge of the vocabulary reaches over it.
APART = b"\xc0"
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
SLICE = 1 << 20
CACHED = 300_000
LONGEST = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts as little-endian 32-bit ids; a repeated piece is looked up.

    Strings of special tokens inside a text are ordinary text.  Pieces are kept in two
    generations of bounded size, so frequent ones stay.
    """

    def __init__(self, path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.apart = self.model.token_to_id(BYTES[APART[0]])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, all pieces in one call of the vocabulary's model."""
        data = APART.join([p.encode() for p in pieces])
        spelled = codecs.charmap_decode(data, "strict", BYTES)[0]
        ids = np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4")
        ends = (np.flatnonzero(ids == self.apart) * 4).tolist() + [ids.nbytes]
        buffer, starts = ids.tobytes(), [0] + [e + 4 for e in ends]
        return [buffer[s:e] for s, e in zip(starts, ends)]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that are not among the known ones."""
        found = {p: self.older[p] for p in pieces if p in self.older}
        new = [p for p in pieces if p not in found]
        if new:
            found.update(zip(new, self.merged(new)))
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST)
        return found

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def slices(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut where two pieces meet."""
        at = 0
        while len(text) - at > SLICE and (cut := SAFE_CUT.search(text, at + SLICE)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if OTHER.search(text):
            text = text.encode("utf-8", "replace").decode()
            return b"".join(map(self.whole, self.slices(text)))
        return b"".join(map(self._encode, self.slices(text)))

    def _encode(self, text: str) -> bytes:
        pieces = PIECES.findall(text)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            found = self.learn(list({p for p, x in zip(pieces, ids) if x is None}))
            ids = [found[p] if x is None else x for p, x in zip(pieces, ids)]
        return b"".join(ids)


@cache
def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker process: what a task has learned serves the next one."""
    return Encoder(path)
