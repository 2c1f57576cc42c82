"""Token ids of whole texts by the tokenizers library, with each distinct piece of text encoded once in a worker.

Both kinds of tokenizer used here cut a text at white space before they merge anything, so the ids of a text are the ids of its
space-separated pieces in order, and pieces repeat far more often than texts. A text whose spaces are not all such cuts (runs of white
space under a byte-level tokenizer) is encoded whole.
"""

from __future__ import annotations

from array import array
from string import punctuation as PUNCTUATION

from tidemark.llm.textbytes import kept, turn

#: Pieces held by a worker (about 200 bytes each) before it starts afresh.
MAX_PIECES = 600_000
#: Longer pieces than this are not held.
MAX_PIECE = 256

#: Byte-level tokenizers write a byte that prints in Latin-1 as itself and the others as the characters from U+0100 on, in order.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}


class _Pieces(dict):
    """Ids of ``prefix + piece`` as little-endian unsigned 32-bit bytes; None where a cut after the piece would not be a cut of the text."""

    def __init__(self, encoder: Encoder, prefix: str, inner: bool):
        super().__init__()
        self.encoder, self.prefix, self.inner = encoder, prefix, inner

    def __missing__(self, piece: str) -> bytes | None:
        if len(self) >= MAX_PIECES:
            self.clear()
        core = piece.rstrip(PUNCTUATION)
        before, newline, after = piece.partition("\n")
        if self.inner and self.encoder.keeps_space and (not piece or piece[-1].isspace()):
            found = None
        elif core.isalpha() and (core.isascii() or max(core) < "\u0250" and self.encoder.stays_letters(core)):
            found = self.encoder.word(self.prefix, core) if core is piece else self[core] + self.encoder.bare(piece[len(core) :])
        elif newline and before and after and not (before[-1].isspace() or after[0].isspace()):
            found = self[before] + self.encoder.bare(newline) + self.encoder.bare(after)
        else:
            found = self.encoder.whole(self.prefix + piece)
        if len(piece) <= MAX_PIECE:
            self[piece] = found
        return found


class Encoder:
    """Encodes with the tokenizer file at ``path``; ``keeps_space``: a space belongs to the piece that it precedes (byte-level)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.keeps_space = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        self.drops_space = not self.keeps_space and not self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.specials = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Pieces(self, " " if self.keeps_space else "", True)
        self.ends = _Pieces(self, self.pieces.prefix, False) if self.keeps_space else self.pieces
        self.alone = _Pieces(self, "", False) if self.keeps_space else self.pieces

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def stays_letters(self, core: str) -> bool:
        """Lower case makes no marks of the letters, as it does of U+0130: a mark would join the punctuation that follows it."""
        return not self.lowers or core.lower().isalpha()

    def word(self, prefix: str, letters: str) -> bytes:
        """Latin letters without marks of their own: one pre-token, which goes to the library's merge model directly."""
        if self.lowers:
            letters = letters.lower()
        if letters.isascii():
            as_bytes = BYTE_CHARS[32] + letters if prefix else letters
        else:
            as_bytes = (prefix + letters).encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(as_bytes)]).tobytes()

    def bare(self, piece: str) -> bytes:
        return self.alone[piece]

    def lowered(self, text: str) -> str:
        """The text in lower case, if its ids are the same: letters of Latin-1, each of which has one lower case wherever it stands, and no
        token that is taken from the text as it was written."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(token in low for token in self.specials) else low

    def __call__(self, text: str | None) -> bytes:
        if self.drops_space:
            text = self.lowered(text or "") if self.lowers else text or ""
            return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))
        head, *rest = (text or "").split(" ")
        if not rest or self.keeps_space and head[-1:].isspace():
            return self.whole(text or "")
        tail = rest.pop()
        try:
            end = self.ends[tail]
            return b"".join([self.bare(head) if head else b"", *map(self.pieces.__getitem__, rest), end])
        except TypeError:  # a None among the pieces
            return self.whole(text)


_encoders: dict[str, Encoder] = {}
kept.append(_encoders)


def encoder(path: str) -> Encoder:
    """The worker's own encoder for ``path``, loaded once; other work in that worker drops it."""
    if path not in _encoders:
        turn()
        _encoders[path] = Encoder(path)
    return _encoders[path]
