"""Token ids of whole texts by a public tokenizer file, for use inside tasks.

The ``tokenizers`` library encodes; what is added here is a bounded memory of pieces it
has encoded already. Texts are cut where its own pre-tokenizer always cuts, so ids of
the pieces, one after the other, are the ids of the text:

* word BPE (white space dropped): at every run of ASCII white space;
* byte-level BPE: before a space that is followed by something other than white space,
  and before a line end between two such characters.

A new piece of plain letters, with or without a comma or full stop, needs no more of the
tokenizer than its model: such letters pass its normaliser as they are (lower-cased if it
lowers) and its pre-tokenizer in one. All others take the whole way.

Ids travel as little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import gc
import os
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa

#: Pieces of so many characters at most are remembered, in about so many bytes; when half
#: as many again had no room, the memory starts anew.
KEPT_BYTES = 160 << 20
KEPT_LENGTH = 40
#: What an entry takes besides its letters and ids, and so the entries at most.
ENTRY_BYTES = 150
KEPT_PIECES = KEPT_BYTES // ENTRY_BYTES
END = (2).to_bytes(4, "little")
ODD_SPACE = "\u180e\u200b\ufeff"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's character for each byte: itself if it is a visible Latin-1
    character, otherwise the next free one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def unsafe(part: str) -> bool:
    """Whether white space at the edge of a part may belong to a run that goes on."""
    body = part[1:] if part.startswith("\n") else part
    return not body or body[0].isspace() or body[-1].isspace() or body[0] in ODD_SPACE or body[-1] in ODD_SPACE


class Coder:
    """Encodes texts; ``spaced`` says that a space belongs to the piece after it."""

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.model = self.tokenizer.model
        self.marks = {m: self.ids(m) for m in ("", ".", ",")}
        self.forget()

    def ids(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def letters(self, piece: str) -> bytes | None:
        """Ids of a piece by the model alone, if it is of plain letters. Letters below
        U+0130 have neither other normal forms nor other lower cases by context."""
        mark = piece[-1] if piece.endswith((".", ",")) else ""
        body = piece[:-1] if mark else piece
        space = self.spaced and body[:1] == " "
        word = body[1:] if space else body
        if not word.isalpha() or not word.isascii() and max(word) >= "\u0130":
            return None
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        found = self.model.tokenize("\u0120" + word if space else word)
        return array("I", [t.id for t in found]).tobytes() + self.marks[mark]

    def forget(self) -> None:
        #: by part: its ids with the space before it (spaced; without, if it begins a line)
        self.kept: dict = {}
        #: by the part that begins a text (spaced)
        self.firsts: dict = {"": b""}
        self.size = self.lost = 0

    def encode_column(self, texts: pa.Array, at_once: int = 256) -> Iterator[list[bytes]]:
        """Ids of each text with the end id, some texts at a time; null is empty."""
        for i in range(0, len(texts), at_once):
            part = texts.slice(i, at_once)
            some = (part if self.spaced else part.cast(pa.binary())).to_pylist()
            none = "" if self.spaced else b""
            yield [ids + END for ids in self.encode([none if t is None else t for t in some])]

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text (bytes in UTF-8 if not spaced)."""
        if self.lost > KEPT_BYTES // 2:
            self.forget()
        found, gaps = [], []
        for k, text in enumerate(texts):
            parts = text.replace("\n", " \n").split(" ") if self.spaced else text.split()
            ids = list(map(self.kept.get, parts))
            if self.spaced:
                ids[0] = self.firsts.get(parts[0])
            found.append(ids)
            if None in ids:
                gaps.append((k, parts))
        if gaps:
            self.fill(texts, found, gaps)
        return [b"".join(ids) for ids in found]

    def fill(self, texts: list, found: list[list], gaps: list[tuple[int, list]]) -> None:
        """Encode what is missing. Texts with unsafe parts are cut with more care."""
        todo = []
        for k, parts in gaps:
            ids, at = found[k], []
            for _ in range(ids.count(None)):
                at.append(ids.index(None, at[-1] + 1 if at else 0))
            if not self.spaced:
                todo += [(ids, j, parts[j]) for j in at]
            elif any(unsafe(parts[j]) for j in at):
                pieces = self.careful(texts[k])
                ids[:] = [self.kept.get(p[1:]) if p[:1] == " " and p[1:2] != "\n" else None for p in pieces]
                todo += [(ids, j, p) for j, p in enumerate(pieces) if ids[j] is None]
            else:
                todo += [(ids, j, p if p[:1] == "\n" or not j else " " + p) for j in at for p in (parts[j],)]
        fresh, others = {}, []
        for p in {p for _, _, p in todo}:
            if (ids := self.letters(p if self.spaced else p.decode())) is None:
                others.append(p)
            else:
                fresh[p] = ids
        batch = self.tokenizer.encode_batch_fast(others if self.spaced else [p.decode() for p in others], add_special_tokens=False)
        fresh.update((p, array("I", e.ids).tobytes()) for p, e in zip(others, batch))
        for ids, j, p in todo:
            ids[j] = fresh[p]
        self.keep(fresh)

    def keep(self, fresh: dict) -> None:
        for p, ids in fresh.items():
            took = ENTRY_BYTES + len(p) + len(ids)
            if self.size > KEPT_BYTES or len(self.kept) + len(self.firsts) > KEPT_PIECES:
                self.lost += took
            elif len(p) <= KEPT_LENGTH:
                if not self.spaced:
                    self.kept[p] = ids
                    self.size += took
                else:
                    part = p[1:] if p[:1] == " " else p
                    if " " not in part and p[:2] != " \n" and not unsafe(part):
                        (self.kept if p[:1] in (" ", "\n") else self.firsts)[part] = ids
                        self.size += took

    def careful(self, text: str) -> list[str]:
        """Cut before spaces that surely begin a piece."""
        first, *rest = text.split(" ")
        out = [first]
        for part in rest:
            if not part or part[0].isspace() or part[0] in ODD_SPACE:
                out[-1] += " " + part
            else:
                out.append(" " + part)
        return out


@lru_cache(maxsize=4)
def coder(path: str, spaced: bool) -> Coder:
    gc.set_threshold(1_000_000)  # the memory holds no cycles, and walking it costs as much as using it
    _CODERS.append(Coder(path, spaced))
    return _CODERS[-1]


#: The coders of this worker, at most four.
_CODERS: deque[Coder] = deque(maxlen=4)


def forget_pieces() -> None:
    """Give back what this worker's coders remember: Spark uses its workers again, and a
    stage that encodes nothing has no use for it."""
    for one in _CODERS:
        if one.size:
            one.forget()
