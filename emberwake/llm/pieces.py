"""Cutting a text into pieces that a pattern-split BPE encodes independently.

Both public patterns attach one preceding space to a word and never match
across a "non-space, space" border, and a lone line feed between two non-space
characters is a match of its own. A text may therefore be cut before any such
space or line feed, each piece encoded once, and the results concatenated.
Pieces repeat a lot, so ``PieceEncoder`` remembers them; its memory is bounded
(``limit`` pieces, then it starts anew) and is only a speed matter.
"""

from __future__ import annotations

from collections.abc import Callable


def cut(text: str) -> list[str]:
    """Pieces whose concatenation is ``text``; borders only where safe.

    Borders that touch other white space (runs of spaces, blank lines, tabs
    beside a space) stay inside one piece.
    """
    parts = text.replace("\n", " \n").split(" ")
    out: list[str] = []
    for k, part in enumerate(parts):
        piece = part if k == 0 or part[:1] == "\n" else " " + part
        body = part[1:] if part[:1] == "\n" and k else part
        if out and body and not body[0].isspace() and out[-1] and not out[-1][-1].isspace():
            out.append(piece)
        elif out:
            out[-1] += piece
        else:
            out.append(piece)
    return out


class PieceEncoder:
    """text -> token ids as little-endian uint32 bytes.

    ``encode`` maps a list of pieces to a list of such byte strings.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int):
        self.encode, self.limit = encode, limit
        self.known: dict[str, bytes] = {}  # split part -> ids of the piece

    def __call__(self, text: str) -> bytes:
        # a first part has no space before it: never remembered as a part
        first, *parts = text.replace("\n", " \n").split(" ")
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        new = list(set(parts).difference(known))
        if not new:
            return self.encode([first])[0] + b"".join(map(known.__getitem__, parts))
        if not first or first[-1].isspace():
            return b"".join(self.encode(cut(text)))
        pieces = []
        for p in new:
            body = p[1:] if p[:1] == "\n" else p
            if not body or body[0].isspace() or body[-1].isspace():
                return b"".join(self.encode(cut(text)))
            pieces.append(p if body is not p else " " + p)
        ids = self.encode([first, *pieces])
        known.update(zip(new, ids[1:]))
        return ids[0] + b"".join(map(known.__getitem__, parts))
