"""Elements of the top-level arrays of a JSON document, read piece by piece: a document of any size in bounded memory."""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable, Iterator

PIECE = 1 << 20
SPACE = " \t\n\r"
BEHIND = frozenset(SPACE + ",:]}")


class _Window:
    """The unread part of a document, extended by pieces where a value goes on beyond it."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.decode = read, codecs.getincrementaldecoder("utf-8-sig")().decode
        self.scan = json.JSONDecoder().raw_decode
        self.text, self.at, self.ended = "", 0, False

    def more(self) -> bool:
        """Append as much as is unread, a piece at least, so that a long value is not parsed over and over."""
        if self.ended:
            return False
        self.text, self.at = self.text[self.at :], 0
        piece = self.read(max(PIECE, len(self.text)))
        self.ended = not piece
        self.text += self.decode(piece, self.ended)
        return True

    def peek(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            while self.at < len(self.text):
                if self.text[self.at] not in SPACE:
                    return self.text[self.at]
                self.at += 1
            if not self.more():
                return ""

    def take(self, wanted: str) -> None:
        if self.peek() != wanted:
            raise ValueError(f"expected {wanted!r}, found {self.peek()!r}")
        self.at += 1

    def value(self):
        """The next whole value."""
        self.peek()
        while True:
            try:
                found, end = self.scan(self.text, self.at)
                # Behind a whole value comes a mark or white space; a number may be cut anywhere.
                if self.text[end : end + 1] in BEHIND or not self.more():
                    self.at = end
                    return found
            except json.JSONDecodeError:
                if not self.more():
                    raise

    def items(self, close: str) -> Iterator[None]:
        """Stops at each item of a list or object up to ``close``."""
        self.at += 1
        if self.peek() == close:
            self.at += 1
            return
        while True:
            yield
            if self.peek() == close:
                self.at += 1
                return
            self.take(",")


def elements(read: Callable[[int], bytes], wanted: set[str]) -> Iterator[tuple[str, int, object]]:
    """(name, number from 1, value) of every element of the ``wanted`` arrays of the document's top-level object.

    Other values are read over, arrays among them element by element. Anything that is not one JSON object is an error.
    """
    window = _Window(read)
    if window.peek() != "{":
        raise ValueError("not a JSON object")
    for _ in window.items("}"):
        name = window.value()
        window.take(":")
        if window.peek() != "[":
            window.value()
            continue
        for number, _ in enumerate(window.items("]"), 1):
            found = window.value()
            if name in wanted:
                yield name, number, found
    if window.peek():
        raise ValueError("more than one JSON value")
