"""Token ids of whole texts by a public tokenizer, word by word.

The tokenizers cut a text at white space before they look at characters, so the
ids of a text are the joined ids of its words.  Most words were seen before:
their ids are kept as bytes.  Texts with unusual white space, or with the name
of a special token, are encoded in one go; so is every word that is more than
plain letters.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

# Ids are little-endian unsigned 32-bit integers throughout.
ID_BYTES = 4
# Words remembered by a Python worker (two generations, each up to this many),
# and the longest word that is.
REMEMBERED = 300_000
LONGEST = 32

# Letters of one code point that lower case and composition leave one code point.
PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,]?)")
# All white space but the space, by Unicode's White_Space property.
OTHER_SPACE = re.compile("[" + "".join(map(chr, [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                                  0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class UnusualSpace(Exception):
    """Words of this text cannot be told apart by single spaces and line ends."""


class Words(dict):
    """Bytes of ids by word, filled as words come.

    In vocabularies that keep white space a word stands for itself after one
    space, or after a line end if it starts with one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.keeps_space = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        self.before = self.letters[32] if self.keeps_space else ""
        self.older: dict[str, bytes] = {}
        self.marks = {m: self.whole(m) for m in ("", ".", ",", "\n")}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(ID_BYTES, "little") for i in ids])

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def letters_only(self, word: str, before: str) -> bytes:
        if not self.keeps_space:
            word = word.lower()
        spelt = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return self.packed([t.id for t in self.model.tokenize(before + spelt)])

    def spell(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        if plain:
            core, end = plain.groups()
            return (self[core] if end else self.letters_only(core, self.before)) + self.marks[end]
        if not self.keeps_space:
            return self.whole(word)
        if word[:1] == "\n":
            rest = word[1:]
            if not rest or OTHER_SPACE.search(rest):
                raise UnusualSpace
            plain = PLAIN.fullmatch(rest)
            tail = self.letters_only(plain[1], "") + self.marks[plain[2]] if plain else self.whole(rest)
            return self.marks["\n"] + tail
        if not word or OTHER_SPACE.search(word):
            raise UnusualSpace
        return self.whole(" " + word)

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.spell(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        if not self.keeps_space:
            return b"".join([self[w] for w in text.replace("\n", " ").split(" ") if w])
        try:
            # A line end before the first word makes it one that no space precedes.
            return b"".join([self[w] for w in ("\n" + text).replace("\n", " \n")[1:].split(" ")])[len(self.marks["\n"]):]
        except UnusualSpace:
            return self.whole(text)


_words: dict[str, Words] = {}


def encoder(path: str) -> Callable[[Iterable[str | None]], list[bytes]]:
    """A function from texts to the bytes of their ids; null counts as empty.

    What a worker has learnt about words stays for its next tasks.
    """
    if path not in _words:
        _words[path] = Words(path)
    words = _words[path]
    return lambda texts: [words.encode(t) for t in texts]
