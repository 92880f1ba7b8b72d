"""Tokenizers over Arrow batches, each distinct piece of text encoded once while it is remembered.

A tokenizer that splits text before its merges never lets a token reach from a visible character
into the white space after it, nor from a letter into a full stop or comma after it. Text may
therefore be cut at such places and the pieces encoded apart: their ids, joined, are those of the
whole text; other marks at the end of a piece are cut off likewise. Pieces repeat far more often than texts do, so a bounded memory of them takes most of
the work off the library. It lives in its Python worker over all tasks of its operator, until a task of another one needs the room.
Words of plain letters, which normalisation and splitting leave as they are, go to the library's merges directly.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Hashable

# Spark runs one task a core; the library's own threads would only get in the way.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tickloom.llm.common import kept  # noqa: E402

#: Pieces of more characters are encoded each time: remembered ones are short, so their number bounds their memory.
LONGEST = 64

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_SPACE_CUT = re.compile(r"(?<=\S)(?= )")
_LINE_CUT = re.compile(r"(?<=\S)(?=\n)")


def byte_characters() -> list[str]:
    """A visible character per byte: printable Latin-1 bytes as themselves, the others from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


#: No pattern lets a letter or digit reach into these; apostrophes begin endings, and < | > special strings.
MARKS = ".,;:!?\"#$%&()*+-=@[]^_{}~"
#: Words that no normalisation changes and no pattern splits: lower-case letters, each a character of its own.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_SHOWN = dict(enumerate(byte_characters()))


def tokenizer(path: str) -> Tokenizer:
    return kept("tokenizer", path, lambda: Tokenizer.from_file(path))


def line_parts(piece: str) -> list[str]:
    """``piece`` cut before line ends that follow a visible character, and after a line end that stands alone."""
    out = []
    for part in _LINE_CUT.split(piece):
        if len(part) > 1 and part[0] == "\n" and not part[1].isspace():
            out += ["\n", part[1:]]
        else:
            out.append(part)
    return out


def _ends_plain(word: str | bytes) -> bool:
    """Whether the last character is a letter or digit of ASCII, or one of the letters of ``_PLAIN``."""
    if word[-1:].isascii():
        return word[-1:].isalnum()
    return _PLAIN.fullmatch(word[-1] if isinstance(word, str) else word.decode()[-1]) is not None


class PieceCache:
    """Values of pieces under one tokenizer. Values are joined by ``+``.

    ``value`` turns the ids of an encoded piece into what is kept. ``spaced``: a space belongs to the
    word behind it; else white space never shows in the ids, and neither does the case of the
    letters A to Z. ``rest`` holds words behind a space (without it), ``first`` all other pieces;
    without spaced words they are one.
    """

    def __init__(self, library: Tokenizer, value: Callable, spaced: bool = True, most: int = 1_000_000):
        self.model = library.model
        self.library, self.value, self.spaced, self.most = library, value, spaced, most
        self.first: dict[str | bytes, object] = {}
        self.rest: dict[str | bytes, object] = {} if spaced else self.first
        self.passing: list[tuple[dict, str | bytes]] = []  # long pieces, kept until their batch is done

    def _encode(self, cache: dict, missing: list, lead: str) -> None:
        missing = self._encode_plain(cache, missing, lead)
        for at in range(0, len(missing), 1024):
            part = missing[at : at + 1024]
            texts = [lead + w for w in part] if self.spaced else [w.decode() for w in part]
            for word, encoding in zip(part, self.library.encode_batch_fast(texts, add_special_tokens=False)):
                self._put(cache, word, self.value(lead + word if self.spaced else word, encoding.ids))

    def _encode_plain(self, cache: dict, missing: list, lead: str) -> list:
        """Encode words of ``_PLAIN`` letters by the merges alone, and return the others."""
        others, tokenize, shown_lead = [], self.model.tokenize, lead.translate(_SHOWN)
        for word in missing:
            text = word if self.spaced else word.decode()
            if len(word) <= LONGEST and text.isascii() and text.isalpha() and text.islower():
                shown = shown_lead + text
            elif len(word) <= LONGEST and _PLAIN.fullmatch(text):
                shown = (lead + text).encode().decode("latin-1").translate(_SHOWN)
            else:
                others.append(word)
                continue
            cache[word] = self.value(lead + word if self.spaced else word, [t.id for t in tokenize(shown)])
        return others

    def _put(self, cache: dict, word: str | bytes, value: object) -> None:
        cache[word] = value
        if len(word) > LONGEST:
            self.passing.append((cache, word))

    def _room(self, cache: dict, words: set | list) -> None:
        """Make room: what this batch needs stays, and with it the common words."""
        if len(cache) + len(words) > self.most:
            kept = {w: cache[w] for w in words if w in cache}
            cache.clear()
            cache.update(kept)

    def _fill(self, cache: dict, words: set, lead: str) -> None:
        """Values for ``words``. Marks at the end behind a letter or digit are encoded apart, and so are lines."""
        self._room(cache, words)
        ends = MARKS.encode() if isinstance(next(iter(words), ""), bytes) else MARKS
        whole, stems, tails, cut, lines = set(), set(), set(), [], []
        for w in words.difference(cache):
            if lead and "\n" in w:
                lines.append((w, line_parts(lead + w)))
                continue
            stem = w.rstrip(ends)
            if len(stem) < len(w) and stem and _ends_plain(stem):
                tail = w[len(stem) :]
                stems.add(stem)
                tails.add(tail)
                cut.append((w, stem, tail))
            else:
                whole.add(w)
        for _, parts in lines:
            if parts[0].startswith(lead):
                stems.add(parts[0][len(lead) :])
                tails.update(parts[1:])
            else:
                tails.update(parts)
        self._encode(cache, list((whole | stems).difference(cache)), lead)
        self._encode(self.first, list(tails.difference(self.first)), "")
        for w, stem, tail in cut:
            self._put(cache, w, cache[stem] + self.first[tail])
        for w, parts in lines:
            value = cache[parts[0][len(lead) :]] if parts[0].startswith(lead) else self.first[parts[0]]
            for x in parts[1:]:
                value = value + self.first[x]
            self._put(cache, w, value)

    def pieces(self, text: bytes) -> list:
        """Spaced: the first piece as it is, the others without the space they begin with. Else: words in lower case."""
        if not self.spaced:
            # Strings of special tokens are matched as they are written.
            return (text if b"<|" in text else text.lower()).split() or [b""]
        whole = text.decode()
        if _SPACE_AFTER_SPACE.search(whole):
            head, *tail = _SPACE_CUT.split(whole)
            return [head, *(x[1:] for x in tail)]
        return whole.split(" ")

    def values(self, texts: list[bytes]) -> list[list]:
        """Per text the values of its pieces, in order."""
        out = self._values(texts)
        self._pass()
        return out

    def _pass(self) -> None:
        for cache, word in self.passing:
            cache.pop(word, None)
        self.passing.clear()

    def joined(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The values of all texts end to end, and where each text's begin and end. Values are bytes and words not spaced.

        As :meth:`values`, but Arrow splits the texts and finds their distinct words, so that Python sees each of those once.
        """
        texts = pc.fill_null(texts, "")
        # Strings of special tokens are matched as they are written.
        cased = pc.match_substring(texts, "<|")
        lower = pc.if_else(cased, texts, pc.ascii_lower(texts)) if pc.any(cased).as_py() else pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(lower)  # an empty word before leading white space and after trailing has no ids
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self._room(self.rest, words)
        found = list(map(self.rest.get, words))
        if missing := [i for i, x in enumerate(found) if x is None]:
            self._fill(self.rest, {words[i] for i in missing}, "")
            for i in missing:
                found[i] = self.rest[words[i]]
        self._pass()
        flat = pa.array(found, type=pa.large_binary()).take(coded.indices)
        _, at, data = flat.buffers()
        at = np.frombuffer(at, dtype=np.int64, count=len(flat) + 1, offset=8 * flat.offset)
        bounds = lists.offsets.to_numpy()
        return memoryview(data or b""), at[bounds - bounds[0]]

    def _values(self, texts: list[bytes]) -> list[list]:
        cut = [self.pieces(t) for t in texts]
        if self.first is self.rest:
            self._fill(self.rest, set().union(*cut), "")
            get = self.rest.__getitem__
            return [list(map(get, words)) for words in cut]
        self._room(self.first, heads := {words[0] for words in cut})
        self._fill(self.rest, set().union(*(words[1:] for words in cut)), " ")
        self._encode(self.first, list(heads.difference(self.first)), "")
        get = self.rest.__getitem__
        return [[self.first[words[0]], *map(get, words[1:])] for words in cut]


def shared_cache(key: Hashable, make: Callable[[], PieceCache]) -> PieceCache:
    """This worker's cache for ``key``; another key's is let go."""
    return kept("pieces", key, make)
