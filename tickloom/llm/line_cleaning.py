"""Line-first cleaning: rules on single lines, removal of failing lines, rejection of documents that lose too much.

A line fails
* the punctuation rule, if more than a third of its words carry a symbol, a repeated mark or a mark
  glued behind another, or if it has ten words or more and not one mark that ends or divides sentences in any
  script (lines in Thai or Lao, which do without, are let off);
* the navigation rule, if separators make up a quarter of its words or more;
* the boilerplate rule, if it holds one of ``BOILERPLATE`` and at most 30 words, or repeats an
  earlier line of the document.
Documents that keep fewer than ``MIN_KEPT_SHARE`` of the characters in their words are rejected,
and so are those that fail the base rules of the contract (too short, too repetitive).

Null text has no words and fails. Empty lines are kept as they are and count for nothing. Repeated
rows each get a row. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import bytes_of, documents, per_row

SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset([b"|", b"||", b">", b">>", b"/", "»".encode(), "›".encode(), "•".encode(), "·".encode()])
#: Phrases by language; texts are held against all of them, as a page may carry another language's notices.
BOILERPLATE = {
    "en": (
        "all rights reserved", "licensed under", "released under the", "cookie", "privacy policy", "terms of use",
        "terms of service", "subscribe to our", "sign up for", "click here", "enable javascript", "lorem ipsum",
        "skip to content", "back to top", "share this", "read more",
    ),
    "de": ("alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "jetzt anmelden", "weiterlesen"),
    "fr": ("tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "lire la suite"),
    "es": ("todos los derechos reservados", "política de privacidad", "condiciones de uso", "leer más"),
    "it": ("tutti i diritti riservati", "informativa sulla privacy", "condizioni d'uso", "leggi tutto"),
    "pt": ("todos os direitos reservados", "política de privacidade", "termos de uso", "leia mais"),
}
#: Thai and Lao, as UTF-8 begins their letters: they end sentences by a space.
UNMARKED = re.compile(rb"\xe0[\xb8-\xbb]")
ODD_WORD = re.compile(rb"[#*$%&|<>{}\\^~=_]|[!?]{2}")
LONG_LINE, MOST_BOILERPLATE_WORDS, MIN_WORDS, MIN_KEPT_SHARE = 10, 30, 50, 0.6
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_lines long, n_removed_lines long, kept_chars long"
)


@lru_cache(maxsize=1)
def sentence_marks() -> re.Pattern:
    """Marks that end or divide sentences in any script, as the Unicode standard lists them, and the ellipsis."""
    marks = regex.findall(r"\p{Terminal_Punctuation}", "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000))
    return re.compile(b"|".join(re.escape(c.encode()) for c in [*marks, "…"]))


@lru_cache(maxsize=4)
def phrases(boilerplate: tuple[tuple[str, ...], ...]) -> re.Pattern:
    return re.compile(b"|".join(re.escape(x.encode().lower()) for own in boilerplate for x in own) or b"(?!)")


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) - (np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) == 0x80) if not data.isascii() else 0)


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that stand in the text twice or more, all their places counted."""
    n = len(words)
    if n <= size:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    if len(number) > 1 << 20:  # three of them no longer fit 63 bits
        seen: dict[tuple, int] = {}
        windows = np.fromiter((seen.setdefault(x, len(seen)) for x in zip(*(words[i:] for i in range(size)))), dtype=np.int64)
    else:
        windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(n, dtype=bool)
    for i in range(size):
        covered[i : n - size + 1 + i] |= twice
    return int(covered.sum())


def line_fails(line: bytes, words: list[bytes], seen: set[bytes], boilerplate: re.Pattern) -> bool:
    n = len(words)
    if line in seen:
        return True
    if n >= LONG_LINE and not sentence_marks().search(line) and not UNMARKED.search(line):
        return True
    if ODD_WORD.search(line) and 3 * sum(1 for w in words if ODD_WORD.search(w)) > n:
        return True
    if 4 * sum(1 for w in words if w in SEPARATORS) >= n:
        return True
    return n <= MOST_BOILERPLATE_WORDS and boilerplate.search(line.lower()) is not None


def clean_text(data: bytes, boilerplate: dict[str, tuple[str, ...]] = BOILERPLATE) -> tuple[bytes, dict]:
    """The text without failing lines, and the document's figures."""
    notices = phrases(tuple(map(tuple, boilerplate.values())))
    words = data.split()
    word_chars = characters(b"".join(words))
    seen: set[bytes] = set()
    keep, lines, removed, duplicates, kept_chars = [], 0, 0, 0, 0
    for line in data.split(b"\n"):
        own = line.split()
        if own:
            lines += 1
            duplicates += line in seen
            if line_fails(line, own, seen, notices):
                removed += 1
                seen.add(line)
                continue
            seen.add(line)
            kept_chars += characters(b"".join(own))
        keep.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > 50 * len(words)
    figures = {
        "n_words": len(words),
        "word_chars": word_chars,
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "kept": not base_failed and kept_chars >= MIN_KEPT_SHARE * word_chars,
        "n_lines": lines,
        "n_removed_lines": removed,
        "kept_chars": kept_chars,
    }
    return b"\n".join(keep), figures


def _make(with_text: bool, boilerplate: dict[str, tuple[str, ...]]):
    def make():
        def run(batch):
            out = [clean_text(x, boilerplate) for x in bytes_of(batch)]
            new = {name.split()[0]: [f[name.split()[0]] for _, f in out] for name in FIELDS.split(", ")}
            if with_text:
                new["cleaned"] = [t.decode() for t, _ in out]
            return new

        return run

    return make


def clean(docs: DataFrame, with_text: bool = True, boilerplate: dict[str, tuple[str, ...]] = BOILERPLATE) -> DataFrame:
    """Per row: ``doc_id``, the figures, ``kept``, and with ``with_text`` the text ``cleaned`` of failing lines.

    ``boilerplate``: phrases by language, in lower case as far as A to Z go.
    """
    fields = FIELDS + ", cleaned string" * with_text
    return per_row(docs, _make(with_text, boilerplate), [("doc_id", "doc_id"), ("text", "text")], fields)


def op2_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(documents(spark, sf_dir), with_text=False)
