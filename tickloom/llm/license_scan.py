"""License scans: one Aho-Corasick pass for notice phrases, one for identifier tags, and licence expressions.

Phrases are found on words: letters A to Z in lower case, words of letters, digits and any
character beyond ASCII, all else apart. Identifier tags (``SPDX-License-Identifier:``) are found in
the text itself; the licence expression behind a tag is read to the end of its line, of the comment
or to the next tag by a shunting-yard parser (WITH before AND before OR, parentheses) and evaluated: its licences become
labels, and an expression is permissive if OR has a permissive side, AND only permissive ones.

Null text has no words. Broken expressions give the labels of the identifiers they name and no
verdict. Repeated rows each get a row. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import bytes_of, documents, per_row

#: The phrases and labels of the contract.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc0": "cc0",
    "public domain": "public-domain", "isc license": "isc", "eclipse public license": "epl", "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit", "licensed under": "notice", "all rights reserved": "all-rights-reserved",
}
TAG = "spdx-license-identifier:"
#: Families by the beginning of an identifier, longest first.
FAMILIES = (
    ("cc-by-nc", "cc-by-nc"), ("cc-by-sa", "cc-by-sa"), ("apache", "apache"), ("cc-by", "cc-by"), ("agpl", "agpl"),
    ("lgpl", "lgpl"), ("gpl", "gpl"), ("mit", "mit"), ("bsd", "bsd"), ("0bsd", "bsd"), ("mpl", "mpl"), ("epl", "epl"),
    ("isc", "isc"), ("cc0", "cc0"), ("unlicense", "public-domain"), ("bsl", "bsl"),
)
PERMISSIVE = frozenset({"apache", "mit", "bsd", "isc", "cc0", "cc-by", "public-domain", "bsl"})
PRIORITY = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
#: What ends a comment, and an expression within it.
_CLOSED = re.compile(r"\*/|-->|#\}")
_APART = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean, n_tags long"


def to_postfix(text: str) -> list[str] | None:
    """Shunting-yard: the expression in postfix order; None if it is broken."""
    out, waiting, operand = [], [], False
    for token in _TOKEN.findall(text):
        if token == "(":
            if operand:
                return None
            waiting.append(token)
        elif token == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in PRIORITY:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and PRIORITY[waiting[-1]] >= PRIORITY[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        else:
            if operand:
                return None
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def family(identifier: str) -> str:
    return next((name for start, name in FAMILIES if identifier.startswith(start)), identifier)


def evaluate(text: str) -> tuple[set[str], bool | None]:
    """Labels of the expression's licences, and whether its terms are permissive (None: broken or empty)."""
    text = text.lower()
    postfix = to_postfix(text)
    if postfix is None:
        return {family(t) for t in _TOKEN.findall(text) if t not in PRIORITY and t not in "()"} & {n for _, n in FAMILIES}, None
    # Labels stay apart until the end, a pair for each operator: a long expression is walked once.
    stack: list[tuple[object, bool]] = []
    for token in postfix:
        if token in PRIORITY:
            (right, free), (left, also_free) = stack.pop(), stack.pop()
            if token == "with":  # an exception only adds permissions
                stack.append((left, also_free))
            else:
                stack.append(((left, right), also_free or free if token == "or" else also_free and free))
        else:
            name = family(token)
            stack.append((name, name in PERMISSIVE))
    tree, permissive = stack.pop()
    labels, waiting = set(), [tree]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            labels.add(part)
        else:
            waiting += part
    return labels, permissive


@lru_cache(maxsize=1)
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**MORE_PHRASES, **BASE_PHRASES}.items():
        phrases.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE_PHRASES))
    tags.add_word(TAG, len(TAG))
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(data: bytes) -> tuple:
    """The values of ``FIELDS`` for one text."""
    phrases, tags = automata()
    words = data.translate(_APART).split()
    joined = f" {b' '.join(words).decode()} "
    labels, base, first, last, places = set(), set(), None, None, 0
    word, counted = 0, 0
    found = [(end - length + 1, label, own) for end, (length, label, own) in phrases.iter(joined)]
    for at, label, own in sorted(found):
        word, counted = word + joined.count(" ", counted, at), at
        labels.add(label)
        if own:
            base.add(label)
            places += 1
            first, last = word if first is None else first, word
    verdicts, ends = [], []
    lower = data.lower()
    if TAG.encode() in lower:  # most texts have no tag, and are not decoded for them
        text = lower.decode()
        ends = [end + 1 for end, _ in tags.iter(text)]
        for at, upto in zip(ends, [e - len(TAG) for e in ends[1:]] + [len(text)]):
            line = text.find("\n", at, upto)
            own_labels, verdict = evaluate(_CLOSED.split(text[at : line if line >= 0 else upto], maxsplit=1)[0])
            labels |= own_labels
            verdicts.append(verdict)
    known = [v for v in verdicts if v is not None]
    score = 1.0 if known else 0.9 if base else 0.7 if labels - {"notice", "all-rights-reserved"} else 0.3 if labels else 0.0
    return (
        len(words), places, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score,
        all(known) if known else None, len(ends),
    )


def _make():
    def run(batch):
        out = [scan_text(x) for x in bytes_of(batch)]
        return {part.split()[0]: [row[i] for row in out] for i, part in enumerate(FIELDS.split(", "))}

    return run


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``FIELDS`` per row. Labels that come with no licence (``notice``) mark wording alone."""
    return per_row(docs, _make, [("doc_id", "doc_id"), ("text", "text")], FIELDS)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
