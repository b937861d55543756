"""Licence scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by shunting-yard."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from sitepulse.llm.common import lower_ascii, map_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices, in the same words.
NOTICE_PHRASES = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Licences that an expression may rest on to count as open for reuse.
PERMISSIVE = frozenset(
    ["0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "cc0-1.0", "isc", "mit", "unlicense", "zlib"]
)
#: An expression is what stands behind a tag on its line.
_EXPRESSION = re.compile(r"[^\r\n]*")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str] | None:
    """A licence expression in postfix order by shunting-yard; None if it is no expression.

    ``with`` binds tighter than ``and``, which binds tighter than ``or``; equal ones group from the left.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = False  # what came last was an operand or a closing bracket
    at = 0
    for token in _TOKEN.finditer(text):
        if text[at : token.start()].strip(" \t"):
            break  # prose or a comment end follows
        word = token[0]
        if word in _RANK:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = False
        elif word == "(":
            if operand:
                return None
            waiting.append(word)
        elif word == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif operand:
            break  # two names in a row: the expression ended before the second
        else:
            out.append(word)
            operand = True
        at = token.end()
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate_expression(postfix: list[str], allowed: frozenset[str] = PERMISSIVE) -> bool:
    """Can the text be used under ``allowed`` licences? ``with`` adds permissions, so its left side decides."""
    stack: list[bool] = []
    for word in postfix:
        if word in _RANK:
            right, left = stack.pop(), stack.pop()
            stack.append(left or right if word == "or" else left and right if word == "and" else left)
        else:
            stack.append(word in allowed)
    return stack[0]


@lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases = ahocorasick.Automaton()
    for phrase, label in {**BASE_PHRASES, **NOTICE_PHRASES}.items():
        phrases.add_word(f" {phrase} ", (f" {phrase} ", label, phrase in BASE_PHRASES))
    phrases.make_automaton()
    tags = ahocorasick.Automaton()
    for tag in TAGS:
        tags.add_word(tag, tag)
    tags.make_automaton()
    return phrases, tags


def scan_text(text: str | None) -> dict:
    """All finds in one text; see ``scan_licenses``."""
    phrases, tags = _automata()
    low = lower_ascii(text or "")
    words = WORD.findall(low)
    line = f" {' '.join(words)} "
    base_labels, labels, base_starts, notices = set(), set(), [], 0
    spaces = upto = 0
    for end, (phrase, label, is_base) in phrases.iter(line):  # ends rise, so every character is counted once
        spaces += line.count(" ", upto, end + 1)
        upto = end + 1
        start = spaces - phrase.count(" ")  # words before the phrase
        labels.add(label)
        if is_base:
            base_labels.add(label)
            base_starts.append(start)
        else:
            notices += 1
    expressions, open_ones = [], 0
    for end, _ in tags.iter(low):
        postfix = parse_expression(_EXPRESSION.match(low, end + 1)[0])
        if postfix:
            expressions.append(" ".join(postfix))
            open_ones += evaluate_expression(postfix)
            named = [w for i, w in enumerate(postfix) if w not in _RANK and postfix[i + 1 : i + 2] != ["with"]]
            labels.update(named)
    places = len(base_starts) + notices + len(expressions)
    return {
        "n_words": len(words),
        "n_base": len(base_starts),
        "first_word": min(base_starts, default=None),
        "last_word": max(base_starts, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        # Each find halves the doubt; a parsed tag leaves a tenth of it.
        "score": 1 - 0.5 ** (len(base_starts) + notices) * 0.1 ** len(expressions) if places else 0.0,
        "expressions": expressions,
        "permissive": bool(expressions) and open_ones == len(expressions),
    }


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, expressions array<string>, permissive boolean"
)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with what its whole text says about licences.

    n_base counts all places of the base phrases, overlapping ones too; first_word and last_word are
    the smallest and largest of their starts. labels adds other notices and the licences named behind
    identifier tags; expressions are those tags' postfix forms, and permissive says that there are
    some and that all can be met with permissive licences. A null or empty text has no words, labels
    or score; its places are null. Repeated rows each get their own row; a null id stays null.
    """

    def work(rows: dict) -> dict:
        found = [scan_text(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"]} | {k: [f[k] for f in found] for k in scan_text(None)}

    return map_batches(
        docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text"), work, SCHEMA
    )
