"""Line-first cleaning: rules judge lines, and documents that lose too much text are rejected."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sitepulse.llm.common import WORD, lower_ascii, map_batches

SYMBOLS = "#*$%&|<>"
_NOT_SYMBOL = re.compile(r"[^#*$%&|<>]+")
#: Marks that may end a sentence or an item, closing quotes and brackets included.
TERMINAL = frozenset(".!?…:;\"'”’»)]。！？")
SEPARATORS = frozenset(["|", "||", "/", ">", ">>", "»", "›", "•", "·", "::"])
#: Phrases of page furniture; a short line with one of them is boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "lorem ipsum",
    "click here",
    "read more",
    "sign up",
    "log in",
    "subscribe to our",
    "share this",
    "back to top",
    "skip to content",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of what a document may lose."""

    short_line: int = 8  # words; shorter lines must end in a terminal mark
    symbol_percent: int = 10  # most symbols in a line's word characters
    separators: int = 3  # a navigation line has at least so many separators
    separator_percent: int = 15  # and so many in a hundred words
    boilerplate_words: int = 30  # longer lines are no boilerplate
    lost_percent: int = 30  # a document may lose so many of its word characters

    def fault(self, line: str, words: list[str], chars: int) -> str | None:
        """The first rule that a line with words fails; None for a good line."""
        separators = sum(w in SEPARATORS for w in words)
        if separators >= self.separators and 100 * separators >= self.separator_percent * len(words):
            return "navigation"
        if 100 * len(_NOT_SYMBOL.sub("", line)) > self.symbol_percent * chars:
            return "symbols"
        if len(words) <= self.boilerplate_words:
            low = lower_ascii(line)
            if any(phrase in low for phrase in BOILERPLATE):
                return "boilerplate"
        if len(words) < self.short_line and words[-1][-1] not in TERMINAL:
            return "punctuation"
        return None


def repeated_words(words: list[str]) -> int:
    """Words inside a three-word window that is found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        before = first.setdefault(window, i)
        if before != i:
            covered[i : i + 3] = covered[before : before + 3] = b"\x01\x01\x01"
    return sum(covered)


def judge_text(text: str | None, rules: LineRules = LineRules()) -> dict:
    """Counts, verdict and the lines that stay; see ``clean_lines``."""
    words: list[str] = []
    seen: set[str] = set()
    kept_lines: list[str] = []
    chars = lost = dup_lines = n_symbols = removed_lines = 0
    for line in (text or "").split("\n"):
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        n_symbols += len(_NOT_SYMBOL.sub("", line))
        if line in seen:
            dup_lines += 1
        else:
            seen.add(line)
        words += own
        size = sum(map(len, own))
        chars += size
        if rules.fault(line, own, size):
            lost += size
            removed_lines += 1
        else:
            kept_lines.append(line)
    repeated = repeated_words(words)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": n_symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": not failed and 100 * lost <= rules.lost_percent * chars,
        "removed_lines": removed_lines,
        "lost_chars": lost,
        "cleaned": "\n".join(kept_lines),
    }


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, removed_lines bigint, lost_chars bigint"
)


def clean_lines(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    keep_text: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: counts over its whole text, failed lines and the verdict.

    Every line with a word is judged by navigation, symbol, boilerplate and punctuation rules; a
    document is kept if it passes the base limits and failed lines hold at most ``lost_percent`` of its
    word characters. ``keep_text`` adds the text without failed lines. A null or empty text has no
    words and fails; repeated rows each get their own row; a null id stays null.
    """

    def work(rows: dict) -> dict:
        found = [judge_text(t, rules) for t in rows["text"]]
        names = [n for n in judge_text(None) if keep_text or n != "cleaned"]
        return {"doc_id": rows["doc_id"]} | {n: [f[n] for f in found] for n in names}

    return map_batches(
        docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text"),
        work,
        SCHEMA + (", cleaned string" if keep_text else ""),
    )
