"""Operator 3: line-first cleaning.

Every line of a document is judged on its own: navigation (separators between words),
punctuation (no sentence end in the line, or symbols strewn over its words), shouting
(capitals), boilerplate (stock phrases, stuttered words, or a line equal to an earlier one).  Failing
lines are removed; a document that loses more than MAX_LOST_PCT of its words is rejected,
as is one that fails the base rules (under 20 words, or over 30 % of its words in 8-word
windows that occur twice or more).  :func:`clean` returns the cleaned text and, per rule,
the number of lines it removed.

Words are runs of bytes other than space and \\t..\\r; lines are split at \\n.

Defined cases: NULL and empty text have no words and are rejected (cleaned text NULL and
""); a text of any length is judged whole; repeated rows get equal verdicts; extra columns
are carried, those named like an output column are replaced; no documents give no rows.
One map step per document, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame

from sessionrate.llm.common import map_text

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
MAX_LOST_PCT = 40         # of its words that a kept document may lose
SYMBOL_PCT = 30           # symbol characters per 100 words of a line
NAV_PCT = 20              # separators among the words of a line
CAPS_PCT = 60             # words in capitals, lines of CAPS_WORDS or more
CAPS_WORDS = 3
LONG_TEXT = 100_000       # words; longer texts find their repeats as numbers
STUTTER_PCT = 50          # words equal to the word before, lines of STUTTER_WORDS or more
STUTTER_WORDS = 5

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
SEPARATORS = frozenset(x.encode() for x in ("|", "»", "›", "•", "·", "/", "::"))
SENTENCE_END = re.compile(rb"""(?:[.!?:;]|\xe2\x80\xa6|\xe3\x80\x82)["')\]]*(?:[ \t\x0b\x0c\r]|$)""")
#: stock phrases, lower case
BOILERPLATE = (b"javascript", b"cookie policy", b"accept cookies", b"all rights reserved",
               b"terms of use", b"terms of service", b"privacy policy", b"lorem ipsum",
               b"click here", b"sign up for our newsletter", b"skip to content",
               b"share on facebook", b"powered by")
RULES = ("nav", "symbols", "caps", "punct", "boilerplate", "repeated")

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, words_lost long, "
          + ", ".join(f"lines_{r} long" for r in RULES))


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur twice or more."""
    if len(words) > LONG_TEXT:
        return _repeat_words_long(words, width)
    windows = list(zip(*[words[i:] for i in range(width)]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = reach = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + width - max(i, reach)
            reach = i + width
    return covered


def _repeat_words_long(words: list[bytes], width: int) -> int:
    """The same in bounded memory: windows as numbers, by joining numbers of their halves."""
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    codes, size = one, 1
    while size < width:
        step = min(size, width - size)
        pairs = codes[:len(codes) - step] * (codes.max() + 1) + codes[step:]
        codes, size = np.unique(pairs, return_inverse=True)[1], size + step
    again = np.flatnonzero(np.bincount(codes)[codes] > 1)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + width, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def line_fault(line: bytes, words: list[bytes], stock: bool) -> str | None:
    """First rule that a line (with words) breaks."""
    n = len(words)
    if 100 * sum(w in SEPARATORS for w in words) >= NAV_PCT * n:
        return "nav"
    if 100 * (len(line) - len(line.translate(None, SYMBOLS))) > SYMBOL_PCT * n:
        return "symbols"
    if n >= CAPS_WORDS and 100 * sum(map(bytes.isupper, words)) > CAPS_PCT * n:
        return "caps"
    if not SENTENCE_END.search(line):
        return "punct"
    if stock and any(p in line.lower() for p in BOILERPLATE):
        return "boilerplate"
    if n >= STUTTER_WORDS and 100 * sum(map(eq, words, words[1:])) > STUTTER_PCT * n:
        return "repeated"
    return None


def judge(text: str | None) -> tuple[dict, str | None]:
    """Counts and verdict of one text, and the text without its failing lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    low = raw.lower()
    stock = any(p in low for p in BOILERPLATE)
    faults, lost, dup, seen, good = Counter(), 0, 0, set(), []
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            good.append(line)
            continue
        again = line in seen
        seen.add(line)
        dup += again
        fault = line_fault(line, own, stock) or ("repeated" if again else None)
        if fault:
            faults[fault] += 1
            lost += len(own)
        else:
            good.append(line)
    n = len(words)
    repeat = repeat_words(words)
    base_failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
    spaces = len(raw) - len(raw.translate(None, SPACE))
    row = {"n_words": n, "word_chars": len(text or "") - spaces,
           "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)), "n_dup_lines": dup,
           "n_repeat_words": repeat, "base_failed": base_failed,
           "kept": not base_failed and 100 * lost <= MAX_LOST_PCT * n, "words_lost": lost,
           **{f"lines_{r}": faults[r] for r in RULES}}
    cleaned = None if text is None else b"\n".join(good).decode("utf-8", "surrogatepass")
    return row, cleaned


def _judge_batch(texts, with_text):
    out = [judge(t) for t in texts]
    cols = {k: [r[k] for r, _ in out] for k in (out[0][0] if out else ())}
    if with_text:
        cols["clean_text"] = [t for _, t in out]
    return cols


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and verdict per document; the text is not carried."""
    return map_text(docs, lambda t: _judge_batch(t, False), FIELDS, text, drop=(text,))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, counts, verdict and ``clean_text``."""
    return map_text(docs, lambda t: _judge_batch(t, True), FIELDS + ", clean_text string", text)
