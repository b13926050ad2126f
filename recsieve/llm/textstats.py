"""Counts over whole texts, in numpy over Arrow slices: what the quality rules and the quality classifier look at.

Null is the empty text. Words are `[^\\x20\\x09-\\x0D]+`, lines are split at \\n, characters are code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from recsieve.llm.common import Words, full_starts, gram_hashes, mix, text_slices

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_other", "n_unique_words", "n_long_words"]

_SYMBOL, _UPPER, _LETTER, _DIGIT, _MARK, _OTHER = (np.zeros(256, dtype=bool) for _ in range(6))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_DIGIT[0x30:0x3A] = True
_MARK[list(b"!?")] = True
_OTHER[0x21:0x7F] = ~(_LETTER | _DIGIT)[0x21:0x7F]


def _first_of_text(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash, whether it is its text's first of that value, and whether the text has it several times."""
    own = mix(h ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    new = np.ones(len(own), dtype=bool)
    new[1:] = own[order[1:]] != own[order[:-1]]
    several = ~new
    several[:-1] |= ~new[1:]
    first, more = np.zeros(len(own), dtype=bool), np.zeros(len(own), dtype=bool)
    first[order], more[order] = new, several
    return first, more


def text_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text."""
    words = Words(data, offsets)
    n = len(offsets) - 1

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    out = np.zeros((n, len(NAMES)), dtype=np.int64)
    col = {name: out[:, i] for i, name in enumerate(NAMES)}
    col["n_words"][:] = np.diff(words.ptr)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    size = points[words.ends] - points[words.starts]
    col["word_chars"][:] = per_text(size, words.ptr)
    col["n_long_words"][:] = per_text(size > 12, words.ptr)
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_digits", _DIGIT), ("n_marks", _MARK), ("n_other", _OTHER)):
        col[name][:] = per_text(table[data], offsets)
    h, doc = words.hashes(), words.doc_of()
    if len(h):
        col["n_unique_words"][:] = per_text(_first_of_text(h, doc)[0], words.ptr)
        at = full_starts(words.ptr, 3)
        if len(at):
            again = at[_first_of_text(gram_hashes(h, 3)[at], doc[at])[1]]
            step = np.bincount(again, minlength=len(h) + 4) - np.bincount(again + 3, minlength=len(h) + 4)
            col["n_repeat_words"][:] = per_text(np.cumsum(step)[: len(h)] > 0, words.ptr)
    text = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        lines = [x for x in text[a:b].split(b"\n") if x and not x.isspace()]
        col["n_lines"][i] = len(lines)
        col["n_dup_lines"][i] = len(lines) - len(set(lines))
        col["n_ended_lines"][i] = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    return out


def stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's columns but text, and NAMES."""
    for batch in batches:
        keep = [c for c in batch.schema.names if c != "text"]
        for i, j, data, offsets in text_slices(batch.column("text")):
            out = text_stats(data, offsets)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), *(pa.array(np.ascontiguousarray(out[:, x])) for x in range(len(NAMES)))], names=[*keep, *NAMES])


SCHEMA = ", ".join(f"{x} long" for x in NAMES)
