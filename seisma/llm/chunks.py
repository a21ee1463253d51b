"""Per-process memory of text chunks, for tokenizers that cut at white space.

Where no vocabulary token holds white space and the pre-tokenizer drops it, a
text's ids are those of its chunks between spaces and line ends, one after the
other.  Each worker process remembers what it has encoded, in two generations of up to
``LIMIT`` chunks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import numpy as np
from tokenizers import Tokenizer

LIMIT = 250_000
#: Longer keys are not remembered: in scripts without spaces a chunk is a whole line.
KEEP_CHARS = 64


class Memory(dict):
    """Results of ``make``; when full, the entries become the old generation, from which used ones return."""

    def __init__(self, make: Callable[[str], Any], limit: int = LIMIT):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> Any:
        got = self.old.get(key)
        return self.put(key, self.make(key) if got is None else got)

    def put(self, key: str, value: Any) -> Any:
        if len(key) > KEEP_CHARS:
            return value
        if len(self) >= self.limit:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=4)
def library(path: str) -> Tokenizer:
    """The library's tokenizer of a file, with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def cuts_at_space(path: str) -> bool:
    """Whether chunks between white space are encoded independently of each other."""
    t = library(path)
    end = getattr(t.model, "end_of_word_suffix", None) or ""
    symbols = (k.removesuffix(end) for k in t.get_vocab(with_added_tokens=False))
    if t.pre_tokenizer is None or any(len(k) > 1 and ("Ġ" in k or "Ċ" in k) for k in symbols):
        return False
    if any(x.lstrip or x.rstrip or any(c.isspace() for c in x.content) for x in t.get_added_tokens_decoder().values()):
        return False
    probe = [x[0] for x in t.pre_tokenizer.pre_tokenize_str("a b\nc")]
    return probe == ["a", "b", "c"] and t.encode("a b\nc", add_special_tokens=False).ids == [
        i for c in "abc" for i in t.encode(c, add_special_tokens=False).ids]


def pieces(text: str, spaced: bool) -> list[str]:
    """Chunks between spaces and line ends (other white space stays inside), or the whole text."""
    return text.replace("\n", " ").split(" ") if spaced else [text]


def plain(text: str) -> bool:
    """Printable Latin-1: nothing but the lower case can change in normalisation."""
    return text == "" or ((text.isascii() or max(text) < "\u0100") and text.isprintable())


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def plain_splitter(path: str) -> Callable[[str], list[str]] | None:
    """Pre-tokens of printable Latin-1 text without spaces, where the file's steps are plain ones on such text; else None."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = made.get("normalizer") or {}
    steps = steps.get("normalizers", [steps] if steps else [])
    split, *rest = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    if any(x["type"] not in ("NFC", "Lowercase") and not (x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"}) for x in steps):
        return None
    if split.get("type") != "Split" or split.get("behavior") != "Removed" or not split.get("invert") or "Regex" not in split["pattern"]:
        return None
    if [x["type"] for x in rest] != ["ByteLevel"] or rest[0]["add_prefix_space"] or rest[0]["use_regex"]:
        return None
    # within Latin-1 the letters and numbers can be named one by one, for the faster pattern library
    pattern = split["pattern"]["Regex"].replace(r"\p{L}", "A-Za-zªµºÀ-ÖØ-öø-ÿ").replace(r"\p{N}", "0-9²³¹¼½¾")
    if r"\p" in pattern:
        return None
    find = re.compile(pattern).findall
    return (lambda text: find(text.lower())) if any(x["type"] == "Lowercase" for x in steps) else find


#: The one pattern whose pre-tokens ``cut`` finds.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _OTHER, _LETTER, _NUMBER = range(4)
_LATIN = [chr(i) for i in range(256)]
_CLASSES = bytes(
    _SPACE if c in " \n" else _LETTER if c.isalpha() else _NUMBER if c.isnumeric() else _OTHER for c in _LATIN)
_LOWER = "".join(c.lower() for c in _LATIN).encode("latin-1")
#: Bytes of texts that ``plain`` accepts, line ends included.
_PLAIN = "".join(c for c in _LATIN if c.isprintable() or c == "\n").encode("latin-1")


def plain_bytes(text: str) -> bytes | None:
    """The text in Latin-1 where it is plain but for line ends, else None."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if raw.translate(None, _PLAIN) else raw


def cuts_by_class(path: str) -> bool:
    """Whether ``cut`` finds the pre-tokens of the file's tokenizer, which lower-cases, in plain texts."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = (made.get("normalizer") or {}).get("normalizers", [])
    if plain_splitter(path) is None or not any(x["type"] == "Lowercase" for x in steps):
        return False
    return made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _CUT


def cut(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Pre-tokens of plain texts in Latin-1, all texts at once.

    Returns the lower-cased pre-tokens one after the other, where each begins (and the last ends), and how
    many of them stand before each text (and in all).  A pre-token is a run of letters, one number or a run of
    other signs; an apostrophe that begins such a run takes a following s, t, m, d, re, ve or ll.
    """
    joined = b" ".join([b"", *texts, b"  "])
    low = np.frombuffer(joined.translate(_LOWER), np.uint8)
    kind = np.frombuffer(joined.translate(_CLASSES), np.uint8)
    starts = np.zeros(len(kind), dtype=bool)
    starts[1:] = kind[1:] != kind[:-1]
    starts |= kind == _NUMBER
    inside = kind != _SPACE
    starts &= inside
    quote = np.flatnonzero(starts & (low == ord("'")))
    if len(quote):
        a, b = low[quote + 1], low[quote + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for q, n in ((quote[one], 1), (quote[two], 2)):
            starts[q + 1] = False
            behind = q + n + 1
            starts[behind[kind[behind] == _LETTER]] = True
    begins = np.flatnonzero(starts[inside])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.concatenate([[0], np.cumsum(sizes)])  # the space before each text
    before = np.searchsorted(np.flatnonzero(starts), ends)
    return low[inside].tobytes(), np.append(begins, int(inside.sum())), before
