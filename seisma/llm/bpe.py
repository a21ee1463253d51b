"""BPE encoding with forced boundaries.

No merge can join two symbols that stand next to each other inside no
vocabulary token, so a cut there is certain whatever the surroundings.  The
table of adjacent symbol pairs is read off the vocabulary once; every
pre-token falls apart at pairs outside that table, each fragment is encoded on
its own (lowest merge rank first) and the ids are concatenated.  White space
never occurs inside a token of a tokenizer that drops it, which makes every
space a certain cut too, and pre-tokens can be remembered.

Normalisation, pre-tokenization and added tokens follow the tokenizer's file.
Only BPE models over byte symbols, without byte fallback, unknown token or
dropout, are taken; others raise ValueError.

Defined results: a null text encodes as the empty text (no ids, empty decoded
text); repeated rows give repeated results; other columns are left aside.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisma.llm.chunks import Memory, byte_symbols, cuts_at_space, library, pieces, plain, plain_splitter
from seisma.llm.tables import slices, tidy

#: Pre-tokens remembered by a worker, and as many older ones.
_KEEP = 150_000
#: Fragments of more symbols are merged by a heap.
_LONG = 64


class FragmentBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        self.library = library(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model = made["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token") or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("a plain BPE model over byte symbols is needed")
        if made.get("post_processor"):
            raise ValueError("a tokenizer without post-processor is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.ignore_merges: bool = bool(model.get("ignore_merges"))
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: k for k, m in enumerate(merges)}
        self.inside = {pair for token in self.ids for s in [self.symbols(token)] for pair in zip(s, s[1:])}
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.added = added
        self.special = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.spaced = cuts_at_space(path)
        self.token = {i: t for t, i in {**self.ids, **added}.items()}
        self.split = plain_splitter(path) if self.spaced and self.library.decoder is None else None
        self.symbol = {b: c for c, b in byte_symbols().items()}
        self.pairs = Memory(self._pair, _KEEP)  # pre-tokens of plain texts
        self.known = Memory(self._known, _KEEP // 4)  # chunks of other texts, and their pre-tokens
        self.words = Memory(self._word, _KEEP // 4)

    def symbols(self, token: str) -> list[str]:
        """The symbols a token is made of; the word end belongs to the last one."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _merge(self, s: list[str]) -> list[str]:
        """Join the neighbours of lowest rank, leftmost first, until no pair has a rank."""
        if len(s) > _LONG:
            return self._merge_long(s)
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in zip(s, s[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            s[i : i + 2] = [s[i] + s[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((s[i - 1], s[i]), none)
            if i < len(ranks):
                ranks[i] = rank((s[i], s[i + 1]), none)
        return s

    def _merge_long(self, s: list[str]) -> list[str]:
        """The same with a heap of ranked pairs over a linked list: a long run costs little more than its length."""
        rank, n = self.rank.get, len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, p in enumerate(zip(s, s[1:])) if (r := rank(p)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if s[i] is None or j >= n or rank((s[i], s[j])) != r:
                continue  # one of the two has been joined elsewhere
            s[i] += s[j]
            s[j] = None
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (r := rank((s[i], s[k]))) is not None:
                    heappush(heap, (r, i))
            if h >= 0 and (r := rank((s[h], s[i]))) is not None:
                heappush(heap, (r, h))
        return [x for x in s if x is not None]

    def fragments(self, word: str) -> list[list[str]]:
        """A pre-token's symbols, cut at every pair that no vocabulary token holds."""
        s = list(word)
        if self.end:
            s[-1] += self.end
        cuts = [0, *(i for i in range(1, len(s)) if (s[i - 1], s[i]) not in self.inside), len(s)]
        return [s[a:b] for a, b in zip(cuts, cuts[1:])]

    def _word(self, word: str) -> tuple[int, ...]:
        if self.ignore_merges and word + self.end in self.ids:
            return (self.ids[word + self.end],)
        return tuple(self.ids[t] for f in self.fragments(word) for t in self._merge(f) if t in self.ids)

    def plain(self, text: str) -> list[int]:
        t = self.library
        if t.normalizer is not None:
            text = t.normalizer.normalize_str(text)
        words = [w for w, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer is not None and text else [text]
        return [i for w in words if w for i in self.words[w]]

    def chunk(self, text: str) -> list[int]:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return [i for k, part in enumerate(self.special.split(text)) for i in ([self.added[part]] if k % 2 else self.plain(part) if part else [])]

    def _pair(self, word: str) -> tuple[bytes, bytes]:
        return self._both(self._word("".join([self.symbol[b] for b in word.encode()])))

    def _both(self, ids: Sequence[int]) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), " ".join([self.token[i] for i in ids]).encode()

    def _known(self, chunk: str) -> tuple[bytes, bytes]:
        return self._both(self.chunk(chunk))

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """The ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        text = text or ""
        flat = text.replace("\n", " ")
        if self.split is not None and plain(flat) and not (self.special and self.special.search(flat)):
            got = list(map(self.pairs.__getitem__, self.split(flat)))
        else:
            got = list(map(self.known.__getitem__, pieces(text, True))) if self.spaced else [self._known(text)]
        ids = b"".join([g[0] for g in got])
        if self.library.decoder is None:
            return ids, b" ".join([g[1] for g in got if g[1]])
        return ids, self.library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False).encode()


@lru_cache(maxsize=2)
def encoder(path: str) -> FragmentBpe:
    return FragmentBpe(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded (string)."""
    return _each(docs, path, doc_id, text, "ids array<int>, decoded string", lambda ids, decoded: (
        np.frombuffer(ids, "<u4").astype(np.int32), decoded.decode()), [pa.list_(pa.int32()), pa.string()])


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _each(docs, path, doc_id, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", lambda ids, decoded: (
        len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()), [pa.int64(), pa.string(), pa.string()])


def _each(docs: DataFrame, path: str, doc_id: str, text: str, fields: str, result, kinds: list[pa.DataType]) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", *(x.split()[0] for x in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in (part for whole in batches for part in slices(whole, 1)):
            rows = [result(*bpe.encode(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=names)

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(tidy(run), f"doc_id {kind}, {fields}")
