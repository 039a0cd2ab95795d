"""Token counts by heap-and-linked-list byte-pair merging.

Each pre-token is a linked list of byte symbols and a heap of adjacent pairs by merge
rank.  The lowest-rank pair is popped again and again, its two symbols become one and
the pairs with the new neighbours are pushed; the count is the number of initial
symbols minus the number of merges.  No ids are made.  Stale heap entries are
recognised by the symbols they were pushed with.

A distinct pre-token is counted once per worker process (bounded caches).

Defined results
    * null and empty texts have 0 bytes and 0 tokens;
    * a special-token string in a text is one token, as the library's default reads it;
    * texts of any length are counted whole;
    * other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .chunks import ChunkTable, byte_symbols, slices, tokenizer_path
from .common import ship

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class MergeCounter:
    """Counts tokens of a byte-level BPE ``.json`` vocabulary file."""

    def __init__(self, path: str, pattern: str | None = None, max_entries: int = 600_000):
        import public_tokenizers
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        # a symbol is an int: the bytes first, then each merge's product
        number = {s: i for i, s in enumerate(byte_symbols())}
        for a, b in pairs:
            number.setdefault(a + b, len(number))
        self.rules = {(number[a], number[b]): (rank, number[a + b])
                      for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut = (regex.compile("|".join(regex.escape(s) for s in sorted(
            self.special, key=len, reverse=True))) if self.special else None)
        self.words = regex.compile(pattern or public_tokenizers.PATTERN)
        self.max_entries = max_entries
        self.by_word: dict[str, int] = {}
        self.table = ChunkTable(self._chunks, lambda text: [self.count(text)], self.special)

    def merged(self, data: bytes) -> int:
        """Number of symbols left after all merges of one pre-token."""
        n = len(data)
        if n < 2:
            return n
        rules, sym = self.rules, list(data)
        right = list(range(1, n + 1))     # right[i] == n: no neighbour
        left = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rule = rules.get((sym[i], sym[i + 1]))
            if rule:
                heap.append((rule[0], i, sym[i], sym[i + 1], rule[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b, product = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                   # one of the two has been merged since
            sym[i], sym[j] = product, -1
            right[i] = k = right[j]
            merges += 1
            if k < n:
                left[k] = i
                rule = rules.get((product, sym[k]))
                if rule:
                    heapq.heappush(heap, (rule[0], i, product, sym[k], rule[1]))
            h = left[i]
            if h >= 0:
                rule = rules.get((sym[h], product))
                if rule:
                    heapq.heappush(heap, (rule[0], h, sym[h], product, rule[1]))
        return n - merges

    def _plain(self, text: str) -> int:
        total, words = 0, self.by_word
        for w in self.words.findall(text):
            n = words.get(w)
            if n is None:
                n = words[w] = self.merged(w.encode())
            total += n
        return total

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One value per chunk: its count."""
        if len(self.by_word) > self.max_entries:
            self.by_word.clear()
        return (np.fromiter(map(self._plain, chunks), np.uint32, len(chunks)),
                np.ones(len(chunks), np.int64))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.cut.split(text) if self.cut is not None else [text]
        return len(pieces) - 1 + sum(map(self._plain, pieces))

    def counts(self, texts) -> np.ndarray:
        """Counts of an Array of texts, through the table of known chunks."""
        out = []
        for at, to in slices(texts):
            values, ends = self.table(texts[at:to])
            total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends]
            out.append(np.diff(total))
        return np.concatenate(out) if out else np.empty(0, np.int64)


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """One counter (and its caches) per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: bytes, tokens, and whether the tokens exceed ``limit``.

    A narrow map over the scan; nothing is shuffled.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from casekit.llm.token_count import counter as get
        c = get(tokenizer_path(tokenizer))
        for b in batches:
            tokens = c.counts(b.column(1))
            n_bytes = pc.binary_length(b.column(1)).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), n_bytes, pa.array(tokens, pa.int64()),
                 pa.array(tokens > limit, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(run, RESULT)
