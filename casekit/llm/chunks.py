"""Fast exact use of the public tokenizer files inside a task.

A text is cut before every space that is followed by a non-space.  No pre-token of
the vocabularies used here crosses such a cut, so the ids of the text are the ids of
its chunks one after the other.  Arrow splits and dictionary-encodes a slice of texts,
each distinct chunk is encoded once by the ``tokenizers`` library, and numpy gathers the
ids.  Texts that hold a special-token string are encoded whole, texts
with runs of white space are cut by a pattern.

The table of known chunks is kept per worker process and emptied at a fixed number of
entries; texts are taken in slices of a few megabytes; so memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np

# A space followed by white space must stay with what stands before it.
_SPACES = r"\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WIDE = f" [{_SPACES}]| $"                        # Arrow's pattern syntax
_CUT = re.compile("(?= [^" + re.sub(r"x\{(\w+)\}", lambda m: "u" + m[1].zfill(4), _SPACES) + "])")


def split_chunks(text: str) -> list[str]:
    """Chunks whose concatenation is the text; all but the first begin with a space."""
    return _CUT.split(text)


def slices(texts, max_bytes: int = 4 << 20, max_rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of rows of an Arrow text array with about ``max_bytes`` each."""
    import pyarrow.compute as pc
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    at, n = 0, len(texts)
    while at < n:
        before = ends[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right"))),
                 at + max_rows, n)
        yield at, to
        at = to


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[0], ..., starts[0] + sizes[0] - 1, starts[1], ..."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
    at += np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
    return at


class Values:
    """One or more integers of each of many strings, in a few arrays for all."""

    def __init__(self):
        self.slot: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32)

    def __len__(self) -> int:
        return len(self.slot)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])

    def add(self, new: list[str], values: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct strings that are not known yet, and their values one after the other."""
        n = len(self.slot)
        self.flat = self._room(self.flat, self.used + len(values))
        self.start, self.size = self._room(self.start, n + len(new)), self._room(self.size, n + len(new))
        self.flat[self.used:self.used + len(values)] = values
        self.start[n:n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + len(new)] = sizes
        self.used += len(values)
        self.slot.update(zip(new, range(n, n + len(new))))

    def slots(self, keys: list[str], compute: Callable) -> np.ndarray:
        """Places of the strings; ``compute(new ones) -> (flat values, sizes)``."""
        out = np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            again = [keys[k] for k in missing.tolist()]
            new = list(dict.fromkeys(again))
            self.add(new, *compute(new))
            out[missing] = np.fromiter(map(self.slot.get, again), np.int64, len(again))
        return out

    def __getitem__(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the strings at these places, and how many each has."""
        sizes = self.size[slots]
        return self.flat[ragged(self.start[slots], sizes)], sizes


def strings(texts) -> list[str]:
    """An Arrow string array without nulls as a list (``to_pylist`` makes an Arrow scalar of each)."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class ChunkTable:
    """Values of chunks (one or more integers each), computed once per distinct chunk.

    ``compute(list of chunks) -> (flat values, sizes)``; ``whole(text) -> values`` is used
    for texts that hold a special-token string.
    """

    def __init__(self, compute: Callable, whole: Callable, special: list[str],
                 max_entries: int = 1_000_000):
        self.compute, self.whole, self.max_entries = compute, whole, max_entries
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known = Values()

    def _slots(self, chunks: list[str]) -> np.ndarray:
        """Places of chunks in the table; new ones are computed."""
        return self.known.slots(chunks, self.compute)

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Values of all texts of an Arrow string array, and the offsets of each text."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.known) > self.max_entries:
            self.known = Values()
        texts = texts.cast(pa.string()).fill_null("")
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        odd = pc.match_substring_regex(texts, _WIDE)
        if self.special is not None:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.special.pattern))
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        plain = pc.if_else(odd, "", texts) if len(odd_at) else texts
        parts = pc.split_pattern(plain, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        values = parts.values
        head = np.zeros(len(values), bool)
        head[offsets[:-1]] = True
        heads = values.filter(pa.array(head)).dictionary_encode()
        rest = values.filter(pa.array(~head)).dictionary_encode()
        slots = np.empty(len(values), np.int64)
        # a chunk after a space is looked up with its space
        slots[head] = self._slots(strings(heads.dictionary))[heads.indices.to_numpy()]
        slots[~head] = self._slots([" " + c for c in strings(rest.dictionary)])[
            rest.indices.to_numpy()] if len(rest) else 0
        ids, sizes = self.known[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        if len(odd_at):
            pieces = np.split(ids, ends[1:-1])
            for k in odd_at.tolist():
                text = texts[k].as_py()
                if self.special is not None and self.special.search(text):
                    pieces[k] = np.asarray(self.whole(text), np.uint32)
                else:
                    own = self._slots(list(dict.fromkeys(chunks := split_chunks(text))))
                    at = dict(zip(dict.fromkeys(chunks), own.tolist()))
                    own = np.fromiter((at[c] for c in chunks), np.int64, len(chunks))
                    pieces[k] = self.known[own][0]
            ids = np.concatenate(pieces)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return ids, ends.astype(np.int64)


_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_AFTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n\r\t"
#: A word of letters of ASCII and Latin-1 up to a sure pre-token boundary.
_WORD = re.compile(f" ?[{_LETTERS}]++(?=[{re.escape(_AFTER)}]|\\Z)")


class PieceEncoder:
    """Ids of chunks.  A chunk that begins with a plain word is that word and a rest.  The
    word is one pre-token and goes straight to the library's merge model; the rest, and any
    other chunk, goes through the whole library.  Both are remembered."""

    def __init__(self, tok, lower: bool, max_entries: int = 400_000):
        self.tok, self.model, self.lower, self.max_entries = tok, tok.model, lower, max_entries
        # line breaks keep words apart
        self.bytes_as = {b: ord(c) for b, c in enumerate(byte_symbols()) if b != ord("\n")}
        self.known = Values()

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, and how many each has."""
        text = "\n".join(words)
        if self.lower:
            text = text.replace(" ", "").lower()
        symbols = text.encode().decode("latin-1").translate(self.bytes_as).split("\n")
        ids, sizes = array("I"), []
        for found in map(self.model.tokenize, symbols):
            ids.extend([t.id for t in found])
            sizes.append(len(found))
        return np.frombuffer(ids, np.uint32), np.array(sizes, np.int64)

    def _others(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any other texts."""
        found = []
        for at in range(0, len(texts), 4096):
            found += [e.ids for e in self.tok.encode_batch_fast(texts[at:at + 4096], add_special_tokens=False)]
        return (np.fromiter(chain.from_iterable(found), np.uint32),
                np.fromiter(map(len, found), np.int64, len(found)))

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.max_entries:
            self.known = Values()
        known = self.known
        if not len(known):
            known.add([""], np.empty(0, np.uint32), np.zeros(1, np.int64))
        heads = [m[0] if m else "" for m in map(_WORD.match, chunks)]
        tails = [c[len(h):] for c, h in zip(chunks, heads)]
        both = np.column_stack([known.slots(heads, self._words), known.slots(tails, self._others)])
        values, sizes = known[both.ravel()]
        return values, sizes.reshape(-1, 2).sum(axis=1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where it is printable, else the next free one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def id_table(path: str, **options) -> ChunkTable:
    """Token ids by the library's file at ``path``: a byte-level vocabulary that keeps
    spaces, or one that lowers case and drops them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    keeps = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
    lowers = steps == ["NFC", "Replace", "Lowercase"]
    if not (keeps or lowers):
        raise ValueError(f"{path}: chunks are not known to be independent in this vocabulary")
    return ChunkTable(PieceEncoder(tok, lowers),
                      lambda text: tok.encode(text, add_special_tokens=False).ids,
                      [t["content"] for t in spec["added_tokens"]], **options)


_TABLES: dict[str, ChunkTable] = {}


def ids_of(path: str) -> ChunkTable:
    """One table per worker process and file."""
    if path not in _TABLES:
        _TABLES[path] = id_table(path)
    return _TABLES[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
