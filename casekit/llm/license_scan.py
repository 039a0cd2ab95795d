"""License scan: fuzzy search for short notices.

A text is read as words: A-Z in lower case, every ASCII character that is neither a letter
nor a digit between words.  Two searches over the words of a whole text:

* *phrases* must stand word by word;
* *notices* may be misspelt.  A notice of ``m`` characters allows ``k = m // chars_per_edit``
  edits.  It is cut into ``k + 1`` pieces, of which one must stand exactly (pigeonhole); all
  pieces of all notices are found in one pass of an Aho-Corasick automaton.  A hit says
  where the notice would start, give or take ``k`` characters.  The runs of whole words that
  start and end near there are candidates, and the regex library's bounded-error matching
  decides each and counts its edits.

A run of words matches a notice if their edit distance is at most ``k``.  Of overlapping
matches the strongest is reported: the one whose notice length less twice its edits is
greatest (then the first notice by name, the first run, the shortest).

Defined results
    * a null text is empty: no words, no places, null first and last word, score 0;
    * ``first_word`` and ``last_word`` are the least and greatest start of a phrase;
    * ``score`` is 1 if a phrase stands there, else 1 - edits / length of the best notice,
      0 without one;
    * repeated rows give repeated rows; a null id stays null; other columns are ignored;
    * an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# Phrases that must stand word by word, with their label.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))

# Short notices as words, with their label.
NOTICES = (
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the apache license", "apache"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by nd 4 0", "cc-by-nd-4.0"),
    ("creative commons attribution", "cc-by"),
    ("creative commons zero", "cc0-1.0"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl-1.0"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "proprietary"),
)

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, "
          "notices array<struct<label: string, notice: string, edits: int, first_word: int, "
          "words: int>>")

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def words_of(text: str | None) -> str:
    """The words of a text with one space between them."""
    if not text:
        return ""
    raw = text.encode("utf-8", "replace").translate(_WORDS)
    return b" ".join([w for w in raw.split(b" ") if w]).decode()


def pieces_of(notice: str, budget: int) -> list[tuple[int, str]]:
    """The ``budget + 1`` pieces of a notice with their places, of about equal length."""
    cuts = [len(notice) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """All phrases and notices, ready to search texts."""

    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES,
                 notices: Sequence[tuple[str, str]] = NOTICES, chars_per_edit: int = 10):
        import ahocorasick
        import regex
        self.phrases = [(f" {p} ", label) for p, label in phrases]
        self.notices = [(n, label, len(n) // chars_per_edit) for n, label in notices]
        # (?b): the match with the fewest edits
        self.fuzzy = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in self.notices]
        owners: dict[str, list[tuple[int, int]]] = {}
        for which, (n, _, k) in enumerate(self.notices):
            for at, piece in pieces_of(n, k):
                owners.setdefault(piece, []).append((which, at))
        self.seeds = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.seeds.add_word(piece, (len(piece), found))
        if owners:
            self.seeds.make_automaton()

    def phrase_places(self, words: str) -> list[tuple[int, str]]:
        """``(first word, label)`` of every place of a phrase."""
        padded, out = f" {words} ", []
        for phrase, label in self.phrases:
            at = padded.find(phrase)
            while at >= 0:
                out.append((padded.count(" ", 0, at), label))
                at = padded.find(phrase, at + 1)
        return out

    def notice_places(self, words: str) -> list[tuple[str, str, int, int, int]]:
        """``(label, notice, edits, first word, number of words)`` of every notice found."""
        near: dict[int, set[int]] = {}
        if self.notices:
            for last, (size, found) in self.seeds.iter(words):
                for which, at in found:
                    near.setdefault(which, set()).add(last + 1 - size - at)
        if not near:
            return []
        gaps = [-1, *(k for k, c in enumerate(words) if c == " "), len(words)]   # around the words
        matches = []
        for which, starts in near.items():
            notice, label, budget = self.notices[which]
            runs = set()
            for s in starts:
                first = bisect_left(gaps, s - budget - 1)
                while first < len(gaps) - 1 and gaps[first] < s + budget:
                    begin = gaps[first] + 1
                    last = bisect_left(gaps, begin + len(notice) - budget, first + 1)
                    while last < len(gaps) and gaps[last] <= begin + len(notice) + budget:
                        runs.add((first, last))
                        last += 1
                    first += 1
            for first, last in runs:
                edits = self._edits(which, words[gaps[first] + 1:gaps[last]])
                if edits is not None:
                    matches.append((2 * edits - len(notice), notice, first, last, label, edits))
        out: list[tuple[str, str, int, int, int]] = []
        taken: list[tuple[int, int]] = []                 # disjoint, in order
        for _, notice, first, last, label, edits in sorted(matches):
            k = bisect_left(taken, (first, last))
            if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or taken[k][0] >= last):
                taken.insert(k, (first, last))
                out.append((label, notice, edits, first, last - first))
        return sorted(out, key=lambda r: r[3])

    def _edits(self, which: int, run: str) -> int | None:
        """Least number of edits between the notice and a run of words, within the budget."""
        if run == self.notices[which][0]:
            return 0
        if not self.notices[which][2]:
            return None
        m = self.fuzzy[which].fullmatch(run)
        return sum(m.fuzzy_counts) if m else None

    def scan(self, text: str | None) -> tuple:
        """A row of ``RESULT`` without the id."""
        words = words_of(text)
        base, found = self.phrase_places(words), self.notice_places(words)
        labels = sorted({label for _, label in base})
        score = 1.0 if base else max((1.0 - r[2] / len(r[1]) for r in found), default=0.0)
        return (words.count(" ") + 1 if words else 0, len(base),
                min((w for w, _ in base), default=None), max((w for w, _ in base), default=None),
                ",".join(labels), ",".join(sorted({*labels, *(r[0] for r in found)})), score,
                [dict(zip(("label", "notice", "edits", "first_word", "words"), r)) for r in found])


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                  notices: Sequence[tuple[str, str]] = NOTICES, chars_per_edit: int = 10,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, phrases, notices, labels and score (a narrow map)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        scanner = Scanner(phrases, notices, chars_per_edit)
        place = pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()),
                           ("first_word", pa.int32()), ("words", pa.int32())])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(place)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "notices"]
        for b in batches:
            found = [scanner.scan(t) for t in b.column(1).to_pylist()]
            columns = zip(*found) if found else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return rows.mapInArrow(run, RESULT)
