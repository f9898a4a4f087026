"""License scans by an exact set-similarity join of text blocks with license templates.

A block matches a template when it holds at least a given share of the template's different words.
Words are ordered by how many documents of the whole table hold them, rare ones first. To reach the share a
block must hold one of the template's first words in that order (prefix filter), must have enough words
(length filter), and what is left of both after the first common word must still suffice (positional
filter). Only blocks that pass all three are compared. Blocks are windows twice as long as the
longest template, half overlapping, so every passage no longer than a template lies in one whole.

Templates are a parameter of bounded size and go to the tasks; the table is read twice and not moved.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.license_texts import TEXTS
from martloom.llm.rows import byte_texts

# Phrases that name a license by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices that license a text, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# The kinds of Creative Commons licenses in all their versions.
CREATIVE_COMMONS = tuple(
    (f"cc-{kind}", f"Licensed under CC {kind.upper()} {version}")
    for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
    for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
)

#: What `licensed` looks for: the notices, those of every kind, and paragraphs of license texts.
LICENSES = tuple(dict.fromkeys(TEMPLATES + CREATIVE_COMMONS + TEXTS))

THRESHOLD = 0.85
#: Templates of fewer different words are notices: all of their words must stand in order, with few others between.
NOTICE_WORDS = 10
NOTICE_GAP = 4
#: Templates go to every task, so there may only be so many words of them.
TEMPLATE_WORDS = 200_000


def _word_table() -> bytes:
    table = bytearray(range(256))
    for c in range(128):
        table[c] = ord(chr(c).lower()) if chr(c).isalnum() else 32
    return bytes(table)


_WORDS = _word_table()


def words_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""
    return data.translate(_WORDS).split()


class Templates:
    """Templates in the global order of their words, with an index of their prefixes."""

    def __init__(self, templates, threshold: float, frequency: dict[bytes, int]):
        rank = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in words_of(t.encode())}, key=lambda w: (frequency.get(w, 0), w)))}
        self.rank = rank
        self.labels = [label for label, _ in templates]
        self.sets = [sorted({rank[w] for w in words_of(t.encode())}) for _, t in templates]
        self.needed = [max(1, ceil(threshold * len(s) - 1e-9)) for s in self.sets]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (words, need) in enumerate(zip(self.sets, self.needed)):
            for at, w in enumerate(words[: len(words) - need + 1]):
                self.prefix.setdefault(w, []).append((t, at))
        self.longest = max((len(words_of(t.encode())) for _, t in templates), default=1)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word of the block, containment) of every block that reaches its template's share."""
        rank, step = self.rank, self.longest
        known = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
        places = [i for i, _ in known]
        blocks = {b for i, r in known if r in self.prefix for b in (i // step, i // step - 1) if b >= 0 or i < step}
        found = []
        for b in sorted({max(b, 0) for b in blocks}):
            lo, hi = bisect_left(places, b * step), bisect_left(places, (b + 2) * step)
            block = sorted({r for _, r in known[lo:hi]})
            tried: set[int] = set()
            for at, r in enumerate(block):
                for t, place in self.prefix.get(r, ()):
                    # r is the first common word of the two, as rarer ones would have been met before
                    if t in tried:
                        continue
                    tried.add(t)
                    own, need = self.sets[t], self.needed[t]
                    if len(block) < need or 1 + min(len(block) - at - 1, len(own) - place - 1) < need:
                        continue
                    common = len(set(own).intersection(block))
                    if common >= need:
                        found.append((t, b * step, common / len(own)))
        return found


class Licenses(Templates):
    """Templates that are told apart: short ones by all their words in order, long ones by those that others lack.

    Templates of one length class, up to a power of two, share blocks twice that long, so a short template is not
    looked for in the block of a long one. Where two labels are found over one another, and the words of the one
    template alone would do for the other, the one with more words holds.
    """

    def __init__(self, templates, threshold: float, frequency: dict[bytes, int]):
        super().__init__(templates, threshold, frequency)
        self.orders = [[self.rank[w] for w in words_of(t.encode())] for _, t in templates]
        self.notice = [len(s) < NOTICE_WORDS for s in self.sets]
        self.needed = [len(s) if short else need for s, need, short in zip(self.sets, self.needed, self.notice)]
        whole = [set(s) for s in self.sets]
        self.covers: list[set[int]] = [
            {u for u, other in enumerate(whole) if self.labels[u] != self.labels[t] and len(own & other) >= self.needed[t]}
            for t, own in enumerate(whole)
        ]
        self.telling = [set().union(*(own - whole[u] for u in over)) for own, over in zip(whole, self.covers)]
        # by length class, the templates that a word is one of the first of
        self.first: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for t, (words, need) in enumerate(zip(self.sets, self.needed)):
            size = 1 << max(0, len(self.orders[t]) - 1).bit_length()
            by_word = self.first.setdefault(size + NOTICE_GAP if self.notice[t] else size, {})
            for at, w in enumerate(words[: len(words) - need + 1]):
                by_word.setdefault(w, []).append((t, at))
        self.any_first = frozenset(w for by_word in self.first.values() for w in by_word)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word of the passage, containment) of every passage that no other template explains better."""
        rank = self.rank
        known = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
        if self.any_first.isdisjoint(r for _, r in known):
            return []
        places = [i for i, _ in known]
        spans: set[tuple[int, int, int, int]] = set()
        for step, by_word in self.first.items():
            blocks = {max(b, 0) for i, r in known if r in by_word for b in (i // step, i // step - 1)}
            for b in blocks:
                part = known[bisect_left(places, b * step) : bisect_left(places, (b + 2) * step)]
                block = sorted({r for _, r in part})
                tried: set[int] = set()
                for at, r in enumerate(block):
                    for t, place in by_word.get(r, ()):
                        if t in tried:
                            continue
                        tried.add(t)
                        own, need = self.sets[t], self.needed[t]
                        if len(block) < need or 1 + min(len(block) - at - 1, len(own) - place - 1) < need:
                            continue
                        common = set(own).intersection(block)
                        if len(common) >= need and self.telling[t] <= common:
                            spans.update((t, *x) for x in (self._in_order(t, part) if self.notice[t] else self._tight(common, part)))
        kept = []
        for t, lo, hi, n in sorted(spans):
            if not any(u in self.covers[t] and m > n and a <= hi and lo <= z for u, a, z, m in spans):
                kept.append((t, lo, n / len(self.sets[t])))
        return kept

    def _in_order(self, t: int, part: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(first, last, different words) of the passages that hold all words of the template in their order."""
        order, ends = self.orders[t], {}
        for k, (lo, r) in enumerate(part):
            if r != order[0]:
                continue
            n, hi = 0, lo
            for i, other in part[k:]:
                if i - lo >= len(order) + NOTICE_GAP:
                    break
                if other == order[n]:
                    n, hi = n + 1, i
                    if n == len(order):
                        ends[hi] = lo  # the last start before an end is the tightest
                        break
        return [(lo, hi, len(self.sets[t])) for hi, lo in ends.items()]

    @staticmethod
    def _tight(common: set[int], part: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(first, last, different words) of the shortest passage that holds all common words."""
        part = [(i, r) for i, r in part if r in common]
        held, left, best = Counter(), 0, None
        for i, r in part:
            held[r] += 1
            while held[part[left][1]] > 1:
                held[part[left][1]] -= 1
                left += 1
            if len(held) == len(common) and (best is None or i - part[left][0] < best[1] - best[0]):
                best = part[left][0], i
        return [(*best, len(common))] if best else []


def frequencies(docs: DataFrame, templates, text: str = "text") -> dict[bytes, int]:
    """In how many rows each word of the templates occurs, over the whole table."""
    wanted = frozenset(w for _, t in templates for w in words_of(t.encode()))

    def count(batches):
        for batch in batches:
            seen = Counter(w for data in byte_texts(batch) for w in wanted.intersection(words_of(data)))
            yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select(docs[text].alias("text")).mapInArrow(count, "word BINARY, n BIGINT")
    return {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def phrase_places(data: bytes, phrases=PHRASES) -> list[tuple[int, str]]:
    """(place, label) of every phrase among the words, places counted in words from 0."""
    joined = b" " + b" ".join(words_of(data)) + b" "
    found = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = joined.find(wanted)
        while at >= 0:
            found.append((joined.count(b" ", 0, at + 1) - 1, label))
            at = joined.find(wanted, at + 1)
    return sorted(found)


_LAYOUT = (
    "n_words BIGINT, n_base BIGINT, first_word BIGINT, last_word BIGINT, base_labels STRING, labels STRING, "
    "score DOUBLE, n_blocks BIGINT"
)


def scanned(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    kind_of: type[Templates] = Templates,
) -> DataFrame:
    """One row per row of `docs`: key, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    n_base counts the places of the fixed phrases. `labels` adds those of all templates that some block
    holds to the threshold; the score is the best share a block holds, 1 where a phrase stands and 0
    where nothing was found; n_blocks counts the matches. Null text has no words. Repeated rows give
    repeated results, an empty table none.
    """
    size = sum(len(words_of(t.encode())) for _, t in templates)
    if size > TEMPLATE_WORDS:
        raise ValueError(f"templates hold {size} words, more than the {TEMPLATE_WORDS} a task may get")
    found = kind_of(templates, threshold, frequencies(docs, templates, text))
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def scan(batches):
        for batch in batches:
            out = []
            for data in byte_texts(batch):
                words = words_of(data)
                base = phrase_places(data) if b"icense" in data.lower() else []
                matches = found.matches(words)
                own = {label for _, label in base}
                best = max([s for _, _, s in matches] + [1.0] * bool(base), default=0.0)
                labels = own | {found.labels[t] for t, _, _ in matches}
                first, last = (base[0][0], base[-1][0]) if base else (None, None)
                out.append((len(words), len(base), first, last, ",".join(sorted(own)), ",".join(sorted(labels)), best, len(matches)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.record_batch([batch.column("key"), *columns], [key, *(x.split()[0] for x in _LAYOUT.split(", "))])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(scan, f"`{key}` {kind}, {_LAYOUT}")


def licensed(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=LICENSES, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of `scanned`, with templates told apart as `Licenses` does; n_blocks counts the passages."""
    return scanned(docs, key, text, templates, threshold, Licenses)
