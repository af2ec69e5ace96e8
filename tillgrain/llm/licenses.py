"""License scans: fuzzy search of short notices by exact seeds, bounded-error matching and spans.

Texts are folded to words joined by single spaces (see common.FOLDED), so case, punctuation and line
breaks play no part. A notice of L characters may be met with up to L * ERROR_SHARE edits. By the
pigeonhole principle one of edits + 1 pieces of the notice then occurs unchanged: all pieces of all
notices are the seeds of one Aho-Corasick automaton, which is run over the whole text. Around every
seed the regex library looks for the best match with a bounded number of insertions, deletions and
substitutions. A match must start and end at word edges, which are part of the pattern. Of matches of a
notice that overlap the one with the fewest edits counts; the text before and after it is searched on.

Base phrases are places where a phrase's words stand consecutively; they always give their label.

Defined results: null and empty texts have no words, no labels, null places and score 0; ties between
equally good matches go to the first; repeated rows are answered one by one; an output column replaces
an input column of its name, other columns are kept.
"""

import bisect

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns, byte_texts, folded_words
from tillgrain.llm.decontaminate import word_spans

# The base phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening sentences of well-known licenses and usual notices, as folded words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license": "gpl",
    "you should have received a copy of the gnu lesser general public license": "lgpl",
    "you should have received a copy of the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution": "cc-by",
    "made available under the terms of the eclipse public license": "epl",
}
ERROR_SHARE = 0.08

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("edits", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)


def pieces(notice: str, parts: int) -> list[tuple[int, str]]:
    """The notice in so many pieces of nearly equal length, each with its offset."""
    cuts = [len(notice) * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices: dict[str, str] = NOTICES, share: float = ERROR_SHARE):
        self.notices = [(text, label, int(len(text) * share)) for text, label in notices.items()]
        self.patterns = [
            regex.compile(
                rf"(?b) (?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}(?= )"
            )
            for text, _, edits in self.notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (text, _, edits) in enumerate(self.notices):
            for offset, piece in pieces(text, edits + 1):
                seeds.setdefault(piece, []).append((k, offset))
        self.machine = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.machine.add_word(piece, (len(piece), uses))
        self.machine.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in a folded text, by notice and start; no two of a notice overlap."""
        near: dict[int, list[tuple[int, int]]] = {}
        for end, (length, uses) in self.machine.iter(text):
            for k, offset in uses:
                notice, _, edits = self.notices[k]
                low = end + 1 - length - offset - edits
                near.setdefault(k, []).append((max(0, low), low + len(notice) + 2 * edits))
        found = []
        for k, regions in near.items():
            at, to = -1, -1
            for low, high in sorted(regions):
                if low <= to:
                    to = max(to, high)
                    continue
                found += self._verify(k, text, at, to)
                at, to = low, high
            found += self._verify(k, text, at, to)
        return sorted(found)

    def _verify(self, k: int, text: str, low: int, high: int):
        """Matches in text[low:high] with the blanks around: the best ones, and those beside them."""
        notice, _, edits = self.notices[k]
        reach = len(notice) + edits
        # The blank before is part of the pattern: regex does not insert where a search begins.
        todo = [(max(0, low - 1), min(high + 1, len(text)))]
        while todo:
            low, high = todo.pop()
            window = 2 * reach + 2
            while high - low >= len(notice) - edits + 2:
                end = min(high, low + window)
                m = self.patterns[k].search(text[low:end])
                if m is None:
                    if end == high:
                        break
                    # No match starts before this place: it would have ended in the window.
                    low, window = end - reach - 1, 2 * reach + 2
                elif end < high and low + m.end() + reach + 1 > end:
                    window += reach  # one that overlaps it may reach out of the window and be better
                else:
                    yield k, low + m.start() + 1, low + m.end(), sum(m.fuzzy_counts)
                    todo += [(low + m.end(), high), (low, low + m.start() + 1)]
                    break


def phrase_places(text: str, phrase: str) -> list[int]:
    """Offsets of a phrase in a text of folded words that a blank precedes and follows."""
    found, at, sought = [], 0, f" {phrase} "
    while (at := text.find(sought, at)) >= 0:
        found.append(at + 1)
        at += 1
    return found


def scan_licenses(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns RESULT for every row of docs(text); matches are spans in code points of the text."""

    def make():
        scanner = Scanner()
        phrases = PHRASES

        def scan(text: bytes | None) -> dict:
            words = folded_words(text)
            folded = (b" " + b" ".join(words) + b" ").decode()
            base = [(at, p) for p in phrases for at in phrase_places(folded, p)]
            fuzzy = scanner.matches(folded)
            row = dict.fromkeys(RESULT.names) | {"n_words": len(words), "n_base": len(base)}
            base_labels = {phrases[p] for _, p in base}
            labels = base_labels | {scanner.notices[k][1] for k, *_ in fuzzy}
            row["base_labels"] = ",".join(sorted(base_labels))
            row["labels"] = ",".join(sorted(labels))
            row["score"] = 0.0
            row["matches"] = []
            if not labels:
                return row
            sizes = [len(w) for w in folded[1:-1].split(" ")]
            starts = (np.cumsum([n + 1 for n in sizes]) - sizes).tolist()
            if base:
                places = [bisect.bisect_left(starts, at) for at, _ in base]
                row["first_word"], row["last_word"] = min(places), max(places)
            best = [1 - edits / len(scanner.notices[k][0]) for k, _, _, edits in fuzzy]
            row["score"] = float(max(best + [1.0] * bool(base)))
            spans = [(a, a + len(p), phrases[p], 0) for a, p in base] + [
                (a, b, scanner.notices[k][1], edits) for k, a, b, edits in fuzzy
            ]
            for a, b, label, edits in sorted(spans):
                first = bisect.bisect_right(starts, a + (folded[a] == " ")) - 1
                last = bisect.bisect_left(starts, b) - 1
                ((start, end),) = word_spans(text, np.arange(first, max(first, last) + 1))
                row["matches"].append({"label": label, "start": start, "end": end, "edits": edits})
            return row

        def compute(texts):
            rows = [scan(text) for text in byte_texts(texts)]
            return {name: [row[name] for row in rows] for name in RESULT.names}

        return compute

    return append_columns(docs, make, ["text"], RESULT, keep)
