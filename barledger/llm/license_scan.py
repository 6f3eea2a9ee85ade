"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

A document's candidate passages are its lines, its paragraphs, from each line on the runs of adjoining lines that come
nearest to the length of each template, and its whole text; whole texts are also compared with full licences. Each is a TF-IDF vector over the templates' words,
with all other words in one further coordinate, so that prose around a notice lowers its cosine. Document frequencies
come from all documents. A document that is a licence as a whole licenses its directory; documents without a notice of
their own inherit from the nearest ancestor directory that has one, by a join on paths.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import PLAIN_WORDS, Texts, Words, bounded
from barledger.llm.shared import bound_batches, join_small, stored

#: Notices and opening lines of licences, by name: fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Full licences: name, file, and words that such a text has in a row, as licences differ by little more than those.
BODIES: tuple[tuple[str, str, str], ...] = (
    ("MIT", "MIT", "permission is hereby granted free of charge"),
    ("ISC", "ISC", "provided that the above copyright notice"),
    ("BSD-2-Clause", "BSD-2-Clause", "redistributions in binary form"),
    ("BSD-3-Clause", "BSD-3-Clause", "neither the name"),
    ("Apache-2.0", "Apache-2.0", "apache license version 2 0"),
    ("GPL-3.0", "GPL-3.0", "gnu general public license version 3 29 june 2007"),
    ("LGPL-3.0", "LGPL-3.0", "gnu lesser general public license version 3 29 june 2007"),
    ("AGPL-3.0", "GPL-3.0", "gnu affero general public license version 3 19 november 2007"),
    ("MPL-2.0", "MPL-2.0", "mozilla public license version 2 0"),
    ("CC0-1.0", "CC0-1.0", "cc0 1 0 universal"),
)
THRESHOLD = 0.8
#: Lines whose runs are made at a time, and passages that are compared at a time.
LINES, PASSAGES = 20_000, 4096
#: Share of a document's words in notices from which it is a licence file.
FILE_SHARE = 0.5


def bodies() -> list[str]:
    """The text of each of BODIES."""
    return [(Path(__file__).parent / "licences" / f"{file}.txt").read_text(encoding="utf-8") for _, file, _ in BODIES]


def template_words(templates: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Word hashes of each template, and all of them, sorted."""
    texts = Texts([text.encode() for text in templates], lower=True)
    words = Words(texts, PLAIN_WORDS)
    each = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return each, np.unique(words.hashes)


def positions(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The index of each hash in vocabulary, its size where it is absent."""
    at = np.searchsorted(vocabulary, hashes)
    at[at < len(vocabulary)] = np.where(
        vocabulary[at[at < len(vocabulary)]] == hashes[at < len(vocabulary)], at[at < len(vocabulary)], len(vocabulary)
    )
    return at


def word_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many texts each word of the vocabulary occurs, and the number of texts: one row a word to the driver."""

    def count(batches):
        total, n = np.zeros(len(vocabulary) + 1, dtype=np.int64), 0
        for batch in bounded(batches, 0):
            texts = Texts(batch.column(0), lower=True)
            words = Words(texts, PLAIN_WORDS)
            at = positions(vocabulary, words.hashes)
            known = at < len(vocabulary)
            cell = np.unique(words.doc[known] * len(vocabulary) + at[known])
            total[:-1] += np.bincount(cell % len(vocabulary), minlength=len(vocabulary))
            n += texts.n
        total[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    for word, n in rows.collect():
        out[word] = n
    return out[:-1], int(out[-1])


class Matcher:
    """Cosines of passages to the templates."""

    def __init__(self, vocabulary: np.ndarray, each: list[np.ndarray], frequency: np.ndarray, n: int):
        self.vocabulary = vocabulary
        #: The last coordinate is of all words outside the vocabulary, as rare as can be.
        self.idf = np.append(np.log((1 + n) / (1 + frequency)) + 1, np.log(1 + n) + 1)
        rows = np.stack([np.bincount(positions(vocabulary, x), minlength=len(self.idf)) for x in each]) * self.idf
        self.templates = rows / np.linalg.norm(rows, axis=1, keepdims=True)

    def near(self, at: np.ndarray, first: np.ndarray, last: np.ndarray, threshold: float) -> np.ndarray:
        """Which of the passages [first : last] of words (positions in the vocabulary) may reach the threshold, by a bound."""
        known = at < len(self.vocabulary)
        before = lambda values: np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
        known_before = before(known.astype(np.float64))
        size = last - first
        some = np.flatnonzero(2 * (known_before[last] - known_before[first]) > size)
        a, b = first[some], last[some]
        # a word that occurs k times weighs k * k in the norm, here only k
        square = before(np.where(known, self.idf[at] ** 2, 0.0))
        low = square[b] - square[a] + ((b - a) - (known_before[b] - known_before[a])) ** 2 * self.idf[-1] ** 2
        best = np.zeros(len(some))
        for template in self.templates:
            share = before((self.idf * template)[at])
            best = np.maximum(best, share[b] - share[a])
        return some[best >= (threshold - 1e-6) * np.sqrt(np.maximum(low, 1e-12))]

    def cosines(self, words: Words, of: np.ndarray, n: int) -> np.ndarray:
        """The cosine of each of n passages to each template, zero where few of its words are known."""
        at = positions(self.vocabulary, words.hashes)
        size, known = np.bincount(of, minlength=n), np.bincount(of[at < len(self.vocabulary)], minlength=n)
        out = np.zeros((n, len(self.templates)))
        for i in np.flatnonzero(2 * known > size):
            a, b = np.searchsorted(of, [i, i + 1])
            row = np.bincount(at[a:b], minlength=len(self.idf)) * self.idf
            out[i] = self.templates @ row / np.linalg.norm(row)
        return out

    def runs(
        self, at: np.ndarray, ends: np.ndarray, doc: np.ndarray, lengths: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """First and last words of the runs of adjoining() that near() leaves, found in ranges of LINES lines."""
        first, last = paragraphs(ends, doc)
        kept = self.near(at, first, last, threshold)
        found = [first[kept] * (len(at) + 1) + last[kept]]
        known = np.concatenate([[0], np.cumsum(at < len(self.vocabulary))])
        for first, last in adjoining(ends, doc, lengths, known):
            low, high = int(first.min()), int(last.max())
            kept = self.near(at[low:high], first - low, last - low, threshold)
            found.append(first[kept] * (len(at) + 1) + last[kept])
        spans = np.unique(np.concatenate(found))
        return spans // (len(at) + 1), spans % (len(at) + 1)

    def passages(self, at: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of n passages (word at[i] of the vocabulary belongs to passage of[i], ascending) the best template and
        its cosine."""
        known = np.bincount(of[at < len(self.vocabulary)], minlength=n)
        size = np.bincount(of, minlength=n)
        best, cosine = np.zeros(n, dtype=np.int64), np.zeros(n)
        few = np.flatnonzero(2 * known > size)  # below that no passage comes near the threshold
        place = np.full(n, -1)
        for low in range(0, len(few), PASSAGES):
            some = few[low : low + PASSAGES]
            place[some] = np.arange(len(some))
            a, b = np.searchsorted(of, [some[0], some[-1] + 1])
            mine = place[of[a:b]] >= 0
            cells = place[of[a:b][mine]] * len(self.idf) + at[a:b][mine]
            part = np.bincount(cells, minlength=len(some) * len(self.idf)).reshape(len(some), len(self.idf)) * self.idf
            scores = part @ self.templates.T / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
            best[some], cosine[some] = scores.argmax(axis=1), scores.max(axis=1)
        return best, cosine


def pieces(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each passage at[first : last], and the passage of each."""
    size = last - first
    of = np.repeat(np.arange(len(size)), size)
    return at[np.arange(len(of)) - (np.cumsum(size) - size)[of] + first[of]], of


def wordy_lines(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines (that end at words `ends`) with words, and the first word of every line."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return np.flatnonzero(ends > starts), starts


def paragraphs(ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of each run of lines of a text between lines without words."""
    wordy, starts = wordy_lines(ends)
    if not len(wordy):
        return wordy, wordy
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(wordy) > 1) | (np.diff(doc[wordy]) > 0)]))
    return starts[wordy[heads]], ends[wordy[np.append(heads[1:], len(wordy)) - 1]]


def adjoining(ends: np.ndarray, doc: np.ndarray, lengths: np.ndarray, known: np.ndarray):
    """Runs of several lines that end at words `ends` and belong to texts `doc`: first and last word (exclusive).

    From each line on, for each length, they are the runs next below and above it: a fixed number for each line. They come
    in parts, each of runs that begin in LINES lines, without those of which half the words or fewer are among the
    `known`, whose numbers before each word are given: they come near no template.
    """
    wordy, starts = wordy_lines(ends)
    first, own = starts[wordy], ends[wordy]
    final = ends[np.searchsorted(doc, doc[wordy], side="right") - 1] if len(wordy) else wordy
    for low in range(0, len(wordy), LINES):
        part = slice(low, low + LINES)
        below = np.searchsorted(own, first[part, None] + lengths, side="right") - 1
        to = np.clip(np.concatenate([below, below + 1], axis=1), 0, len(own) - 1)
        last = np.minimum(own[to], final[part, None])
        begin = np.broadcast_to(first[part, None], last.shape)
        several = (last > own[part, None]) & (2 * (known[last] - known[begin]) > last - begin)
        if several.any():
            span = np.unique(begin[several] * (own[-1] + 1) + last[several])
            yield span // (own[-1] + 1), span % (own[-1] + 1)


def own_licences(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, license, cosine, is_file of docs (doc_id, path, text); license is null without a notice."""
    each, vocabulary = template_words([text for _, text in TEMPLATES])
    full, full_vocabulary = template_words(bodies())
    every = np.union1d(vocabulary, full_vocabulary)
    frequency, n = word_frequencies(docs, every)
    matcher = Matcher(vocabulary, each, frequency[np.searchsorted(every, vocabulary)], n)
    whole_matcher = Matcher(full_vocabulary, full, frequency[np.searchsorted(every, full_vocabulary)], n)
    lengths = np.unique([len(x) for x in each])
    names = np.array([name for name, _ in TEMPLATES], dtype=object)
    body_names = [name for name, _, _ in BODIES]
    phrases = [f" {phrase} " for _, _, phrase in BODIES]

    def match(batches):
        for batch in bounded(batches, 2):
            texts = Texts(batch.column(2), lower=True)
            words = Words(texts, PLAIN_WORDS)
            breaks = np.flatnonzero(texts.bytes == 10)
            line = np.searchsorted(breaks, words.starts)
            at = positions(vocabulary, words.hashes)
            best, cosine = matcher.passages(at, line, len(breaks))
            whole, whole_cosine = matcher.passages(at, words.doc, texts.n)
            line_doc = np.searchsorted(texts.starts, breaks, side="right") - 1
            ends = np.searchsorted(words.starts, breaks)
            first, last = matcher.runs(at, ends, line_doc, lengths, threshold)
            run_best, run_cosine = np.zeros(len(first), dtype=np.int64), np.zeros(len(first))
            for low in range(0, len(first), PASSAGES):  # runs overlap, so their words are many more than the text's
                some = slice(low, low + PASSAGES)
                part = first[some], last[some]
                run_best[some], run_cosine[some] = matcher.passages(*pieces(at, *part), len(part[0]))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
            run_doc = words.doc[first]
            first, last = np.concatenate([starts, first]), np.concatenate([ends, last])
            best, cosine = np.concatenate([best, run_best]), np.concatenate([cosine, run_cosine])
            owner = np.concatenate([line_doc, run_doc])
            reached = np.zeros(len(words.doc) + 1, dtype=np.int64)
            np.add.at(reached, first[cosine >= threshold], 1)
            np.add.at(reached, last[cosine >= threshold], -1)
            noticed = np.bincount(words.doc, np.cumsum(reached)[:-1] > 0, texts.n)
            order = np.lexsort((last, first, -cosine, owner))  # a text's best passage, the first of equals
            top = order[np.searchsorted(owner[order], np.arange(texts.n))] if texts.n else order
            use_whole = whole_cosine >= cosine[top] if texts.n else np.zeros(0, bool)
            value = np.where(use_whole, whole_cosine, cosine[top])
            name = names[np.where(use_whole, whole, best[top])]
            found = value >= threshold
            is_file = found & (use_whole | (noticed >= FILE_SHARE * np.maximum(words.counts, 1)))
            scores = whole_matcher.cosines(words, words.doc, texts.n)
            for i in np.flatnonzero((scores >= threshold).any(axis=1)):
                raw = texts.bytes[texts.starts[i] : texts.starts[i + 1]].tobytes()
                spaced = f" {' '.join(re.findall('[a-z0-9]+', raw.decode()))} "
                fits = [(scores[i, k], k) for k, x in enumerate(phrases) if scores[i, k] >= threshold and x in spaced]
                if fits:
                    value[i], k = max(fits)
                    name[i], found[i], is_file[i] = body_names[k], True, True
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(name, pa.string(), mask=~found),
                    pa.array(np.where(found, value, 0.0)), pa.array(is_file),
                ],
                ["doc_id", "path", "license", "cosine", "is_file"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "path", "text").mapInArrow(
        match, f"doc_id {kind}, path string, license string, cosine double, is_file boolean"
    )


def directory(path: Column) -> Column:
    """All before the last slash; empty for a path without one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, path, license, cosine, is_file, inherited (a licence), inherited_from (a directory): a row for each of docs.

    A directory with licence files of several licences takes the one of the largest cosine, then of the smallest name.
    Null and empty texts have no notice; a null path is in no directory and inherits nothing. Repeated rows are scanned
    one by one. Other columns are not read. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    own = stored(own_licences(picked), "own")
    files = own.where("is_file AND path IS NOT NULL").select(directory(F.col("path")).alias("dir"), "license", "cosine")
    homes = files.groupBy("dir", "license").agg(F.max("cosine").alias("cosine"))
    homes = homes.groupBy("dir").agg(F.min_by("license", F.struct(-F.col("cosine"), "license")).alias("home"))
    homes = stored(homes, "directories")
    # directories are looked up once each, not once for each document in them
    wanted = own.where("license IS NULL AND path IS NOT NULL").select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    steps = wanted.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "up"))
    found = join_small(steps, homes.withColumnRenamed("dir", "up"), ["up"], "inner")
    nearest = found.groupBy("dir").agg(
        F.max_by("home", "depth").alias("inherited"), F.max_by("up", "depth").alias("inherited_from")
    )
    keyed = own.withColumn("dir", F.when(F.col("license").isNull(), directory(F.col("path"))))
    joined = join_small(keyed, stored(nearest, "nearest"), ["dir"], "left")
    return joined.select("doc_id", "path", "license", "cosine", "is_file", "inherited", "inherited_from")
