"""Licence scans: TF-IDF cosine to templates, and inheritance from directories.

Every line of every file, each sentence and paragraph of neighbouring candidate lines,
and each whole file are compared with licence templates as sparse TF-IDF vectors.
Document frequencies are counted over all files: those of the templates' terms first,
and then those of the other terms of the spans that may still match. A file whose whole
text is a licence, or that is named like one, licenses its directory; a file without a
licence of its own takes that of the nearest directory above it, found by joining the
paths of its ancestors.

Only lines with an anchor of a template are candidates. A template's anchors are its
heaviest terms, as many as it takes for the others to be too light to reach the
threshold without them, so no line that could match is missed. A term weighs 1 at least,
so what a span's terms weigh at least tells which spans can't reach the threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import FEW_ROWS, columns, documents, lean, membership, sent_if_few, stored
from quire.llm.words import passes, utf8, word_hashes

THRESHOLD = 0.75
#: Share of a file's words that a licence must cover for the file to be a licence file.
WHOLE = 0.8
#: Tasks that the files of one folder are dealt to, where folders are too many to be sent to all files.
SALTS = 32
#: Names of licence files, fixed by custom.
NAMED = r"(?i)^(?:licen[cs]e|copying|notice|unlicense)(?:[._-].*)?$"

#: Notices and headers as licences word them: (SPDX id, text). Fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal, public domain dedication."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)

TERM = re.compile(rb"[a-z0-9]+")
SENTENCE = re.compile(rb"[^.!?;]+(?:[.!?;]+(?=\S)[^.!?;]+)*[.!?;]*")
#: All bytes but letters and digits of ASCII part terms.
PARTS = np.ones(256, bool)
PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def terms(text: str) -> list[str]:
    return [w.decode() for w in TERM.findall(text.encode().lower())]


def _hashes(words) -> np.ndarray:
    return np.array([x for w in words for x in word_hashes(*utf8(pa.array([w])), PARTS)[0]], np.uint64)


def frequencies(files: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """Rows of `files`, and in how many of them each of the given terms comes. Sums of a fixed number of terms."""
    h = _hashes(words)
    by = np.argsort(h)
    known = h[by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rows = np.zeros(len(words), np.int64), 0
        for b in batches:
            rows += b.num_rows
            data, at = utf8(b["text"])
            for lo, hi in passes(at):
                found, word_at, _, _ = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], PARTS)
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                hit = np.flatnonzero(known[place] == found)
                row = np.searchsorted(word_at, hit, "right") - 1
                pair = np.unique(row * len(words) + place[hit])
                count += np.bincount(pair % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *by.tolist()], pa.int32()), pa.array([rows, *count.tolist()], pa.int64())], ["term", "n"])

    got = {r.term: r.n for r in files.select("text").mapInArrow(lean(run), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return got.pop(-1, 0), {words[i]: n for i, n in got.items()}


class Matcher:
    """Templates as unit vectors, by the frequencies of their terms in `files` files."""

    def __init__(self, templates, files: int, df: dict[str, int], threshold: float = THRESHOLD):
        self.threshold, self.files = threshold, files
        every = {w for _, t in templates for w in terms(t)}
        self.idf = {w: 1 + math.log((files + 1) / (df.get(w, 0) + 1)) for w in every}
        self.names, self.vectors, anchors = [], [], set()
        for name, text in templates:
            v = {w: c * self.idf[w] for w, c in Counter(terms(text)).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {w: x / norm for w, x in v.items()}
            self.names.append(name)
            self.vectors.append(v)
            left = 1.0
            for w, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
                if left < threshold**2:
                    break
                anchors.add(w)
                left -= x * x
        self.anchors = tuple(sorted(anchors))

    def best(self, words: list[str]) -> tuple[float, int, float, dict[str, int]]:
        """Of a span: the product with the nearest template, the first of equals, and its number; the square of the norm of its known terms; its other terms."""
        count = Counter(words)
        v = {w: c * self.idf[w] for w, c in count.items() if w in self.idf}
        product, minus = max(((sum(x * v[w] for w, x in t.items() if w in v), -i) for i, t in enumerate(self.vectors)), default=(0.0, 0))
        return product, -minus, sum(x * x for x in v.values()), {w: c for w, c in count.items() if w not in v}

    def scan(self, low: bytes, hits: list[int]) -> list[tuple[float, int, float, dict[str, int], int]]:
        """(product, template, known, others, words) of each line, sentence, paragraph or whole text that may reach the threshold; and the words of the text last.

        low: the text in lower case; hits: ascending places of anchors in it.
        """
        spans: list[tuple[int, int]] = []
        for at in hits:
            if not spans or at >= spans[-1][1]:
                e = low.find(b"\n", at)
                spans.append((low.rfind(b"\n", 0, at) + 1, len(low) if e < 0 else e))
        joined: list[list[int]] = []
        for s, e in spans:
            if joined and s <= joined[-1][1] + 1:
                joined[-1][1] = e
            else:
                joined.append([s, e])
        every, near = {*spans, *map(tuple, joined), (0, len(low))}, iter(hits)
        hit = next(near, None)
        for s, e in spans:
            # a notice inside a line of other text: its sentence counts by itself
            for m in SENTENCE.finditer(low, s, e):
                while hit is not None and hit < m.start():
                    hit = next(near, None)
                if hit is not None and hit < m.end():
                    every.add(m.span())
        out = []
        for s, e in sorted(every):
            words = [w.decode() for w in TERM.findall(low[s:e])]
            product, template, known, others = self.best(words)
            if product > 0 and product / math.sqrt(known + sum(c * c for c in others.values())) >= self.threshold - 1e-12:
                out.append((product, template, known, others, len(words)))
        return out


def matcher(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> Matcher:
    words = sorted({w for _, t in templates for w in terms(t)})
    return Matcher(templates, *frequencies(files, words), threshold)


SPANS = "array<struct<product:double,template:int,known:double,words:int,whole:boolean,others:array<struct<term:bigint,n:int>>>>"


def candidates(files: DataFrame, m: Matcher) -> DataFrame:
    """`files` (row, path, text) by row and path with the spans that may be licences; `others` by hash of the term."""

    known = np.sort(_hashes(m.anchors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list = [[] for _ in range(b.num_rows)]
            data, at = utf8(b["text"])
            for lo, hi in passes(at):
                h, word_at, starts, _ = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], PARTS)
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = np.flatnonzero(known[place] == h)
                row = np.searchsorted(word_at, hit, "right") - 1
                for r in np.unique(row):
                    here = starts[hit[row == r]] - (at[lo + r] - at[lo])
                    total = int(word_at[r + 1] - word_at[r])
                    for product, template, norm, others, n in m.scan(data[at[lo + r] : at[lo + r + 1]].tobytes().lower(), here.tolist()):
                        terms_of = [{"term": int(np.int64(x.view(np.int64))), "n": c} for x, c in zip(_hashes(others), others.values(), strict=True)]
                        found[lo + r].append({"product": product, "template": template, "known": norm, "words": n, "whole": n >= WHOLE * total, "others": terms_of})
            kind = pa.list_(pa.struct([("product", pa.float64()), ("template", pa.int32()), ("known", pa.float64()), ("words", pa.int32()), ("whole", pa.bool_()), ("others", pa.list_(pa.struct([("term", pa.int64()), ("n", pa.int32())])))]))
            yield pa.RecordBatch.from_arrays([b["row"], b["path"], pa.array(found, kind)], ["row", "path", "spans"])

    return files.select("row", "path", "text").mapInArrow(lean(run), f"row long, path string, spans {SPANS}")


def term_files(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, files): in how many files each of the wanted terms (by hash) comes, summed up before the shuffle."""
    known = membership(wanted, "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b["text"])
            held = [np.zeros(0, np.int64)]
            for lo, hi in passes(at):
                h, word_at, _, _ = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], PARTS)
                hit = np.flatnonzero(known(h.view(np.int64)))
                pair = np.unique(np.stack([np.searchsorted(word_at, hit, "right") - 1, h[hit].view(np.int64)], 1), axis=0)
                held.append(pair[:, 1])
            term, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], ["term", "files"])

    return files.select("text").mapInArrow(lean(run), "term long, files long").groupBy("term").agg(F.sum("files").alias("files")).join(wanted, "term", "left_semi")


def own_licences(files: DataFrame, m: Matcher) -> DataFrame:
    """(row, path, license, score, whole) for each row of (row, path, text): its best span's licence, or null and 0.0."""
    found = stored(candidates(files, m))
    spans = found.select("row", F.posexplode("spans").alias("pos", "s")).select("row", "pos", "s.*")
    others = spans.select("row", "pos", "known", F.explode("others").alias("o")).select("row", "pos", "o.term", "o.n")
    wanted = stored(others.select("term").distinct())
    if not wanted.isEmpty():
        weight = F.col("n") * (1 + F.log(F.lit(m.files + 1) / (F.col("files") + 1)))
        more = others.join(stored(term_files(files, wanted)), "term").groupBy("row", "pos").agg(F.sum(weight * weight).alias("more"))
        spans = spans.join(more, ["row", "pos"], "left")
    else:
        spans = spans.withColumn("more", F.lit(None).cast("double"))
    spans = spans.withColumn("score", F.col("product") / F.sqrt(F.col("known") + F.coalesce("more", F.lit(0.0)))).filter(F.col("score") >= m.threshold - 1e-12)
    best = spans.groupBy("row").agg(F.max(F.struct("score", (-F.col("template")).alias("t"), "words", "whole")).alias("b"))
    names = F.array(*map(F.lit, m.names))
    best = best.select("row", F.get(names, -F.col("b.t")).alias("license"), F.least(F.col("b.score"), F.lit(1.0)).alias("score"), "b.whole")
    out = found.select("row", "path").join(sent_if_few(stored(best)), "row", "left")
    return out.withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn("whole", F.coalesce("whole", F.lit(False)))


def ancestors(path: Column) -> Column:
    """The directories above a path, nearest first, the root (empty) last."""
    parts = F.split(path, "/")
    up = F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1))
    return F.transform(up, lambda n: F.struct((F.size(parts) - n).alias("distance"), F.array_join(F.slice(parts, 1, n), "/").alias("directory")))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(path, license, score, own, directory) for each row of `files`, which has path and text.

    own tells whether the licence is in the file's text; else directory is the one
    that it comes from, or null without any licence. Between licence files of one
    directory the better match wins, then the name of the licence. A null text is
    empty, a null path has no directory, and repeated rows give repeated results.
    """
    files = files.select(F.monotonically_increasing_id().alias("row"), F.col("path").cast("string"), F.col("text").cast("string"))
    found = stored(own_licences(files, matcher(files, templates, threshold)))
    name = F.substring_index("path", "/", -1)
    of_dirs = found.filter(F.col("license").isNotNull() & F.col("path").isNotNull() & (F.col("whole") | name.rlike(NAMED)))
    of_dirs = of_dirs.withColumn("directory", F.when(F.instr("path", "/") > 0, F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")).otherwise(""))
    of_dirs = of_dirs.groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("d")).select("directory", F.col("d.license").alias("inherited"))
    # each directory is joined once, not each file: files share the answer of their directory
    bare = found.filter(F.col("license").isNull() & F.col("path").isNotNull())
    folder = F.when(F.instr("path", "/") > 0, F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")).otherwise("")
    folders = bare.select(folder.alias("folder")).distinct()
    near = folders.withColumn("up", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("distance"), F.col("folder").alias("directory"))), F.when(F.col("folder") != "", ancestors(F.col("folder"))).otherwise(F.expr("array()").cast("array<struct<distance:int,directory:string>>")))))
    near = near.select("folder", "up.distance", "up.directory").join(of_dirs, "directory")
    near = near.groupBy("folder").agg(F.min(F.struct("distance", "directory", "inherited")).alias("n")).select("folder", "n.directory", "n.inherited")
    rows = found.withColumn("folder", F.when(F.col("license").isNull(), folder))
    near = stored(near)
    if near.count() <= FEW_ROWS:
        out = rows.join(F.broadcast(near), "folder", "left")
    else:  # a folder may hold most files: it is dealt to many tasks
        near = near.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(near, ["folder", "salt"], "left")
    return out.select("path", F.coalesce("license", "inherited").alias("license"), "score", F.col("license").isNotNull().alias("own"), F.when(F.col("license").isNull(), F.col("directory")).alias("directory"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as the file source/lang/doc_id: its licence, own or inherited."""
    docs = columns(documents(spark, sf_dir), "doc_id", "source", "lang", "text")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    out = scan(docs.select(path.alias("path"), "text"))
    return out.select(F.expr("try_cast(substring_index(path, '/', -1) AS bigint)").alias("doc_id"), "path", "license", F.round("score", 9).alias("score"), "own", "directory")
