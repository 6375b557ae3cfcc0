"""License scans: TF-IDF cosine to templates, then directory inheritance.

Headers are windows of lines around each line that names a license, before and
after it, up to the length of the longest short template.  They, the whole
text and, in longer texts, windows as long as each licence body are compared
with the templates (notices, standard file headers, licence bodies) by the
cosine of sparse TF-IDF vectors; the inverse document frequencies count all
texts.  An SPDX tag names its license itself.  A file whose whole text is a
license, or little else, is a license file and covers its directory.  A file
without a license of its own inherits that of the nearest ancestor directory
that has one, found by joins of directory paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import free_name, materialize
from natspark.operators.joins import skew_join

# Short notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance "
                  "with the License.",
    "Apache-2.0 (short)": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT (grant)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                   "and associated documentation files, to deal in the Software without restriction.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are "
                    "permitted provided that the conditions of the BSD License are met.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
}


def _gnu(work: str, name: str, version: str, more: str) -> str:
    return (f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation, either version {version} of the License, or (at your "
            f"option) any later version. This {work} is distributed in the hope that it will be useful, but WITHOUT "
            "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this "
            f"{work}. If not, {more}.")


_WEB, _MAIL = "see https://www.gnu.org/licenses/", ("write to the Free Software Foundation, Inc., 51 Franklin Street, "
                                                    "Fifth Floor, Boston, MA 02110-1301 USA")
# The standard headers of source files.
HEADERS = {
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                           "except in compliance with the License. You may obtain a copy of the License at "
                           "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
                           "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                           "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                           "for the specific language governing permissions and limitations under the License.",
    "GPL-3.0 (header)": _gnu("program", "General Public License", "3", _WEB),
    "GPL-2.0 (header)": _gnu("program", "General Public License", "2", _MAIL),
    "LGPL-3.0 (header)": _gnu("library", "Lesser General Public License", "3", _WEB),
    "LGPL-2.1 (header)": _gnu("library", "Lesser General Public License", "2.1", _MAIL),
    "AGPL-3.0 (header)": _gnu("program", "Affero General Public License", "3", _WEB),
    "MPL-2.0 (header)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                        "of the MPL was not distributed with this file, You can obtain one at "
                        "https://mozilla.org/MPL/2.0/.",
    "BSD-3-Clause (header)": "Use of this source code is governed by a BSD-style license that can be found in the "
                             "LICENSE file.",
}


def licence_bodies() -> dict[str, str]:
    """The licence texts beside this module, by file name.  That of the AGPL
    is made from the GPL's: its name throughout, and its section 13."""
    texts = resources.files(__package__).joinpath("license_texts").iterdir()
    out = {f"{f.name.removesuffix('.txt')} (text)": f.read_text() for f in sorted(texts, key=lambda f: f.name)}
    gpl = re.sub(r"(?i)\bGNU\s+General\s+Public", "GNU Affero General Public", out["GPL-3.0 (text)"])
    out["AGPL-3.0 (text)"] = gpl + (
        "Remote Network Interaction. Notwithstanding any other provision of this License, if you modify the Program, your "
        "modified version must prominently offer all users interacting with it remotely through a computer network (if "
        "your version supports such interaction) an opportunity to receive the Corresponding Source of your version by "
        "providing access to the Corresponding Source from a network server at no charge, through some standard or "
        "customary means of facilitating copying of software.")
    return out


ALL_TEMPLATES = TEMPLATES | HEADERS | licence_bodies()
# Fixed value: templates of at most so many terms are looked for in windows of lines.
SHORT_TERMS = 400
TAG = re.compile(r"SPDX-License-Identifier:\s*([^\r\n]+)", re.I)
# A header is a window of lines that holds one of these; the second may stand across a line end.
CUE = re.compile(r"licen[cs]e|copyright|permission is|redistribution|public domain|spdx|creative commons", re.I)
_CUE_OF_TWO = re.compile(r"permission is|public domain|creative commons")
_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def terms(text: str) -> Counter:
    return Counter(_TERM.findall(text.lower()))


def spdx(name: str) -> str:
    """The identifier of a template; variants carry a remark."""
    return name.partition(" (")[0]


class Matcher:
    """Templates as unit TF-IDF vectors; a text's terms outside all templates
    weigh as the rarest."""

    def __init__(self, templates: Mapping[str, str], idf: Mapping[str, float], rare: float):
        self.idf, self.rare = dict(idf), rare
        self.templates = [(name, self._unit(terms(text))) for name, text in sorted(templates.items())]
        size = {name: sum(terms(text).values()) for name, text in templates.items()}
        self.short = [t for t in self.templates if size[t[0]] <= SHORT_TERMS]
        self.long = [(t, size[t[0]]) for t in self.templates if size[t[0]] > SHORT_TERMS]
        self.reach = 1.25 * max((size[n] for n, _ in self.short), default=0)
        self.is_short = np.array([size[n] <= SHORT_TERMS for n, _ in self.templates], bool)
        self.row: dict[str, int] = {}
        for _, v in self.templates:
            for t in v:
                self.row.setdefault(t, len(self.row))
        self.squares = np.zeros((len(self.row), len(self.templates)))
        for k, (_, v) in enumerate(self.templates):
            for t, w in v.items():
                self.squares[self.row[t], k] = w * w

    def _unit(self, tf: Counter) -> dict[str, float]:
        v = {t: (1 + math.log(n)) * self.idf.get(t, self.rare) for t, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    def limits(self, used: Iterable[str]) -> np.ndarray:
        """For each template the most that any window of a text with these
        terms can have: the norm of the template's part that they cover."""
        rows = [r for r in map(self.row.get, used) if r is not None]
        return np.sqrt(self.squares[rows].sum(0))

    def best(self, words: Counter, only: np.ndarray) -> tuple[str | None, float]:
        """The template of largest cosine (the first by name among equals),
        of those that ``only`` marks."""
        v = self._unit(words)
        name, top = None, 0.0
        for k in np.flatnonzero(only):
            n, t = self.templates[k]
            s = sum(w * v.get(k, 0.0) for k, w in t.items())
            if s > top + 1e-12:
                name, top = n, s
        return name, min(top, 1.0)

    def _cosines(self, counts: np.ndarray, words: list[str], templates: list[tuple[str, dict[str, float]]]) -> np.ndarray:
        """Cosines of rows of term counts (columns ``words``) to templates."""
        idf = np.array([self.idf.get(t, self.rare) for t in words])
        v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
        norm = np.sqrt((v * v).sum(1))
        m = np.array([[t.get(w, 0.0) for _, t in templates] for w in words])
        return (v @ m) / np.where(norm > 0, norm, 1.0)[:, None]

    def best_window(self, lines: list[list[str]], cues: list[int]) -> tuple[str | None, float, int, int]:
        """(template, cosine, first line, line after the last) of the best
        window of lines that holds a cue; ``lines`` are lists of terms.

        A window has at most a quarter more terms than the longest short
        template; each cue line also stands alone and with the next.  Every
        window is compared once, at its first cue; among equals the first cue,
        then the fewest lines before it and after it, then the name count."""
        found: tuple[str | None, float, int, int] = (None, 0.0, 0, 0)
        if not self.short:
            return found
        size = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
        before = -1
        for c in cues:
            low = c
            while low - 1 > before and size[c + 1] - size[low - 1] <= self.reach:
                low -= 1
            high = min(c + 2, len(lines))
            while high < len(lines) and size[high + 1] - size[c] <= self.reach:
                high += 1
            before = c
            words = list(dict.fromkeys(t for x in lines[low:high] for t in x))
            at = {t: i for i, t in enumerate(words)}
            total = np.zeros((high - low + 1, len(words)))
            for i, x in enumerate(lines[low:high]):
                for t in x:
                    total[i + 1, at[t]] += 1
            total = total.cumsum(0)
            for s in range(c, low - 1, -1):
                ends = [e for e in range(c + 1, high + 1)
                        if e == c + 1 or size[e] - size[s] <= self.reach or (s, e) == (c, c + 2)]
                cos = self._cosines(total[[e - low for e in ends]] - total[s - low], words, self.short)
                if cos.max() > found[1] + 1e-12:
                    k, n = divmod(int(np.argmax(cos >= cos.max() - 1e-12)), cos.shape[1])
                    found = (self.short[n][0], float(cos[k, n]), s, ends[k])
        return found

    def best_body(self, words: list[str], only: np.ndarray) -> tuple[str | None, float, int, int]:
        """(template, cosine, first term, number of terms) of the best window
        as long as a licence body, in a text that is longer than the body;
        ``only`` marks the templates to compare, windows begin at every term."""
        found: tuple[str | None, float, int, int] = (None, 0.0, 0, 0)
        todo = [x for x, ok in zip(self.long, only[~self.is_short]) if ok and len(words) > x[1]]
        if not todo:
            return found
        known: dict[str, int] = {}
        ids = np.array([known.setdefault(t, len(known)) for t in words], np.int64)
        names = list(known)
        for template, n in todo:
            cos = self._sliding(ids, names, template[1], n)
            first = int(np.argmax(cos >= cos.max() - 1e-9))
            used, count = np.unique(ids[first:first + n], return_counts=True)
            s = float(self._cosines(count[None, :], [names[i] for i in used], [template])[0, 0])
            if s > found[1] + 1e-12:
                found = (template[0], s, first, n)
        return found

    def _sliding(self, ids: np.ndarray, names: list[str], template: dict[str, float], n: int) -> np.ndarray:
        """The cosine of every window of ``n`` terms to a template.

        When a term enters or leaves the window, only its own weight changes:
        dot product and norm are running sums of these changes."""
        m = len(ids)
        idf = np.array([self.idf.get(t, self.rare) for t in names])
        dot = idf * np.array([template.get(t, 0.0) for t in names])
        pos = np.argsort(ids, kind="stable")
        base = ids[pos] * (m + n + 2)
        key, k = base + pos, np.arange(m)
        inside = k - np.searchsorted(key, base + pos - n + 1) + 1       # of the term, with the one that enters
        staying = np.searchsorted(key, base + pos + n) - k              # of the term, with the one that leaves
        value = np.concatenate([[0.0], 1 + np.log(np.arange(1, n + 1))])
        sums = []
        for weight, f in ((dot, value), (idf * idf, value * value)):
            enter, leave = np.empty(m), np.empty(m)
            enter[pos] = weight[ids[pos]] * (f[inside] - f[inside - 1])
            leave[pos] = weight[ids[pos]] * (f[staying - 1] - f[staying])
            sums.append(np.cumsum(enter)[n - 1:] + np.concatenate([[0.0], np.cumsum(leave)])[:m - n + 1])
        return sums[0] / np.sqrt(np.maximum(sums[1], 1e-12))


def tagged(line: str) -> str | None:
    """The license that an SPDX tag in the line names, if it is one of the
    templates'; of an expression the first such."""
    tag = TAG.search(line)
    for word in re.findall(r"[A-Za-z0-9.+-]+", tag[1]) if tag else ():
        name = _KNOWN.get(re.sub(r"(-only|-or-later|\+)$", "", word, flags=re.I).lower())
        if name:
            return name
    return None


_KNOWN = {spdx(name).lower(): spdx(name) for name in ALL_TEMPLATES}


def document_frequencies(files: DataFrame, text_col: str, templates: Mapping[str, str]) -> tuple[dict[str, int], int]:
    """In how many of all texts each template term occurs, and their number.
    The terms are those of the templates: a bounded table."""
    wanted = frozenset(t for text in templates.values() for t in terms(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                count[""] += 1
                count.update(wanted.intersection(_TERM.findall((text or "").lower())))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                         ["term", "n"])

    rows = (files.select(text_col).mapInArrow(run, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    df = {r["term"]: r["n"] for r in rows}
    total = df.pop("", 0)
    return df, total


SCAN = "license string, similarity double, header string, is_license_file boolean"


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text",
         templates: Mapping[str, str] = ALL_TEMPLATES, threshold: float = 0.7, file_share: float = 0.5,
         name_rule: str = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$") -> DataFrame:
    """Add to ``files`` (all columns but the text): ``license`` (identifier or
    null), ``similarity``, ``header`` (the matching lines; the first line of
    a matching whole text or body) and ``is_license_file``: a license was
    found, and the file is named like one, or its whole text matches above
    ``threshold``, or at least ``file_share`` of its terms stand in the match.

    Compared are the windows of lines around each line with a cue word, the
    whole text, and all windows as long as each licence body; a known SPDX tag
    has similarity 1.  A template is left out for a text only if the terms of
    the text cover too little of it to reach ``threshold`` in any window.  The
    best match of at least ``threshold`` wins; among equals a tag, then the
    window of lines, the earlier line first, then the whole text.  Without a
    match ``similarity`` is 0.  Columns of the four names are replaced, others
    may have any name.  A null or empty text has no license.  An empty table
    gives no rows.
    """
    df, total = document_frequencies(files, text_col, templates)
    rare = math.log(1 + total)
    idf = {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for text in templates.values() for t in terms(text)}
    added = [f.split()[0] for f in SCAN.split(", ")]
    names = [c for c in files.columns if c.lower() not in added and c != text_col]
    src = files.select(*[F.col(f"`{c}`") for c in names], F.col(path_col).alias(free_name(files, "_path")),
                       F.col(text_col).alias(free_name(files, "_text")))
    rule = re.compile(name_rule)
    ids = {spdx(name) for name in templates}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, idf, rare + 1)

        def one(path: str | None, text: str | None) -> tuple:
            words = Counter(_TERM.findall((text or "").lower()))
            can = matcher.limits(words) >= threshold - 1e-9
            if not can.any() and not (text and TAG.search(text)):
                return None, 0.0, None, False
            lines = [x.strip() for x in text.split("\n")]
            lines = [(x, t) for x in lines if (t := _TERM.findall(x.lower()))]
            all_terms = [t for _, x in lines for t in x]
            cues = [i for i, (x, t) in enumerate(lines) if CUE.search(x) or (
                i + 1 < len(lines) and _CUE_OF_TWO.fullmatch(t[-1] + " " + lines[i + 1][1][0]))]
            best = (None, 0.0, None, 0)
            if can[matcher.is_short].any():
                n, s, i, j = matcher.best_window([t for _, t in lines], cues)
                best = (n, s, " ".join(x for x, _ in lines[i:j]), sum(len(t) for _, t in lines[i:j]))
            for i in cues:
                if (n := tagged(lines[i][0])) and n in ids:
                    best = (n, 1.0, lines[i][0], len(lines[i][1]))
                    break
            whole = matcher.best(words, can)
            body = matcher.best_body(all_terms, can)
            for n, s, first, size in ((*whole, 0, len(all_terms)), body):
                if s > best[1] + 1e-12:
                    begin, k = 0, 0
                    while k + 1 < len(lines) and begin + len(lines[k][1]) <= first:
                        begin, k = begin + len(lines[k][1]), k + 1
                    best = (n, s, lines[k][0] if lines else text, size)
            name, top, header, size = best
            top = min(round(top, 12), 1.0)
            if top < threshold:
                return None, 0.0, None, False
            named = bool(rule.match((path or "").rpartition("/")[2]))
            return (spdx(name), top, header,
                    named or whole[1] >= threshold or size / max(1, len(all_terms)) >= file_share)

        for b in batches:
            found = [one(p, t) for p, t in zip(b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist())]
            cols = [pa.array([f[i] for f in found], kind)
                    for i, kind in enumerate((pa.string(), pa.float64(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(names))] + cols, names + added)

    fields = "".join(f"`{c}` {files.schema[c].dataType.simpleString()}, " for c in names)
    return src.mapInArrow(run, fields + SCAN)


def directory(path: Column) -> Column:
    """The path up to its last slash; "" at the top."""
    return F.regexp_extract(path, r"^(.*)/", 1)


def inherit(scanned: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``effective_license``, ``inherited_from`` (a directory, null if
    not inherited) and ``depth_up`` (0: the file's own directory), replacing
    columns of these names; others may have any name.

    A directory's license is that of its license files; if they differ, that
    of the best similarity, then the first by name.  A file with a license of
    its own keeps it.  A file without a path or without a licensed ancestor
    has none.

    Ancestors are joined per distinct directory, not per file, so a directory
    with a third of all files costs one row; files then fetch their
    directory's result, those of a hot directory by a broadcast of its row.
    """
    here, of, up, n, lic = (free_name(scanned, x) for x in ("_dir", "_of", "_up", "_n", "_license"))
    # the scan has dropped the texts: written once, not run for each join below
    rows = materialize(scanned.withColumn(here, directory(F.col(f"`{path_col}`"))), "lic-scanned")
    best = F.min(F.struct((-F.col("similarity")).alias("s"), F.col("license").alias("l")))
    licensed = materialize(rows.where(F.col("is_license_file") & F.col(here).isNotNull())
                           .groupBy(F.col(here).alias(up)).agg(best["l"].alias(lic)), "lic-dirs")
    dirs = rows.where(F.col("license").isNull() & F.col(here).isNotNull()).select(here).distinct()
    steps = F.split(here, "/")
    depth = F.when(F.col(here) == "", 0).otherwise(F.size(steps))
    above = (dirs.withColumn(n, F.explode(F.sequence(F.lit(0), depth)))
             .withColumn(up, F.when(F.col(n) < depth, F.array_join(F.slice(steps, F.lit(1), depth - F.col(n)), "/"))
                         .otherwise(F.lit(""))))
    nearest = Window.partitionBy(here).orderBy(n)
    found = materialize(above.join(licensed, up).withColumn("k", F.row_number().over(nearest)).where("k = 1")
                        .select(F.col(here).alias(of), up, n, lic), "lic-inherited")
    own = F.col("license").isNotNull()
    added = {"effective_license": F.coalesce(F.col("license"), F.col(lic)), "inherited_from": F.when(~own, F.col(up)),
             "depth_up": F.when(~own, F.col(n).cast("long"))}
    kept = [F.col(f"`{c}`") for c in scanned.columns if c.lower() not in added]
    return skew_join(rows, found, here, of, "left").select(*kept, *[c.alias(name) for name, c in added.items()])
