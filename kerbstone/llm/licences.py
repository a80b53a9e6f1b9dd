"""License scans: normalised text compared to licence templates by the Dice coefficient over word bigrams.

Normalised: A-Z in lower case, every run of characters other than a-z, 0-9 and line ends is one space. What is compared
is each line, each sentence, each paragraph of several lines (between blank lines) and the whole text. A sentence runs to a
full stop, exclamation or question mark before white space, or to a blank line: over line ends, so that a notice that is
wrapped, commented out, or in the middle of a longer line is found. A segment's words make a set of bigrams (with a mark
before the first word, so that one word has one). With a bigrams in the segment, b in the template and a coefficient of
at least t, a lies between b t / (2 - t) and b (2 - t) / t: a template outside these bounds is not compared, and a segment
outside all of them is not even made into bigrams.

Templates are notices, titles, paragraphs and whole short texts of licences, and each sentence of eight words or more of
these. A sentence that several licences share is reported as the first of them in alphabetical order.

All of it is Column expressions. Defined results: null, empty and wordless texts match nothing; ties between templates fall
to the first in alphabetical order; a sentence that is a line or a paragraph by itself is reported as that, and the same
segment at several places at each; repeated rows, and rows that share or lack a doc_id, are reported each; long texts are
read whole; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Notices by which texts name their licence, titles, and paragraphs of short licence texts.
TEMPLATES: dict[str, list[str]] = {
    "0BSD": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "BSD Zero Clause License",
    ],
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "BSD-2-Clause": [
        "BSD 2-Clause License",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSL-1.0": [
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Distributed under the Boost Software License, Version 1.0.",
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "CC0-1.0": [
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "CC0 1.0 Universal",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
        "You should have received a copy of the CC0 Public Domain Dedication along with this software.",
    ],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "ISC": [
        "ISC License",
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "The MIT License (MIT)",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Proprietary": ["All rights reserved."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "This notice may not be removed or altered from any source distribution.",
    ],
}

# The templates (by licence and number) that make up the text of a short licence.
WHOLE: dict[str, list[tuple[str, int]]] = {
    "BSD-2-Clause": [("BSD-2-Clause", 0), ("BSD-2-Clause", 2), ("BSD-2-Clause", 3), ("BSD-2-Clause", 4), ("BSD-2-Clause", 5)],
    "BSD-3-Clause": [("BSD-3-Clause", 0), ("BSD-2-Clause", 2), ("BSD-2-Clause", 3), ("BSD-2-Clause", 4), ("BSD-3-Clause", 3), ("BSD-2-Clause", 5)],
    "ISC": [("ISC", 0), ("ISC", 2), ("ISC", 3)],
    "MIT": [("MIT", 0), ("MIT", 3), ("MIT", 4), ("MIT", 5)],
    "Unlicense": [("Unlicense", 0), ("Unlicense", 1), ("Unlicense", 2), ("MIT", 5)],
    "Zlib": [("Zlib", 0), ("Zlib", 1), ("Zlib", 2), ("Zlib", 3), ("Zlib", 4)],
}
#: Words of a template's sentence that is a template of its own, at least.
SENTENCE_WORDS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain(text: str) -> list[str]:
    return "".join(c if c in _LOWER + "0123456789" else " " for c in text.lower()).split()


def template_words() -> list[tuple[str, list[str]]]:
    """(licence, words) of every template, by licence, each once: texts, whole licences and their sentences."""
    out: dict[tuple[str, tuple[str, ...]], None] = {}
    for name in sorted(TEMPLATES):
        texts = [*TEMPLATES[name], *([" ".join(TEMPLATES[of][k] for of, k in WHOLE[name])] if name in WHOLE else [])]
        sentences = [s for t in TEMPLATES[name] for s in re.split(r"(?<=[.!?])\s", t)]
        for words in [*map(_plain, texts), *(w for w in map(_plain, sentences) if len(w) >= SENTENCE_WORDS)]:
            out[name, tuple(words)] = None
    return [(name, list(words)) for name, words in out]


def template_bigrams() -> list[tuple[str, list[str]]]:
    """(licence, distinct bigrams) of every template, by licence."""
    return [(name, list(dict.fromkeys(f"{a} {b}" for a, b in zip(["^", *words], words, strict=False)))) for name, words in template_words()]


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """The least and most bigrams of a segment that can reach the threshold against a template of ``size``."""
    low, high = size * threshold / (2 - threshold), size * (2 - threshold) / threshold
    return -int(-low // 1), int(high + 1e-9)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "[^a-z0-9\n]+", " ")


def bigrams(segment: Column) -> Column:
    """The distinct bigrams of a segment of normalised text, in order."""
    words = F.filter(F.split(segment, "[ \n]+"), lambda w: w != "")
    marked = F.concat(F.array(F.lit("^")), words)
    return F.array_distinct(F.zip_with(F.slice(marked, F.lit(1), F.size(words)), words, lambda a, b: F.concat_ws(" ", a, b)))


def anchors(threshold: float) -> list[str]:
    """Words of which every segment that reaches the threshold holds one at least.

    Such a segment has at least b t / (2 - t) of a template's b bigrams, so words that touch more than the rest of them
    can't all be missing. Words of many letters are taken first, each as long as a template still needs more.
    """
    words: list[str] = []
    for _, b in template_bigrams():
        spare = len(b) - bounds(len(b), threshold)[0]
        left = [x.split(" ") for x in b]
        left = [x for x in left if not any(w in words for w in x)]
        while len(b) - len(left) <= spare:
            word = max({w for x in left for w in x if w != "^"}, key=lambda w: (len(w) > 2 and w not in _COMMON, sum(w in x for x in left), len(w), w))
            words.append(word)
            left = [x for x in left if word not in x]
    return words


# Words too common to be anchors where there are others.
_COMMON = {"the", "this", "and", "for", "with", "that", "not", "any", "can", "use", "all", "are", "you", "may", "under", "from", "work", "its", "per", "was", "is", "of", "or", "to", "in"}


#: Stands for the end of a sentence.
_END = "\x01"


def sentences(text: Column) -> Column:
    """The normalised sentences of a text, without line ends, some of them empty."""
    low = F.translate(F.coalesce(text, F.lit("")), _END + _UPPER, " " + _LOWER)
    ended = F.regexp_replace(low, r"([.!?])([ \t\r\n])", f"$1{_END}$2")
    parts = F.split(F.regexp_replace(ended, f"[^a-z0-9\n{_END}]+", " "), f"{_END}|\n *\n[ \n]*", -1)
    return F.transform(parts, lambda p: F.trim(F.regexp_replace(p, "[ \n]+", " ")))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a match: doc_id, level (line, sentence, paragraph or text), position, licence, dice (six digits), segment."""
    made = template_bigrams()
    limits = [bounds(len(b), threshold) for _, b in made]
    least, most = min(x[0] for x in limits), max(x[1] for x in limits)
    anchored = rf"\b(?:{'|'.join(anchors(threshold))})\b"

    def level(name: str, parts: Column, kept) -> Column:
        placed = F.transform(parts, lambda s, i: F.struct(F.lit(name).alias("level"), i.cast("long").alias("position"), s.alias("segment")))
        return F.filter(placed, lambda x: x["segment"].rlike(anchored) & kept(x["segment"]))

    def several(s: Column) -> Column:
        return F.trim(s).contains("\n")

    # an explode of one element keeps Spark from evaluating the expression again in each place that names it
    rows = docs.select("doc_id", "text", F.explode(F.array(normalised(F.col("text")))).alias("whole")).where(F.col("whole").rlike(anchored))
    parts = F.struct(F.split("whole", "\n", -1).alias("lines"), F.split("whole", "\n *\n[ \n]*", -1).alias("paragraphs"), sentences(F.col("text")).alias("sentences"))
    rows = rows.select("doc_id", "whole", F.explode(F.array(parts)).alias("p")).select("doc_id", "whole", "p.*")
    known = F.concat(F.transform("lines", lambda x: F.trim(x)), F.transform("paragraphs", lambda p: F.trim(F.regexp_replace(p, "[ \n]+", " "))))
    levels = F.concat(
        level("line", F.col("lines"), lambda s: F.lit(True)),
        level("sentence", F.col("sentences"), lambda s: ~F.array_contains(known, s)),
        F.when(F.size("paragraphs") > 1, level("paragraph", F.col("paragraphs"), several)).otherwise(F.array().cast("array<struct<level:string,position:bigint,segment:string>>")),
        level("text", F.array("whole"), several),
    )
    segments = rows.select("doc_id", F.explode(levels).alias("x")).select("doc_id", "x.*")
    sized = segments.select("*", F.explode(F.array(bigrams(F.col("segment")))).alias("grams")).where(F.size("grams").between(least, most))
    templates = F.array(*[F.struct(F.lit(-k).alias("nth"), F.lit(name).alias("licence"), F.array(*map(F.lit, b)).alias("b"), F.lit(low).alias("low"), F.lit(high).alias("high")) for k, ((name, b), (low, high)) in enumerate(zip(made, limits, strict=True))])
    close = F.filter(templates, lambda t: F.size("grams").between(t["low"], t["high"]))
    scored = F.transform(close, lambda t: F.struct((F.lit(2.0) * F.size(F.array_intersect("grams", t["b"])) / (F.size("grams") + F.size(t["b"]))).alias("dice"), t["nth"].alias("nth"), t["licence"].alias("licence")))
    found = sized.select("*", F.explode(F.array(F.array_max(scored))).alias("best")).where(F.col("best.dice") >= threshold)
    return found.select("doc_id", "level", "position", F.col("best.licence").alias("licence"), F.round("best.dice", 6).alias("dice"), F.trim("segment").alias("segment"))


def scan_sql(threshold: float = THRESHOLD) -> str:
    """The same scan in DuckDB's SQL."""
    made = template_bigrams()
    rows = ", ".join(f"({k}, '{name}', [{', '.join(repr(x) for x in b)}])" for k, (name, b) in enumerate(made))
    limits = [bounds(len(b), threshold) for _, b in made]
    return f"""
with t(nth, licence, b) as (values {rows}),
w as (select doc_id, regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^a-z0-9\\n]+', ' ', 'g') as whole,
  regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(1) || '{_UPPER}', ' {_LOWER}'), '([.!?])([ \\t\\r\\n])', '\\1' || chr(1) || '\\2', 'g'), '[^a-z0-9\\n\\x01]+', ' ', 'g') as ended from documents),
p as (select doc_id, whole, string_split(whole, chr(10)) as lines, regexp_split_to_array(whole, '\\n *\\n[ \\n]*') as paras,
  [trim(regexp_replace(x, '[ \\n]+', ' ', 'g')) for x in regexp_split_to_array(ended, '\\x01|\\n *\\n[ \\n]*')] as sents from w),
s as (
  select doc_id, 'line' as level, unnest(lines) as segment, generate_subscripts(lines, 1) - 1 as position from p
  union all select doc_id, 'sentence', segment, position from (select doc_id, lines, paras, unnest(sents) as segment, generate_subscripts(sents, 1) - 1 as position from p)
    where not list_contains([trim(x) for x in lines], segment) and not list_contains([trim(regexp_replace(x, '[ \\n]+', ' ', 'g')) for x in paras], segment)
  union all select * from (select doc_id, 'paragraph', unnest(paras) as segment, generate_subscripts(paras, 1) - 1 from p where len(paras) > 1) where contains(trim(segment), chr(10))
  union all select doc_id, 'text', whole, 0 from p where contains(trim(whole), chr(10))
),
g as (select *, list_filter(regexp_split_to_array(segment, '[ \\n]+'), lambda x: x <> '') as words from s),
h as (select doc_id, level, position, segment, list_distinct([concat(if(i = 1, '^', words[i - 1]), ' ', words[i]) for i in range(1, len(words) + 1)]) as grams from g),
m as (select h.*, t.nth, t.licence, 2.0 * len(list_intersect(h.grams, t.b)) / (len(h.grams) + len(t.b)) as d
  from (select * from h where len(grams) between {min(x[0] for x in limits)} and {max(x[1] for x in limits)}) h join t on len(h.grams) >= len(t.b) * {threshold} / {2 - threshold} - 1e-9 and len(h.grams) <= len(t.b) * {2 - threshold} / {threshold} + 1e-9)
select doc_id, level, position::bigint as position, arg_max(licence, (d, -nth)) as licence, round(max(d), 6) as dice, trim(any_value(segment)) as segment
from m where d >= {threshold} group by doc_id, level, position
"""
