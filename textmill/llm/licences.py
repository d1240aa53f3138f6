"""Licence texts by canonical digests.

A text, each of its paragraphs and each of its lines are brought to one canonical form: lower case, copyright lines dropped, equivalent
spellings replaced, punctuation and spacing reduced to single blanks. The digest of a whole unit is looked up by a hash join in the
digests of known licence texts, which go through the same expressions.

Units are only built in texts that hold a word which every known text has (`ANCHOR`); this excludes no match.

Cases: null and empty texts match nothing; a unit that is nothing but copyright lines or punctuation has no digest; equal rows give equal rows; an empty
table gives an empty result; other columns are ignored. The table of known digests has a fixed number of rows and is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence texts and notices, without copyright lines.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies."""
_ZERO = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed
or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to"""
#: titles above a text; a text may stand without one
_TITLES = {
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "ISC": ("The ISC License",),
}
_BODIES = {
    "BSD-2-Clause": f"{_BSD_HEAD} {_BSD_TAIL}",
    "BSD-3-Clause": f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}",
    "Zlib": _ZLIB,
    "0BSD": f"{_ZERO} {_AS_IS}",
    "ISC": f"{_ISC} {_AS_IS}",
}
#: names in notices
_NAMES = (
    ("MIT", "the MIT License"),
    ("ISC", "the ISC License"),
    ("0BSD", "the BSD Zero Clause License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("Zlib", "the zlib License"),
    ("Unlicense", "the Unlicense"),
    ("BSL-1.0", "the Boost Software License, Version 1.0"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("EPL-2.0", "the Eclipse Public License, version 2.0"),
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("Apache-2.0", "the Apache License 2.0"),
    ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
)
_NOTICES = ("Released under {}.", "Licensed under {}.", "This work is licensed under {}.", "This project is licensed under {}.")
_BASE = (
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", f"{_ISC} {_AS_IS}"),
    ("ISC", f"ISC License {_ISC} {_AS_IS}"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", f"{_ZERO} {_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", _GPL),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 license."),
)
_MORE = (
    *((n, f"{title} {body}".strip()) for n, titles in _TITLES.items() for title in titles for body in (_BODIES[n], re.sub(r"\b[123]\. ", "", _BODIES[n]))),
    ("Unlicense", f"{_UNLICENSE} <http://unlicense.org/>"),
    ("Unlicense", f"{_UNLICENSE} <http://unlicense.org>"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    *((n, notice.format(name)) for n, name in _NAMES for notice in _NOTICES),
)


def _distinct(rows: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """One row of those that are the same but for case, blanks and punctuation."""
    first: dict[str, tuple[str, str]] = {}
    for name, text in rows:
        first.setdefault(re.sub(r"\W+", " ", text.lower()).strip(), (name, text))
    return tuple(first.values())


KNOWN = _distinct(_BASE + _MORE)
# Spellings that count as one, applied in order to lower-case text.
SPELLINGS = (
    (r"licence", "license"),
    (r"sub-license", "sublicense"),
    (r"non-infringement", "noninfringement"),
    (r"acknowledgement", "acknowledgment"),
    (r"organis", "organiz"),
    (r"favour", "favor"),
    (r"neighbour", "neighbor"),
    (r"https://", "http://"),
    (r"\bversion\s+(?=[0-9])|\bv\.?\s?(?=[0-9])", "version "),
    (r"&", " and "),
)
COPYRIGHT = r"(?m)^[^\p{L}\p{N}(©\n]*(?:copyright\b(?!\s+(?:holder|notice))|\(c\)|©)[^\n]*$|(?m)^\W*all rights reserved\W*$"
ANCHOR = r"(?i)licen[cs]|permi|redistribut|released"


def canonical(text: Column) -> Column:
    """The canonical form of a unit; empty if nothing is left."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, " ")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def known_digests(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """(digest, license) of the known texts and of a table `more` (license, text)."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in KNOWN])
    known = spark.range(1).select(F.explode(rows).alias("row")).select("row.*")
    if more is not None:
        known = known.unionByName(more.select("license", "text")).filter(canonical(F.col("text")) != "")
    return known.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").distinct()


def scanned(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """doc_id, whole (the licence that the entire text is, or null) and licenses (those of any unit, sorted) of every row.

    Texts of a table `more` (license, text) are known too; as they need not have the anchor, units are then built in all texts.
    Only documents with a match are shuffled, as slim rows. Each row is judged by its own text: rows are told apart by
    (doc_id, 64-bit hash and length of the text), so rows with a repeated or null id and different texts keep their own
    answers, and equal rows get equal ones.
    """
    anchored = (lambda c: c.isNotNull()) if more is not None else (lambda c: c.rlike(ANCHOR))
    text = F.col("text").cast("string")
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_h"), F.length(text).alias("_n"))
    texts = keyed.filter(anchored(F.col("text")))
    breaks = F.regexp_replace("text", r"\r\n?", "\n")
    parts = F.array_union(F.split(breaks, r"\n[ \t]*\n\s*", -1), F.split(breaks, "\n", -1))
    parts = F.filter(parts, lambda p: anchored(p) & (p != F.col("text")))
    unit = lambda text, whole: F.struct(text.alias("unit"), F.lit(whole).alias("whole"))
    units = F.concat(F.array(unit(F.col("text"), True)), F.transform(parts, lambda p: unit(p, False)))
    rows = texts.select("doc_id", "_h", "_n", F.explode_outer(units).alias("row")).select("doc_id", "_h", "_n", "row.*")
    rows = rows.filter(F.col("unit").isNotNull())
    form = canonical(F.col("unit"))
    digests = rows.select("doc_id", "_h", "_n", "whole", F.when(form != "", F.sha2(form, 256)).alias("digest"))
    hits = digests.join(F.broadcast(known_digests(docs.sparkSession, more)), "digest")
    found = hits.groupBy(F.col("doc_id").alias("owner"), F.col("_h").alias("_oh"), F.col("_n").alias("_on")).agg(
        F.max(F.when(F.col("whole"), F.col("license"))).alias("whole"), F.sort_array(F.collect_set("license")).alias("licenses")
    )
    same = F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("_h") == F.col("_oh")) & (F.col("_n") == F.col("_on"))
    every = keyed.select("doc_id", "_h", "_n").join(found, same, "left")
    return every.select("doc_id", "whole", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"))
