"""License scans by canonical digest lookup, in DataFrame functions only.

A text is brought to a canonical form: lower case, without copyright lines, with equivalent spellings made one, and
with every run of characters that are neither letters nor digits as one space. A copyright statement ends with its line,
or before the words that a licence opens with, where it stands on one line with them (at most `GAP` characters on). The
SHA-256 of the form is joined with the digests of known licence texts, brought to the same form. Entire texts match or
don't; a licence quoted inside a longer text does not.

Known are the short licences and notices of `BODIES`, each under its usual titles and without one, and the long licences
in `license_texts` (public texts, as published); callers can pass any other table.

The known table is broadcast while it has at most `BROADCAST_ROWS` rows and joined by shuffle beyond.

Defined results: a null text has a null digest and no licence; a text that is empty in canonical form has the digest of
the empty text and no licence; repeated rows get equal rows; known texts with one digest give the licence that sorts
first. Extra columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000

# Equivalent spellings, as whole words of the canonical form (from, to).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("cancelled", "canceled"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelled", "labeled"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# Short licences, licence headers and notices in full, without title and copyright line.
BODIES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "WTFPL": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.

DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO.""",
    "Header-Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Header-MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Notice-Apache-2.0": """Licensed under the Apache License, Version 2.0.""",
    "Notice-MIT": """Released under the MIT License.""",
    "Notice-CC-BY-NC-4.0": """Licensed under CC BY-NC 4.0.""",
    "Notice-GPL-3.0": """This work is licensed under the GNU General Public License, version 3.""",
}
# The headers of one family of licences, by its name and the version clause.
GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the {0} General Public License as published by the Free Software Foundation, {1}

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} General Public License for more details.

You should have received a copy of the {0} General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
LATER, ONLY = "either version {0} of the License, or (at your option) any later version.", "version {0} of the License."
GNU = {"GPL": "GNU", "LGPL": "GNU Lesser", "AGPL": "GNU Affero"}

# The titles that texts of a licence begin with.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT", "Expat License"],
    "MIT-0": ["MIT No Attribution", "MIT-0"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"],
    "WTFPL": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004", "WTFPL"],
}
#: Long licences in full, one file each.
FOLDER = Path(__file__).parent / "license_texts"


def known() -> list[tuple[str, str]]:
    """(licence, text) of everything known, in the titles that it comes under."""
    out = [(name, f"{title}\n\n{body}") for name, body in BODIES.items() for title in ["", *TITLES.get(name, [])]]
    for short, name in GNU.items():
        for version in ("2.1", "3") if short == "LGPL" else ("3",) if short == "AGPL" else ("2", "3"):
            for clause, what in ((LATER, "or-later"), (ONLY, "only")):
                out.append((f"Header-{short}-{version if '.' in version else version + '.0'}-{what}", GNU_HEADER.format(name, clause.format(version))))
    return out + [(file.stem, file.read_text(encoding="utf-8", errors="replace")) for file in sorted(FOLDER.glob("*.txt"))]


#: A copyright statement: with its sign or a year, or the reservation alone.
STATEMENT = r"(copyright[^\n]{0,80}?(\(c\)|©|[0-9]{4}|<year>|\[yyyy\])|©|\(c\) ?[0-9]{4}|all rights reserved)"
GAP = 200
#: Words that a licence opens with, after a copyright statement on the same line.
OPENINGS = r"(permission is hereby|permission to use|redistribution and use|this software is provided|this program is free|licensed under the|everyone is permitted)"
#: A statement before them, and a line that begins as a statement (Java and RE2 agree on these patterns).
BEFORE_OPENING = STATEMENT + r"[^\n]{0," + str(GAP) + r"}?" + OPENINGS
COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*" + STATEMENT + r"[^\n]*"
NOT_WORDS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), BEFORE_OPENING, " $3"), COPYRIGHT_LINE, "$1")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, NOT_WORDS, " ")), F.lit(" "))
    for a, b in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(plain)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known(), "license_id string, license_text string")


def scan(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_digest and license_id (null where unknown) of every row; known: (license_id, license_text)."""
    table = known.where("license_text is not null").select("license_id", digest(F.col("license_text")).alias("__digest"))
    table = table.where(F.col("__digest") != F.sha2(F.lit("").cast("binary"), 256)).groupBy("__digest").agg(F.min("license_id").alias("license_id"))
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), digest(docs[text].cast("string")).alias("text_digest"))
    return rows.join(table, rows.text_digest == table["__digest"], "left").select("doc_id", "text_digest", "license_id")


def sql() -> str:
    """The same in DuckDB SQL over the view documents."""

    def form(x: str) -> str:
        plain = f"regexp_replace(regexp_replace(lower({x}), '{BEFORE_OPENING}', ' \\3', 'g'), '{COPYRIGHT_LINE}', '\\1', 'g')"
        plain = f"' ' || trim(regexp_replace({plain}, '{NOT_WORDS}', ' ', 'g')) || ' '"
        for a, b in SPELLINGS:
            plain = f"replace({plain}, ' {a} ', ' {b} ')"
        return f"sha256(trim({plain}))"

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in known())
    return f"""
        WITH known AS (
            SELECT {form("license_text")} AS d, min(license_id) AS license_id FROM (VALUES {rows}) AS v(license_id, license_text) GROUP BY 1
        ), docs AS (SELECT doc_id, {form("text")} AS text_digest FROM documents)
        SELECT doc_id, text_digest, license_id FROM docs LEFT JOIN known ON text_digest = d
    """
