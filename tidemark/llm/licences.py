"""Licence scan by canonical digests.

A text is put in canonical form (lower case, no copyright lines, one spelling,
words only) and its digest is looked up among those of known licence texts; the
digest of each of its lines is looked up among known notices.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of well-known licences and usual notices.
_GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_KEEP_ISC = ", provided that the above copyright notice and this permission notice appear in all copies"
_AS_IS_ISC = (
    ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
    "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_1 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN "
    "IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GRANT_BSL = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, "
    "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
    "subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in "
    "all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
    "generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is "
    "granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of "
    "this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would "
    "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed "
    "or altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
    "as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and "
    "all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
    "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
TEXTS: dict[str, list[str]] = {
    "MIT": [_GRANT_MIT, "MIT License " + _GRANT_MIT, "The MIT License (MIT) " + _GRANT_MIT],
    "ISC": [_GRANT_ISC + _KEEP_ISC + _AS_IS_ISC, "ISC License " + _GRANT_ISC + _KEEP_ISC + _AS_IS_ISC],
    "0BSD": [_GRANT_ISC + _AS_IS_ISC, "BSD Zero Clause License " + _GRANT_ISC + _AS_IS_ISC],
    "BSD-2-Clause": [_BSD_1 + _BSD_AS_IS, "BSD 2-Clause License " + _BSD_1 + _BSD_AS_IS],
    "BSL-1.0": [_GRANT_BSL, "Boost Software License - Version 1.0 - August 17th, 2003 " + _GRANT_BSL],
    "Zlib": [_GRANT_ZLIB, "zlib License " + _GRANT_ZLIB, "The zlib License " + _GRANT_ZLIB],
    "Unlicense": [_UNLICENSE, *[f"{_UNLICENSE} For more information, please refer to <{x}://unlicense.org/>" for x in ("http", "https")], _UNLICENSE + " For more information, please refer to <https://unlicense.org>"],
    "BSD-3-Clause": [_BSD_1 + _BSD_3 + _BSD_AS_IS, "BSD 3-Clause License " + _BSD_1 + _BSD_3 + _BSD_AS_IS],
}
#: Digests of the canonical forms of published texts, as :func:`digest` and :func:`variants` give them.
DIGESTS: dict[str, list[str]] = {
    "Apache-2.0": ["dececdd0869bd34bc90475879b2f59967d5af7e3e306d632bfeae9cb6a205fc4", "001d23cc6f59b8ea1401bd74bc107de6c5489a0a44a8ba1fdfe508d160001675"],
    "GPL-1.0": ["11722150a2c5882d26b29968a165ffa7e07070764ce6ad67a666473c0c9d973c", "71be1dcc7528caec2573989ab44db04607889a3242ded40cef48a8169c78d17c"],
    "GPL-2.0": ["0946ad1634f8a6d5361597aef7962f106ebf80adcef62da69037b3031558f60e", "912db42be2e4e85111ad25fd99382d5cce155226adb7a98b5cd2414703e308c4"],
    "GPL-3.0": ["2a5efb694ea2bfd0636169e4ab07f04f0f83e95ab11d803b003cf7dfc6de375e", "3fd038b72db3c0f91c2cfdffad248c84aa7f4588c90d80ab7e5cc3e4111e1583"],
    "LGPL-2.0": ["a93ff8b289456df241b7246015155227af586805c65ae078b37ada76a1bb0cee", "2daf4048e90838b0bbd4703555df22f0caafbc63d93990f7d27f9bda421dcab8"],
    "LGPL-2.1": ["2f94a9829117f7a4941e7d583cbc0b4781b9c9b8cf4ad442c7efacff1d4ca929", "c8fbf2e9c3180729524f66f3c26b17ca0bc700c9434041daea6d769cc18fa52a"],
    "LGPL-3.0": ["f9971a40b39b55b23a81e443f25bde5afd88dcddc5a97e859f3e234c6409bb34"],
    "MPL-1.1": ["839ed6beabd853c4040be40748f32201b769d64d54ba5cd19027c190327a3c33", "3ebc2c9ae39c2e24cedd25bc6da22a2afe92a4f65fda300c60b818083ba1aca8"],
    "MPL-2.0": ["550aec0a0ca757cc7718522e6a860df58cb7fcf28ffed8938025dbdf9b0be215", "fad6c901ecf687c24b00263425a1fc8f767069c34f333608ff27e2e34d718aaa"],
    "CC0-1.0": ["8a58796fb749d87126983cebc26e6619b99601332e2fee24acbad509518cad3f"],
    "Artistic-1.0-Perl": ["0beeca1e75bd666f0b80582b97ed63ba70b54a8ce81ac84a8e53f725c39fa812"],
    "GFDL-1.2": ["d98cfcb202860aae95d5403bfa950318c37036295febc70f670b77815dc77daf", "b0d4c9a0a002ffe6e3c5510ed6324a5adeba037842173d64472cf0147bd38366"],
    "GFDL-1.3": ["54910ea1c2f6620f77848db8ad1a71e9d2c3f58d5ada1d7948a671620df787ec", "62455780ffa1820468cdab078e51f51c46ba0c4e1d3b9b28b948e110ecaa3c58"],
}
NOTICES: dict[str, list[str]] = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["Licensed under CC0 1.0.", "This work is dedicated to the public domain.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}

#: Patterns and replacements that give the canonical form, in order; lines stay apart. \\1 and \\2 are groups.
#: A copyright line begins with the word or sign and goes on with a sign, year, name or blank to fill in; prose that
#: a line break happens to cut before "copyright" stays, so that the form doesn't depend on how a text is wrapped.
STEPS = (
    ("\r\n?|\u0085|\u2028|\u2029", "\n"),
    (r"(?m)^[^\p{L}\p{N}©(\n]*(?:©[^\n]*|\(c\)[^\p{L}\p{N}\n]*\d{4}[^\n]*|copyright[^\p{L}\p{N}\n]*(?:(?:\(c\)|©|\d{4}|by |[<{\[])[^\n]*)?|all rights reserved[^\p{L}\n]*)$", ""),
    (r"&", " and "),
    (r"[^\p{L}\p{N}\n]+", " "),
    (r"licenc", "licens"),
    (r"is(e|ed|es|er|ers|ing|ation|ations)( |\n|$)", r"iz\1\2"),
    (r"our(s|ed|ing|able|)( |\n|$)", r"or\1\2"),
    (r"https", "http"),
    (r"(acknowledg|judg)ement", r"\1ment"),
)


def canonical_lines(text: Column) -> Column:
    """Words of each line in canonical form; lines without words are left out."""
    c = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in STEPS:
        c = F.regexp_replace(c, pattern, to.replace("\\", "$"))
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(text: Column) -> Column:
    """Digest of the canonical form of a whole text."""
    return F.sha2(F.array_join(canonical_lines(text), " "), 256)


def variants(text: str) -> list[str]:
    """A licence as published, and without what follows its end: how to apply it, exhibits to fill in."""
    ends = [m.end() for m in re.finditer("END OF TERMS AND CONDITIONS", text)][:1] + [m.start() for m in re.finditer(r"(?mi)^(?:exhibit a -|addendum:)", text)][:1]
    return [text, *[text[:k] for k in ends]]


def known(spark: SparkSession, more: dict[str, list[str]] | None = None) -> DataFrame:
    """kind (text or notice), id, digest and length of the canonical form.

    Its size is fixed by the tables above; ``more`` adds whole texts by id.
    """
    rows = [(kind, name, text) for kind, of in (("text", TEXTS), ("text", more or {}), ("notice", NOTICES)) for name, texts in of.items() for text in texts]
    form = F.array_join(canonical_lines(F.col("t")), " ")
    made = spark.createDataFrame(rows, "kind string, id string, t string").select("kind", "id", F.sha2(form, 256).alias("digest"), F.length(form).alias("n"))
    fixed = spark.createDataFrame([("text", name, d, None) for name, of in DIGESTS.items() for d in of], "kind string, id string, digest string, n int")
    return made.unionByName(fixed).distinct()


def scan(docs: DataFrame, table: DataFrame | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with text_digest, license_id, notice_ids and n_notices.

    license_id: the licence whose text the whole text is, else null. notice_ids:
    those of its lines' notices, sorted and comma-joined, empty if there are
    none; n_notices: such lines. Null and empty texts have the digest of no
    words and match nothing. Repeated rows get a result each. ``table`` is
    joined by broadcast only up to 100,000 rows.
    """
    names = [c for c in keep if c not in ("text_digest", "license_id", "notice_ids", "n_notices")]
    table = known(docs.sparkSession) if table is None else table
    n, low, high = table.agg(F.count("*"), F.min(F.when(F.col("kind") == "notice", F.col("n"))), F.max(F.when(F.col("kind") == "notice", F.col("n")))).first()

    def of(kind: str) -> DataFrame:
        ids = table.where(F.col("kind") == kind).groupBy("digest").agg(F.min("id").alias("id"))
        return F.broadcast(ids) if n <= 100_000 else ids

    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("_n"), *names).alias("_row"), canonical_lines(F.col("text")).alias("_l"))
    # a line longer or shorter than every notice can't be one
    lines = F.transform(F.filter("_l", lambda x: F.length(x).between(low or 0, high or 0)), lambda x: F.sha2(x, 256))
    rows = rows.select("_row", F.sha2(F.array_join("_l", " "), 256).alias("text_digest"), F.explode_outer(lines).alias("digest"))
    found = rows.join(of("notice").withColumnRenamed("id", "notice"), "digest", "left").groupBy("_row", "text_digest").agg(F.collect_set("notice").alias("_s"), F.count("notice").alias("n_notices"))
    out = found.join(of("text").select(F.col("digest").alias("text_digest"), F.col("id").alias("license_id")), "text_digest", "left")
    return out.select("_row.*", "text_digest", "license_id", F.array_join(F.sort_array("_s"), ",").alias("notice_ids"), "n_notices").select(*names, "text_digest", "license_id", "notice_ids", "n_notices")


def sql() -> str:
    """DuckDB SQL of :func:`scan` on ``documents``."""

    def form(c: str) -> str:
        c = f"lower(coalesce({c}, ''))"
        for pattern, to in STEPS:
            c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
        return f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"

    quote = lambda t: t.replace("'", "''")
    rows = ", ".join(f"('{kind}', '{name}', '{quote(text)}')" for kind, of in (("text", TEXTS), ("notice", NOTICES)) for name, texts in of.items() for text in texts)
    fixed = ", ".join(f"('text', '{name}', '{d}')" for name, of in DIGESTS.items() for d in of)
    return f"""
with k as (select kind, digest, min(id) as id from (select kind, id, sha256(array_to_string({form("t")}, ' ')) as digest from (values {rows}) v(kind, id, t) union all select * from (values {fixed}) f(kind, id, digest)) group by 1, 2),
d as (select row_number() over () as row, doc_id, {form("text")} as l from documents),
n as (select row, id from (select row, sha256(unnest(l)) as digest from d) x join k on k.digest = x.digest and k.kind = 'notice'),
s as (select row, string_agg(distinct id, ',' order by id) as ids, count(*) as n from n group by row)
select doc_id, sha256(array_to_string(l, ' ')) as text_digest, k.id as license_id, coalesce(s.ids, '') as notice_ids, coalesce(s.n, 0)::bigint as n_notices
from d left join s using (row) left join k on k.kind = 'text' and k.digest = sha256(array_to_string(l, ' '))"""
