"""Operator 5, licence scan by canonical digest; DataFrame functions only.

A text is normalised (lower case, copyright notices out, also behind comment signs,
equivalent spellings to one, ASCII punctuation and white space to single spaces),
its SHA-256 digest is joined by hash with the digests of known licence texts, and
the same is done for each line against the same table, so that notices inside longer
texts show.  A text is normalised once: its lines are cut out of the result before
they are joined to one.  The known texts go through the same expressions; the
common long licences are there as digests (``KNOWN_DIGESTS``).

The table: whole texts of MIT, ISC, 0BSD, BSD-2-Clause and BSD-3-Clause, the digests
of twelve longer licences, seven one-line notices.  A caller's own table (``known``) may
have any texts and size.

Defined cases: null or blank text has no licence and a null digest (also one of
copyright lines only); repeated rows are scanned as rows; a null id stays null;
known texts that normalise alike give the smallest name; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal (fixed values).
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("merchantibility", "merchantability"), ("https://", ""), ("http://", ""))

_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
             "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
             "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
_BSD_TAIL = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
             "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
             "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Public licence texts and notices by SPDX name (fixed values).
KNOWN = {
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "0BSD": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_TAIL,
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license.",
}

#: Digests of the canonical forms of longer licences (fixed values), from the plain texts as published.
KNOWN_DIGESTS = {
    "Apache-2.0": "4a0b5a7831e63e1ffbd7a198ec456bccf641ded314e1fac6acdf940a4e7b13ed",
    "Artistic-1.0-Perl": "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.3": "2cdb48855af1603586f28b20f0095e588a4bd77ee484d2c3b89bc3b1f0b61da5",
    "GPL-1.0": "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
    "GPL-2.0": "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
    "GPL-3.0": "24cd241e223e73eb1af195b9e4c0baf03a79bbbb39987eca0e347c1e490442aa",
    "LGPL-2.0": "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
    "LGPL-2.1": "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "e285f80aaf81d67143c0dc64cc084fdf2f0c560c2985326ec64d652ae51923af",
    "MPL-2.0": "b59ad31436b35a95a00cff48e84c1f014339f59fac784c1935fc6f7dc34abf70",
}

#: A line that is a copyright notice, behind comment signs or none.
_COPYRIGHT = r"(?m)^[ \t#/*;!%<>.-]*(copyright[ \t]*(\(c\)|©|:|by[ \t]|[0-9]{4}|\[yyyy\]|<year>)|\(c\)[ \t]*(copyright|[0-9]{4})|©|all rights reserved)[^\n]*$"
#: Everything but letters, digits, line ends and what is not ASCII.
_PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text; blank ones are left out."""
    text = F.regexp_replace(F.lower(text), "(?d)" + _COPYRIGHT, "")  # lines end at \\n alone
    for a, b in SPELLINGS:
        text = F.replace(text, F.lit(a), F.lit(b))
    lines = F.split(F.regexp_replace(text, _PUNCTUATION, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.btrim(x)), lambda x: x != "")


def digest(lines: Column) -> Column:
    """The digest of a whole text from its canonical lines; null if it has none."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None, digests: dict[str, str] | None = None) -> DataFrame:
    """digest, license.  Without arguments: the table of this module."""
    digests = KNOWN_DIGESTS if texts is None and digests is None else digests or {}
    df = spark.createDataFrame(sorted((KNOWN if texts is None else texts).items()), "license string, text string")
    df = df.select(digest(canonical_lines(F.col("text"))).alias("digest"), "license").where("digest is not null")
    df = df.union(spark.createDataFrame(sorted((d, name) for name, d in digests.items()), "digest string, license string"))
    return df.groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, digest (of the normalised text),
    license (whole text), notices (sorted names of licences that are whole
    lines of it).

    Lines are joined with the known table by hash and come back by the digest of the
    document they stand in: documents of one digest have the same lines, joined."""
    known = known if known is not None else known_licenses(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), canonical_lines(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("lines"))
    src = src.select("doc_id", digest(F.col("lines")).alias("digest"), F.array_distinct(F.transform("lines", lambda x: F.sha2(x, 256))).alias("lines"))
    # where lines end is not in the digest, so the lines name the document too
    src = src.withColumn("layout", F.xxhash64("lines"))
    found = (src.select("digest", "layout", F.explode("lines").alias("line")).join(known.withColumnRenamed("digest", "line"), "line")
             .groupBy("digest", "layout").agg(F.array_sort(F.collect_set("license")).alias("notices")))
    out = src.select("doc_id", "digest", "layout").join(found, ["digest", "layout"], "left").join(known, "digest", "left")
    return out.select("doc_id", "digest", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
