"""Operator 5: licences by digest of their canonical text.

Texts are brought to a canonical form: lower case, no copyright lines, words
separated by two blanks in place of any punctuation and space, one spelling
for words that have several.  The SHA-256 of the whole canonical text is
joined with the digests of known licences.

The licences are a table of the caller's; the query uses the fixed ones
below, texts of short licences (with and without a title) and digests of long
ones.  Each row's digest is made within the row, and the join is on the
digest alone, so that a text with a third of all rows meets one licence row.

Defined cases: a null text is an empty one; a text whose canonical form is
empty matches nothing; licences with one canonical text answer with the
smallest license_id; repeated rows are each returned; an empty table gives an
empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that begins, after comment marks, with a copyright notice.  A line
#: that says "all rights reserved" and no more goes as well.
COPYRIGHT = (
    r"(?m)^[ \t#*/;-]*(?:(?:copyright[ \t]+(?:\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*"
    r"|all rights reserved[ \t\r.]*$)"
)
#: ASCII punctuation and space, and common signs beyond ASCII.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F “”‘’«»–—…©®™•]+"

# Words that count as equal, each with the spelling kept.
EQUIVALENT = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "licencing": "licensing",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# End of two of the licences below.
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)

# Short licence texts and notices.
KNOWN = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
        "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
        "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. " + _BSD_END
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. " + _BSD_END
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright "
        "law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to "
        "<https://unlicense.org>"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is granted "
        "to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions: 1. The origin of this software "
        "must not be misrepresented; you must not claim that you wrote the original software. If you use this "
        "software in a product, an acknowledgment in the product documentation would be appreciated but is "
        "not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any "
        "source distribution."
    ),
    "notice:Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice:CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice:GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "notice:MIT": "Released under the MIT License.",
}


# Titles above some of them.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Zlib": ("zlib License", "The zlib License"),
}

# Digests of the canonical forms of longer licences: of the whole
# text and, where it has one, up to the line that ends the terms.
DIGESTS = [
    ("Apache-2.0", "8a25ab4281a1b7eddf06c1acb6c7967626bb4787b5f8891bc03a43e6533e9488"),
    ("Apache-2.0", "232841ff360c5f802a46d8a949a195a6a6f1c34354dd4b45451267904b56e582"),
    ("Artistic-1.0-Perl", "8ab04e21a67c045e56bbc8239ab338a190781c6a4a9a3bd33cb6f8141ee9dc25"),
    ("BSD-3-Clause", "c259a82f87a240dd406de8df8a423e0d000cb6cc432de53e13db4870e471a949"),
    ("CC0-1.0", "1b1e1b0668e591dc12cc2c1f858df46627fa560d83b45f65c1b3df60188b525e"),
    ("GFDL-1.2", "d2186c5f442860477667992ba9e7aef66161c19b707f4926eb120594ccd76bd5"),
    ("GFDL-1.3", "ff69a8eb22fc4dfc162ccf357ece6dd039ca227b7f1c533030e75e84e023b423"),
    ("GPL-1.0", "34ea638201b9c902b85e4c3381ddbd1977f9f00430fe799d31496a06c01c7a40"),
    ("GPL-1.0", "939e57bb166d145ba6191ad1922258d17dc60b0bfacae63b307c9d54fc2a503e"),
    ("GPL-2.0", "62bca74c957854320da586adcf5a34d9affc69a87ca542e28048543545c4873c"),
    ("GPL-2.0", "98842b3f64c15a487ee0df625eb8bdb0c9126539a8f0aca61b0dee0f16b031ed"),
    ("GPL-3.0", "80182b5ea76bcc0996eee0c024e9e1767151111ab2064843bb08eafa7ff6e7ae"),
    ("GPL-3.0", "ef472b47437a4164eafac24266d8ec60bfe835cab1018f8894a64b219ed4e9f7"),
    ("LGPL-2.0", "c240c0c7cd32f69796fadf571ea2ae65798be3e2dcd49d885a6892428943322a"),
    ("LGPL-2.0", "fbc49af13433930b5687809de62a7e47dc6fd9f35f14d4b284eff07e4a82117a"),
    ("LGPL-2.1", "3c5cab0412f6274fe45e64786bb249da51c994fde68bcb825a626a1495d69a0e"),
    ("LGPL-2.1", "1c11e2f4f72a52688183139587fac7a1388a7d003e3c5c4ecf96e0421a985b48"),
    ("LGPL-3.0", "8854f67344795b2c32a6117438109542910956a2779aec3dd280b9f7748b0c9b"),
    ("MPL-1.1", "635cea3dfab9a3ae37a0b63240254cd77f0460a65cda1bda741bb9598d2ecfa5"),
    ("MPL-2.0", "209ee27067087ce012420bbfe7fd74996a53fedf54cf20682791ba6e707a2f51"),
]


def canonical(text: Column) -> Column:
    """The canonical form of a text: every word with a blank on both sides."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, COPYRIGHT, "")
    t = F.concat(F.lit(" "), F.btrim(F.regexp_replace(t, BREAKS, "  ")), F.lit(" "))
    for word, kept in EQUIVALENT.items():
        t = F.replace(t, F.lit(f" {word} "), F.lit(f" {kept} "))
    return t


def license_digests(licenses: DataFrame) -> DataFrame:
    """canonical_sha256 and license_id of a table with license_id and text."""
    c = licenses.select("license_id", canonical(F.col("text")).alias("c"))
    return (
        c.where(F.btrim("c") != "")
        .groupBy(F.sha2("c", 256).alias("canonical_sha256"))
        .agg(F.min("license_id").alias("license_id"))
    )


def known_texts() -> list[tuple[str, str]]:
    """license_id and text of the short licences, with each of their titles
    and without one."""
    titled = [(k, f"{title}\n\n{KNOWN[k]}") for k, titles in TITLES.items() for title in titles]
    return [*KNOWN.items(), *titled]


def known_licenses(spark) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def known_digests(spark) -> DataFrame:
    """canonical_sha256 and license_id of all known licences, long ones too."""
    long = spark.createDataFrame([(h, k) for k, h in DIGESTS], "canonical_sha256 string, license_id string")
    both = license_digests(known_licenses(spark)).unionByName(long)
    return both.groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))


def digest_lookup(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256 and the license_id of the whole text, or null;
    ``digests`` has canonical_sha256 (each once) and license_id."""
    d = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"))
    return d.join(digests, "canonical_sha256", "left").select("doc_id", "canonical_sha256", "license_id")


def license_lookup(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """``digest_lookup`` with a table of license_id and text."""
    return digest_lookup(docs, license_digests(licenses))


def query(spark, sf_dir):
    return digest_lookup(table(spark, sf_dir, "documents"), known_digests(spark))


def _canonical_sql(text: str) -> str:
    breaks = BREAKS.replace(r" ", " ")
    t = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    t = f"regexp_replace({t}, '{COPYRIGHT}', '', 'g')"
    t = f"' ' || trim(regexp_replace({t}, '{breaks}', '  ', 'g')) || ' '"
    for word, kept in EQUIVALENT.items():
        t = f"replace({t}, ' {word} ', ' {kept} ')"
    return t


def oracle_sql() -> str:
    texts = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in known_texts())
    digests = ", ".join(f"('{h}', '{k}')" for k, h in DIGESTS)
    return f"""
WITH k AS (
  SELECT canonical_sha256, min(license_id) AS license_id
  FROM (SELECT sha256({_canonical_sql("text")}) AS canonical_sha256, license_id
        FROM (VALUES {texts}) AS t(license_id, text)
        UNION ALL
        SELECT * FROM (VALUES {digests}) AS h(canonical_sha256, license_id))
  GROUP BY 1
)
SELECT doc_id, d.canonical_sha256, license_id
FROM (SELECT doc_id, sha256({_canonical_sql("text")}) AS canonical_sha256 FROM documents) d
LEFT JOIN k ON d.canonical_sha256 = k.canonical_sha256
"""
