"""License scans by canonical digests, in DataFrame expressions only.

Case, punctuation, copyright lines and equivalent spellings are normalised away, and the digest of what is left is looked
up among the digests of known license texts, a table: for the whole text by a hash join, and for each of its lines.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import col

#: Spellings that mean the same in a license, to be replaced in this order.
EQUIVALENT = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("whilst", "while"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("https", "http"),
)
#: License notices, and one short license, by identifier.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
)
#: Whole license texts, a file each, named by identifier; a part after a second dot tells texts of one license apart.
TEXTS = Path(__file__).parent / "license_texts"
#: Titles that license files carry or leave out, and titles and names that stand for others.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License",
                     "New BSD License", "Modified BSD License"),
    "BSD-4-Clause-UC": ("BSD 4-Clause License",),
}
#: Wordings of a license's text that are in use beside the one of its file.
VARIANTS = {
    "ISC": (("and/or distribute", "and distribute"),),
    "BSD-2-Clause": (("COPYRIGHT HOLDER OR", "COPYRIGHT HOLDERS OR"),),
    "BSD-3-Clause": (("COPYRIGHT HOLDER OR", "COPYRIGHT HOLDERS OR"),),
    "Apache-2.0": (("Copyright [yyyy] [name of copyright owner]", ""),),
    "GPL-3.0": (("https://www.gnu.org/licenses/why-not-lgpl.html", "http://www.gnu.org/philosophy/why-not-lgpl.html"),),
}
#: The line that ends the terms of some licenses; what follows tells how to apply them and is often left out.
END = "END OF TERMS AND CONDITIONS"
#: Most known texts that are sent to all tasks, about 1 MB of digests.
MAX_KNOWN = 10_000

COPYRIGHT_LINE = r"(^|\n)[^\n]*(copyright [0-9(]|\(c\) ?[0-9]|©|all rights reserved)[^\n]*"
NOT_WORD = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """The text in small letters, without copyright lines, punctuation and spelling variants, words joined by one blank."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.trim(F.regexp_replace(out, NOT_WORD, " "))
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def whole_texts() -> list[tuple[str, str]]:
    """Identifier and text of the licenses in ``TEXTS``, with the forms in which license files give them."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.name.removesuffix(".txt"), path.read_text(encoding="utf-8")
        name = name.removesuffix(".regents")
        forms = [text]
        for old, new in VARIANTS.get(name, ()):
            forms += [x.replace(old, new) for x in forms if old in x]
        for x in list(forms):
            if END in x:
                forms += [x[: x.index(END)], x[: x.index(END)] + END]
        titles = TITLES.get(name, ())
        for x in forms:
            body = x.removeprefix(titles[0]) if titles else x
            out += [(name, x), *((name, f"{t}\n{body}") for t in ("", *titles) if titles)]
    return list(dict.fromkeys(out))


def known_texts(spark: SparkSession) -> DataFrame:
    """license_id, text of all notices and whole licenses that this module knows."""
    return spark.createDataFrame([*KNOWN, *whole_texts()], "license_id string, text string")


def known_licenses(known: DataFrame) -> DataFrame:
    """license_id, digest of the known texts; two texts of one digest are called by the lesser identifier.

    Texts without a word, and rows without an identifier, are not known.
    """
    rows = known.where(F.col("license_id").isNotNull() & (canonical(F.col("text")) != ""))
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, license_id (of the whole text, or null), n_license_lines, line_licenses (sorted, comma-joined).

    Null and empty texts, and texts of copyright lines alone, have no license. Every row stays, repeated ones and null
    ids too. ``known`` is a table of license_id and text, by default ``known_texts``; its digests, at most MAX_KNOWN,
    are broadcast. A text of several lines is found as a whole document, and a text of one line as a line too.
    """
    spark = docs.sparkSession
    found = known_licenses(known_texts(spark) if known is None else known).orderBy("digest").limit(MAX_KNOWN + 1).collect()
    if len(found) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known digests; at most {MAX_KNOWN} are sent to the tasks")
    table = spark.createDataFrame([(r.digest, r.license_id) for r in found], "digest string, license_id string")
    by_digest = F.map_from_entries(
        F.array(*(F.struct(F.lit(r.digest), F.lit(r.license_id)) for r in found)).cast("array<struct<digest:string,license_id:string>>")
    )
    rows = docs.select(col("doc_id"), F.coalesce(col("text").cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.try_element_at(by_digest, digest(x))), lambda x: x.isNotNull())
    rows = rows.select("doc_id", digest(F.col("text")).alias("digest"), lines.alias("found"))
    return rows.join(F.broadcast(table), "digest", "left").select(
        "doc_id", "license_id", F.size("found").cast("long").alias("n_license_lines"),
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_licenses"),
    )
