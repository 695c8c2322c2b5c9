"""License scan by canonical digest lookup (operator 4, DataFrame functions only).

A text's canonical form is lower case, without copyright lines, with equivalent
spellings made equal and every run of other characters than letters and digits
made one blank.  The digests of whole documents, and of each of their lines,
are joined to the digests of known licence texts and notices: two texts are
the same licence exactly if their canonical forms are equal.

Known texts are a small table (their number is fixed by the caller, not by
the corpus), so the lookup is a broadcast hash join and the lines are never
shuffled; only matches are aggregated per document.

Defined results: null and empty texts have the digest of the empty string and
no licence; blank lines match nothing; repeated doc_ids are reported once (the
smallest digest, licences of all rows); an empty table gives an empty result;
texts of any length are read whole; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A larger table of known texts is joined without a broadcast (a row has about 100 bytes).
BROADCAST_ROWS = 100_000
#: Patterns valid both for Java and RE2.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
# Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = (("https://", "http://"), ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
             ("per cent", "percent"), ("organisation", "organization"), ("favour", "favor"), ("authorisation", "authorization"),
             ("merchantibility", "merchantability"), ("&", " and "))
OTHER = r"[^\p{L}\p{N}\n]+"

# Known licence texts and notices (fixed values).
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
          "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS)
_ISC_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                 "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                 "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
                 "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
                 "PERFORMANCE OF THIS SOFTWARE.")
KNOWN = (
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)


def canonical_lines(text: Column) -> Column:
    """Canonical form with its line ends (blank lines stay)."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, OTHER, " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``license, digest`` of every known text, once each."""
    return (spark.createDataFrame(list(known), "license string, text string")
            .select("license", digest(whole(canonical_lines(F.col("text")))).alias("digest")).distinct().coalesce(1))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per doc_id: ``digest`` of the whole text, ``license`` it equals (null: none),
    ``notices`` (licences of its lines, sorted and distinct, comma-joined) and
    ``n_notice_lines``."""
    line = lambda x: digest(F.trim(x))
    units = (docs.select(F.col(id_col).cast("long").alias("doc_id"), canonical_lines(F.col(text_col)).alias("c"))
             .select("doc_id", F.concat(
                 F.array(digest(whole(F.col("c")))),
                 F.transform(F.filter(F.split("c", "\n", -1), lambda x: F.trim(x) != ""), line)).alias("units"))
             .select("doc_id", F.posexplode("units").alias("unit", "digest")))
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = units.join(F.broadcast(known) if few else known, "digest", "left").filter("unit = 0 or license is not null")
    first = F.col("unit") == 0
    return (found.groupBy("doc_id").agg(
        F.min(F.when(first, F.col("digest"))).alias("digest"),
        F.min(F.when(first, F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~first, F.col("license")))), ",").alias("notices"),
        F.count_if(~first).alias("n_notice_lines")))


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def lines(x: str) -> str:
        out = f"regexp_replace(lower(coalesce({x}, '')), {quote(COPYRIGHT_LINE)}, '', 'g')"
        for a, b in SPELLINGS:
            out = f"replace({out}, {quote(a)}, {quote(b)})"
        return f"regexp_replace({out}, {quote(OTHER)}, ' ', 'g')"

    def flat(x: str) -> str:
        return f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))"
    values = ", ".join(f"({quote(k)}, {quote(t)})" for k, t in KNOWN)
    return f"""
WITH known AS (SELECT DISTINCT license, sha256({flat(lines('t'))}) AS digest FROM (VALUES {values}) AS v(license, t)),
c AS (SELECT doc_id, {lines('text')} AS c FROM documents),
d AS (SELECT doc_id, min(sha256({flat('c')})) AS digest, min(license) AS license
      FROM c LEFT JOIN known ON known.digest = sha256({flat('c')}) GROUP BY doc_id),
l AS (SELECT doc_id, sha256(trim(line)) AS digest
      FROM (SELECT doc_id, unnest(string_split(c, chr(10))) AS line FROM c) WHERE trim(line) <> ''),
n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notice_lines
      FROM l JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, d.digest, d.license, coalesce(notices, '') AS notices, coalesce(n_notice_lines, 0) AS n_notice_lines
FROM d LEFT JOIN n USING (doc_id)"""
