"""Licence scans by sentence rules, in DataFrame operations only.

A text is normalised and sentences known from licences are found in it, whether they stand on one
line or wrap over several, and whatever signs they have inside; the text becomes the sequence of their identifiers. Ordered rules, the most specific first, then turn
stretches of that sequence into licence names; what a rule has matched no later rule sees. Each
row is handled by itself: there is no shuffle, and no group to be skewed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, without

#: Sentences of well-known licences and of usual references to them, by identifier.
SENTENCES = (
    ("MitGrant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MitNotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("AsIsCaps", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MitLiability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MitRef", "Released under the MIT License."),
    ("MitRef", "Licensed under the MIT License."),
    ("MitRef", "This project is licensed under the MIT License."),
    ("MitRef", "SPDX-License-Identifier: MIT"),
    ("ApacheRef2", "Licensed under the Apache License, Version 2.0."),
    ("ApacheRef2", "SPDX-License-Identifier: Apache-2.0"),
    ("ApacheGrant2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("ApacheObtain", "You may obtain a copy of the License at"),
    ("ApacheAsIs", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License."),
    ("GplFree", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."),
    ("GplHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("GplSee", "See the GNU General Public License for more details."),
    ("GplCopy", "You should have received a copy of the GNU General Public License along with this program."),
    ("GplRef", "This work is licensed under the GNU General Public License, version {v}."),
    ("GplRef", "Licensed under the GNU General Public License, version {v}."),
    ("GplRef", "SPDX-License-Identifier: GPL-{v}.0-only"),
    ("BsdGrant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BsdSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BsdBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BsdEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BsdRef2", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BsdRef3", "SPDX-License-Identifier: BSD-3-Clause"),
    ("IscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MplRef2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MplRef2", "SPDX-License-Identifier: MPL-2.0"),
    ("CcBy", "Licensed under CC BY {c}."),
    ("CcBySa", "Licensed under CC BY-SA {c}."),
    ("CcByNc", "Licensed under CC BY-NC {c}."),
    ("CcByNd", "Licensed under CC BY-ND {c}."),
    ("CcByNcSa", "Licensed under CC BY-NC-SA {c}."),
    ("CcByNcNd", "Licensed under CC BY-NC-ND {c}."),
    ("Cc0", "SPDX-License-Identifier: CC0-1.0"),
    ("AllRights", "All rights reserved."),
)
_VERSIONS = {"{v}": ("2", "3"), "{c}": ("2.0", "2.5", "3.0", "4.0")}
#: Identifier sequences, the first that matches anywhere wins; ``#`` stands for the version of the identifier before it.
RULES = (
    ("MitGrant MitNotice AsIsCaps MitLiability", "MIT"),
    ("MitGrant MitNotice AsIsCaps", "MIT"),
    ("ApacheGrant2 ApacheObtain ApacheAsIs ApacheSee", "Apache-2.0"),
    ("ApacheGrant2", "Apache-2.0"),
    ("GplFree-# GplHope GplSee GplCopy", "GPL-#.0-or-later"),
    ("GplFree-# GplHope GplSee", "GPL-#.0-or-later"),
    ("GplFree-#", "GPL-#.0-or-later"),
    ("BsdGrant BsdSource BsdBinary BsdEndorse", "BSD-3-Clause"),
    ("BsdGrant BsdSource BsdBinary", "BSD-2-Clause"),
    ("IscGrant", "ISC"),
    ("MitRef", "MIT"),
    ("ApacheRef2", "Apache-2.0"),
    ("GplRef-#", "GPL-#.0-only"),
    ("BsdRef2", "BSD-2-Clause"),
    ("BsdRef3", "BSD-3-Clause"),
    ("MplRef2", "MPL-2.0"),
    ("CcByNcSa-#", "CC-BY-NC-SA-#"),
    ("CcByNcNd-#", "CC-BY-NC-ND-#"),
    ("CcByNc-#", "CC-BY-NC-#"),
    ("CcByNd-#", "CC-BY-ND-#"),
    ("CcBySa-#", "CC-BY-SA-#"),
    ("CcBy-#", "CC-BY-#"),
    ("Cc0", "CC0-1.0"),
    ("AllRights", "Proprietary"),
)
#: A sentence without any of these can be neither known nor of a licence.
HINT = r"(?i)licen[sc]e|copyright|permission|redistribut|warrant|liable|all rights reserved|free software|endorse|you may obtain"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    found = {}
    for name, text in SENTENCES:
        mark = next((m for m in _VERSIONS if m in text), None)
        for v in _VERSIONS.get(mark, ("",)):
            found[normal(text.replace(mark or "{}", v))] = f"{name}-{v}" if mark else name
    return found


def expanded_rules() -> list[tuple[str, str]]:
    found = []
    for pattern, name in RULES:
        versions = ("",) if "#" not in pattern else _VERSIONS["{c}" if pattern.startswith("Cc") else "{v}"]
        found += [(pattern.replace("#", v), name.replace("#", v)) for v in versions]
    return found


#: Marks in a normalised text: a line end, a sentence end, a blank line. What parts two words of one known sentence.
_LINE, _END, _BLANK = "\n", "\x01", "\x02"
_GAP = f"[ {_LINE}{_END}]++"


def known_pattern() -> str:
    """A known sentence in a normalised text: from a line's or sentence's begin to such an end, over line ends and signs within."""
    words = sorted(known_sentences(), key=lambda s: (-len(s), s))
    edge = f"[{_LINE}{_END}{_BLANK}]"
    return f"(?<=^|^ |{edge}|{edge} )(?:{'|'.join(_GAP.join(s.split()) for s in words)})(?= ?(?:{edge}|\\z))"


def normalised(text: Column) -> Column:
    """``text`` in lower case, its words parted by blanks or marks; comment signs before a line vanish, lines of nothing else are blank."""
    plain = F.regexp_replace(F.lower(F.translate(text, _END + _BLANK, "  ")), r"\n[^a-z0-9\n]*+\n[^a-z0-9]*+", _BLANK)
    plain = F.regexp_replace(plain, r"[.!?:;][ \t\r\n]", _END)
    return F.regexp_replace(plain, f"[^a-z0-9{_LINE}{_END}{_BLANK}]+", " ")


def licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids``, ``licences`` (both strings), ``n_unknown`` and ``status``.

    ``sentence_ids``: identifiers of the known sentences in order, parted by spaces. ``licences``: names
    by the order of the rules, each once, parted by `` AND ``. A known sentence may wrap over lines, with
    comment signs before each; a blank line ends it. ``n_unknown``: what is left and names a licence, grant
    or disclaimer, counted by lines and by sentence ends within them. ``status``: ``known`` if a rule matched, else ``unknown`` if
    there are such sentences or unmatched identifiers, else ``none``. A null or empty text has none.
    Each row is judged alone, so repeated rows come out alike; very long texts are read whole, an empty
    table gives an empty one. Columns of these names are replaced; no other column but the text is looked at.
    """
    base = without(docs, "sentence_ids", "licences", "n_unknown", "status")
    known = F.create_map(*[F.lit(x) for pair in sorted(known_sentences().items()) for x in pair])
    # texts without a hint need no splitting at all
    hint = F.col(f"`{text}`").rlike(HINT.replace(" ", "[^a-z0-9]+"))
    pattern = known_pattern()

    def taken(plain: Column) -> Column:
        hits = F.transform(F.regexp_extract_all(plain, F.lit(pattern), F.lit(0)), lambda s: F.element_at(known, F.regexp_replace(s, _GAP, " ")))
        rest = F.split(F.regexp_replace(plain, pattern, _BLANK), f"[{_LINE}{_END}{_BLANK}]")
        return F.struct(F.array_join(hits, " ").alias("ids"), F.size(F.filter(rest, lambda s: s.rlike(HINT))).cast("long").alias("n"))

    # the normalised text is named once, so that it is not computed again for each use
    one = F.element_at(F.transform(F.array(normalised(F.col(f"`{text}`"))), taken), 1)
    found = base.withColumn("ids_", F.when(hint, one))
    found = found.withColumn("sentence_ids", F.coalesce("ids_.ids", F.lit(""))).withColumn("n_unknown", F.coalesce("ids_.n", F.lit(0).cast("long")))
    rules = F.array(*[F.struct(F.lit(f" {'  '.join(p.split())} ").alias("p"), F.lit(n).alias("n")) for p, n in expanded_rules()])
    start = F.struct(F.concat(F.lit(" "), F.replace(F.col("sentence_ids"), F.lit(" "), F.lit("  ")), F.lit(" ")).alias("rest"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        pattern = rule["p"]
        hit = F.contains(state["rest"], pattern)
        return F.struct(F.when(hit, F.replace(state["rest"], pattern, F.lit(" | "))).otherwise(state["rest"]).alias("rest"), F.when(hit, F.concat(state["names"], F.array(rule["n"]))).otherwise(state["names"]).alias("names"))

    matched = F.when(F.col("sentence_ids") != "", F.aggregate(rules, start, apply, lambda s: F.array_join(F.array_distinct(s["names"]), " AND "))).otherwise("")
    found = found.withColumn("licences", matched)
    status = F.when(F.col("licences") != "", "known").when((F.col("n_unknown") > 0) | (F.col("sentence_ids") != ""), "unknown").otherwise("none")
    return found.withColumn("status", status).select(*[F.col(f"`{c}`") for c in base.columns], "sentence_ids", "licences", "n_unknown", "status")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sentence_ids, licences, n_unknown, status) of every document."""
    return licences(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "sentence_ids", "licences", "n_unknown", "status")


def _sql() -> str:
    known = ", ".join(f"('{k}', '{v}')" for k, v in sorted(known_sentences().items()))
    last, steps = "s0", []
    for i, (p, n) in enumerate(expanded_rules()):
        pattern = " " + "  ".join(p.split()) + " "
        steps.append(f"s{i + 1} as (select doc_id, ids, unknown, case when contains(rest, '{pattern}') then replace(rest, '{pattern}', ' | ') else rest end as rest, case when contains(rest, '{pattern}') then list_append(names, '{n}') else names end as names from {last})")
        last = f"s{i + 1}"
    hint = HINT.replace("(?i)", "")
    return rf"""
with known(s, id) as (values {known}),
lines as (select row_number() over () as r, doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?:;])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)), lambda x: regexp_matches(x, '{hint}', 'i')) as l from documents),
parts as (select r, doc_id, unnest(l) as line, unnest(range(len(l))) as pos from lines),
named as (select r, pos, coalesce(id, '?') as id from parts left join known on s = trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g'))),
seqs as (select r, coalesce(list(id order by pos) filter (id <> '?'), []) as ids, count(*) filter (id = '?') as unknown from named group by r),
s0 as (select doc_id, coalesce(array_to_string(ids, ' '), '') as ids, coalesce(unknown, 0) as unknown, ' ' || coalesce(array_to_string(ids, '  '), '') || ' ' as rest, []::varchar[] as names from lines left join seqs using (r)),
{", ".join(steps)},
done as (select doc_id, ids, unknown, array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ' AND ') as licences from {last})
select doc_id, ids as sentence_ids, licences, unknown as n_unknown, case when licences <> '' then 'known' when unknown > 0 or ids <> '' then 'unknown' else 'none' end as status from done
"""


OP10_SQL = _sql()
