"""License scans by sentence rules, in DataFrame functions only.

Texts are cut into clauses (after ``.``, ``!``, ``?``, ``:`` or ``;`` before white
space, at line ends, after web addresses and list marks) of lower-case words. A known sentence is
one clause or several in a row: it starts and ends where a clause does, and whatever
ends of clauses are inside it don't count. So "v. 2.0", a semicolon, a wrapped line, a
blank one or a comment mark hide no sentence, and a sentence that ends at a colon is
one. Where a sentence names an owner, any name of up to 30 words is that sentence, and
"this project is licensed under" (library, file and so on) counts as "licensed under". The
identifiers of a document, in order, are matched against licence rules: each
rule is a sequence of identifiers, the leftmost match wins, a longer rule before a
shorter one, and matches don't overlap.

The SQL finds sentences that are whole lines, or whole between ``.``, ``!`` or ``?``, as
in the driver's tables; tests hold the standard texts against the rules.

``SPDX-License-Identifier`` lines count with a single identifier; of expressions with AND, OR
or WITH, and of the old identifiers such as GPL-2.0+, nothing is reported.

Everything happens within a row: no shuffle, no join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences, normalised, and their identifiers.
SENTENCES = {
    "A01": "licensed under the apache license version 2 0",
    "A02": "licensed under the apache license version 2 0 the license",
    "A03": "you may not use this file except in compliance with the license",
    "A04": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "A05": "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
           "on an as is basis without warranties or conditions of any kind either express or implied",
    "A06": "see the license for the specific language governing permissions and limitations under the license",
    "M01": "released under the mit license",
    "M02": "licensed under the mit license",
    "M03": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction including without limitation the "
           "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
           "persons to whom the software is furnished to do so subject to the following conditions",
    "M04": "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
           "of the software",
    "M05": "the software is provided as is without warranty of any kind express or implied including but not limited to the "
           "warranties of merchantability fitness for a particular purpose and noninfringement",
    "M06": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
           "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
           "other dealings in the software",
    "G01": "licensed under the gnu general public license version 3",
    "G02": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
           "license as published by the free software foundation either version 3 of the license or at your option any later "
           "version",
    "G03": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
           "license as published by the free software foundation either version 2 of the license or at your option any later "
           "version",
    "G04": "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
           "warranty of merchantability or fitness for a particular purpose",
    "G05": "see the gnu general public license for more details",
    "B01": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
           "following conditions are met",
    "B02": "redistributions of source code must retain the above copyright notice this list of conditions and the following "
           "disclaimer",
    "B03": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
           "following disclaimer in the documentation and or other materials provided with the distribution",
    "B04": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
           "products derived from this software without specific prior written permission",
    "P01": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "P02": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "C01": "licensed under cc by nc 4 0",
    "C02": "licensed under cc by 4 0",
    "C03": "licensed under cc by sa 4 0",
    "C04": "licensed under a creative commons attribution 4 0 international license",
    "C05": "licensed under a creative commons attribution sharealike 4 0 international license",
    "C06": "licensed under a creative commons attribution noncommercial 4 0 international license",
    "G06": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "general public license version 2 as published by the free software foundation",
    "G07": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "general public license as published by the free software foundation version 2 of the license",
    "G08": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "general public license version 3 as published by the free software foundation",
    "L01": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
           "lesser general public license as published by the free software foundation either version 2 1 of the "
           "license or at your option any later version",
    "L02": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
           "lesser general public license as published by the free software foundation either version 3 of the "
           "license or at your option any later version",
    "L03": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "lesser general public license as published by the free software foundation either version 3 of the "
           "license or at your option any later version",
    "L04": "this library is distributed in the hope that it will be useful but without any warranty without even "
           "the implied warranty of merchantability or fitness for a particular purpose",
    "L05": "see the gnu lesser general public license for more details",
    "F01": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "affero general public license as published by the free software foundation either version 3 of the "
           "license or at your option any later version",
    "F02": "see the gnu affero general public license for more details",
    "I01": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted provided that the above copyright notice and this permission notice appear in all "
           "copies",
    "I02": "permission to use copy modify and distribute this software for any purpose with or without fee is "
           "hereby granted provided that the above copyright notice and this permission notice appear in all "
           "copies",
    "I03": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "I04": "the software is provided as is and the author disclaims all warranties with regard to this software "
           "including all implied warranties of merchantability and fitness",
    "Z01": "this software is provided as is without any express or implied warranty",
    "Z02": "in no event will the authors be held liable for any damages arising from the use of this software",
    "Z03": "permission is granted to anyone to use this software for any purpose including commercial "
           "applications and to alter it and redistribute it freely subject to the following restrictions",
    "X01": "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
           "software and accompanying documentation covered by this license the software to use reproduce "
           "display distribute execute and transmit the software and to prepare derivative works of the software "
           "and to permit third parties to whom the software is furnished to do so all subject to the following",
    "X02": "distributed under the boost software license version 1 0",
    "K01": "to the extent possible under law the author has waived all copyright and related or neighboring "
           "rights to this work",
    "K02": "cc0 1 0 universal",
    "U01": "this is free and unencumbered software released into the public domain",
    "R01": "all rights reserved",
}
# Licences and the sentence sequences that state them.
RULES = {
    "A02 A03 A04 A05 A06": "Apache-2.0",
    "A02 A03 A04": "Apache-2.0",
    "A02 A03": "Apache-2.0",
    "A01": "Apache-2.0",
    "M03 M04 M05 M06": "MIT",
    "M03 M04 M05": "MIT",
    "M03 M04": "MIT",
    "M01": "MIT",
    "M02": "MIT",
    "G02 G04 G05": "GPL-3.0-or-later",
    "G02": "GPL-3.0-or-later",
    "G03 G04 G05": "GPL-2.0-or-later",
    "G03": "GPL-2.0-or-later",
    "G01": "GPL-3.0",
    "B01 B02 B03 B04": "BSD-3-Clause",
    "B01 B02 B03": "BSD-2-Clause",
    "P01 P02": "MPL-2.0",
    "P01": "MPL-2.0",
    "C01": "CC-BY-NC-4.0",
    "C06": "CC-BY-NC-4.0",
    "C02": "CC-BY-4.0",
    "C04": "CC-BY-4.0",
    "C03": "CC-BY-SA-4.0",
    "C05": "CC-BY-SA-4.0",
    "G06": "GPL-2.0-only",
    "G07": "GPL-2.0-only",
    "G08": "GPL-3.0-only",
    "L01 L04 L05": "LGPL-2.1-or-later",
    "L01": "LGPL-2.1-or-later",
    "L02 L04 L05": "LGPL-3.0-or-later",
    "L02": "LGPL-3.0-or-later",
    "L03": "LGPL-3.0-or-later",
    "F01 G04 F02": "AGPL-3.0-or-later",
    "F01": "AGPL-3.0-or-later",
    "I01 I04": "ISC",
    "I01": "ISC",
    "I02 I04": "ISC",
    "I02": "ISC",
    "I03 I04": "0BSD",
    "I03": "0BSD",
    "Z01 Z02 Z03": "Zlib",
    "Z03": "Zlib",
    "X01": "BSL-1.0",
    "X02": "BSL-1.0",
    "K01": "CC0-1.0",
    "K02": "CC0-1.0",
    "U01": "Unlicense",
    "R01": "All-Rights-Reserved",
}
# Names that stand after "licensed under the" or "released under the", and identifiers of SPDX tags.
NAMED = {
    "apache license 2 0": "Apache-2.0",
    "apache 2 0 license": "Apache-2.0",
    "bsd 2 clause license": "BSD-2-Clause",
    "2 clause bsd license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "3 clause bsd license": "BSD-3-Clause",
    "isc license": "ISC",
    "zlib license": "Zlib",
    "boost software license version 1 0": "BSL-1.0",
    "mozilla public license version 2 0": "MPL-2.0",
    "mozilla public license 2 0": "MPL-2.0",
    "gnu general public license version 2": "GPL-2.0",
    "gnu lesser general public license version 2 1": "LGPL-2.1",
    "gnu lesser general public license version 3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0",
    "unlicense": "Unlicense",
}
SPDX = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0",
        "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib")
for _n, (_name, _license) in enumerate((f"{v} under the {k}", x) for v in ("licensed", "released") for k, x in NAMED.items()):
    SENTENCES[f"N{_n:02}"], RULES[f"N{_n:02}"] = _name, _license
for _n, _license in enumerate(SPDX):
    SENTENCES[f"S{_n:02}"], RULES[f"S{_n:02}"] = f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', _license.lower())}", _license
# Each known sentence holds one of these, so texts without them are passed by.
KEYS = ("licens", "copyright", "permi", "software", "reserved", "mpl", "modif", "cc0")

# Parts of sentences that texts fill in or put in front, and the words of the known sentence ({1}: the group).
THIS_WORK = ("this (?:project|software|library|program|package|source code|code|work|file|crate|module|repository|tool|"
             "document|documentation|material|content) is")
SLOTS = (
    (False, "neither the names? of (?:[a-z0-9]+ ){1,30}?nor the names of (?:its|their) contributors",
     "neither the name of the copyright holder nor the names of its contributors"),
    (True, "to the extent possible under law (?:[a-z0-9]+ ){1,30}?has waived all copyright and related or neighboring rights to [a-z0-9\\x20]+",
     SENTENCES["K01"]),
    (True, f"{THIS_WORK} (?:made )?available under", "released under"),
    (True, f"{THIS_WORK} (licensed|released|distributed) under", "{1} under"),
    (True, "(licensed|released|distributed) under the terms of the", "{1} under the"),
)

RULE_PATTERN = "|".join(sorted(RULES, key=lambda r: (-len(r), r)))
#: Web addresses, after which a clause ends; other ends of clauses; words that open a comment line (marks without letters go by themselves); "(1)", "b)" and the like.
ADDRESS = r"https?://[^ \t\r\n]+"
CLAUSE_END = r"""[.!?:;]["')\]]*(?=[ \t\r\n])|[\r\n]"""
COMMENT_WORD = r"\n[ \t]*@?(?:rem|dnl)(?=[ \t\n])"
LIST_MARK = r"\n[^a-z0-9\n]*([0-9]{1,3}|[a-z]|[ivx]{1,4})[)\]]"
#: Clause ends may be between any two words of a sentence.
SENTENCE_PATTERN = f"\n({'|'.join(s.replace(' ', '[ \n]') for s in sorted(SENTENCES.values(), key=lambda s: (-len(s), s)))})(?=\n)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _has_key(text: Column) -> Column:
    found = text.contains(KEYS[0])
    for k in KEYS[1:]:
        found = found | text.contains(k)
    return found


def _sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a lower-case text, in order."""
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    clauses = F.concat(F.lit("\n"), F.regexp_replace(F.regexp_replace(text, ADDRESS, "$0\n"), CLAUSE_END, "\n"), F.lit("\n"))
    clauses = F.regexp_replace(F.regexp_replace(clauses, COMMENT_WORD, "\n"), LIST_MARK, "\n$1\n")
    clauses = F.regexp_replace(F.regexp_replace(clauses, "[^a-z0-9\n]+", " "), " *\n[ \n]*", "\n")
    for start, slot, filled in SLOTS:
        at = "\n" if start else ""
        clauses = F.regexp_replace(clauses, at + slot.replace(" ", "[ \n]"), at + filled.replace("{1}", "$1"))
    found = F.regexp_extract_all(clauses, F.lit(SENTENCE_PATTERN), F.lit(1))
    return F.transform(found, lambda s: F.try_element_at(known, F.translate(s, "\n", " ")))


def _licenses(ids: Column) -> Column:
    rules = F.create_map(*[F.lit(x) for r, name in RULES.items() for x in (r, name)])
    matches = F.regexp_extract_all(F.array_join(ids, " "), F.lit(f"({RULE_PATTERN})"), F.lit(1))
    return F.transform(matches, lambda m: F.try_element_at(rules, m))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): sentence_ids,
    the known sentences in order; licenses, the licences they state, each once.

    Null or empty text and text without licence sentences: empty arrays. Null doc_id
    stays null; repeated rows give repeated rows; empty table: no rows."""
    none = F.array().cast("array<string>")
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select("doc_id", low.alias("low"))
    rows = rows.select("doc_id", F.when(_has_key(F.col("low")), _sentence_ids(F.col("low"))).otherwise(none).alias("sentence_ids"))
    return rows.select("doc_id", "sentence_ids", F.array_distinct(_licenses(F.col("sentence_ids"))).alias("licenses"))


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _pairs(d: dict[str, str]) -> str:
    return f"MAP {{{', '.join(f"'{k}': '{v}'" for k, v in d.items())}}}"


def _duck_ids(text: str) -> str:
    known = _pairs({s: i for i, s in SENTENCES.items()})
    words = "trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))"
    for start, slot, filled in SLOTS:
        words = f"regexp_replace({words}, '{'^' if start else ''}{slot}', '{filled.replace('{1}', '\\1')}')"
    words = f"[{words} FOR s IN string_split(regexp_replace({text}, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))]"
    return f"list_filter([({known})[s] FOR s IN {words}], lambda i: i IS NOT NULL)"


ORACLE = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
i AS (SELECT doc_id, {_duck_ids("low")} AS a,
    {_duck_ids("regexp_replace(low, '([^\\n])\\n([^\\n])', '\\1 \\2', 'g')")} AS b FROM d),
m AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids,
    [({_pairs(RULES)})[r] FOR r IN regexp_extract_all(array_to_string(a, ' '), '{RULE_PATTERN}')] AS x,
    [({_pairs(RULES)})[r] FOR r IN regexp_extract_all(array_to_string(b, ' '), '{RULE_PATTERN}')] AS y FROM i)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
    array_to_string(x || list_filter(list_distinct(y), lambda r: NOT list_contains(x, r)), ',') AS licenses
FROM (SELECT doc_id, ids, list_reduce(list_prepend(CAST([] AS VARCHAR[]), [[r] FOR r IN x]),
    lambda p, q: CASE WHEN list_contains(p, q[1]) THEN p ELSE p || q END) AS x, y FROM m)
"""
