"""Standard licence texts on one line, wrapped, and as comments."""

import textwrap

import pytest

from ordertide.llm import licenses

APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
          "License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by "
          'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
          "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
          "governing permissions and limitations under the License.")
MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
       'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
       "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
       "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
       "notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", "
       "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
       "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
       "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
       "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
GPL = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License "
       "as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version."
       "\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
       "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:\n\n{0}Redistributions of source code must retain the above copyright notice, this list of conditions and "
       "the following disclaimer.\n\n{1}Redistributions in binary form must reproduce the above copyright notice, this list of "
       "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD3 = BSD + ("\n\n{2}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
       "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
CC = "This work is licensed under a Creative Commons Attribution{0} 4.0 International License."
ONLY = GPL.replace("{1} either version {2} of the License, or (at your option) any later version.", "{1} version {2} of the License.")
NAMED = GPL.replace("License as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version.",
                    "License version {2} as published by the Free Software Foundation.")
LGPL = GPL.replace("General", "Lesser General").replace("This program", "This library")
AGPL = GPL.replace("General", "Affero General")
ISC = ("Permission to use, copy, modify, and{0} distribute this software for any purpose with or without fee is hereby granted{1}.\n\n"
       'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
       "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL DAMAGES.")
NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of "
        "this software must not be misrepresented; you must not claim that you wrote the original software.")
BOOST = ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
         'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the '
         "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to "
         "do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement must be included.")
CC0 = "To the extent possible under law, {0} has waived all copyright and related or neighboring rights to {1}."
TEXTS = [
    ("G07", "GPL-2.0-only", ONLY.format(";", ";", 2).split("\n")[0]), ("G06", "GPL-2.0-only", NAMED.format(";", "", 2).split("\n")[0]),
    ("G08", "GPL-3.0-only", NAMED.format(":", "", 3).split("\n")[0]),
    ("L01 L04 L05", "LGPL-2.1-or-later", LGPL.format(";", ";", 2.1)), ("L02 L04 L05", "LGPL-3.0-or-later", LGPL.format(":", ",", 3)),
    ("L01", "LGPL-2.1-or-later", LGPL.format(";", ";", 2.1).split("\n")[0]), ("L02", "LGPL-3.0-or-later", LGPL.format(":", ",", 3).split("\n")[0]),
    ("L03", "LGPL-3.0-or-later", LGPL.format(":", ",", 3).split("\n")[0].replace("This library", "This program")),
    ("F01 G04 F02", "AGPL-3.0-or-later", AGPL.format(":", ",", 3)), ("F01", "AGPL-3.0-or-later", AGPL.format(":", ",", 3).split("\n")[0]),
    ("I01 I04", "ISC", ISC.format("/or", NOTICE)), ("I02 I04", "ISC", ISC.format("", NOTICE)), ("I03 I04", "0BSD", ISC.format("/or", "")),
    ("I01", "ISC", ISC.format("/or", NOTICE).split("\n")[0]), ("I02", "ISC", ISC.format("", NOTICE).split("\n")[0]),
    ("I03", "0BSD", ISC.format("/or", "").split("\n")[0]),
    ("Z01 Z02 Z03", "Zlib", ZLIB), ("Z03", "Zlib", ZLIB[ZLIB.index("Permission"):]),
    ("X01", "BSL-1.0", BOOST), ("X02", "BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file.)"),
    ("K01", "CC0-1.0", CC0.format("Jane Doe", "Example Work, its parts and all their data")), ("K01", "CC0-1.0", CC0.format("the author", "this work")),
    ("K02", "CC0-1.0", "CC0 1.0 Universal"),
    ("M02", "MIT", "This project is licensed under the MIT License."), ("M01", "MIT", "This library is made available under the MIT License."),
    ("M02", "MIT", "This source code is licensed under the terms of the MIT license."),
    *((i, licenses.RULES[i], s.capitalize().replace("2 0", "2.0").replace(" version", ", version") + ".")
      for i, s in licenses.SENTENCES.items() if i[0] == "N"),
    *((f"S{n:02}", x, f"SPDX-License-Identifier: {x}") for n, x in enumerate(licenses.SPDX)),
    ("A02 A03 A04 A05 A06", "Apache-2.0", APACHE), ("A02 A03 A04", "Apache-2.0", APACHE[:APACHE.index("Unless")]),
    ("A02 A03", "Apache-2.0", APACHE[:APACHE.index("You may")]), ("A01", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("M03 M04 M05 M06", "MIT", MIT), ("M03 M04 M05", "MIT", MIT[:MIT.index("IN NO")]), ("M03 M04", "MIT", MIT[:MIT.index("THE SOFTWARE IS")]),
    ("M01", "MIT", "Released under the MIT License."), ("M02", "MIT", "Licensed under the MIT License."),
    ("G02 G04 G05", "GPL-3.0-or-later", GPL.format(":", ",", 3)), ("G03 G04 G05", "GPL-2.0-or-later", GPL.format(";", ";", 2)),
    ("G02", "GPL-3.0-or-later", GPL.format(";", ";", 3).split("\n")[0]), ("G03", "GPL-2.0-or-later", GPL.format(":", ",", 2).split("\n")[0]),
    ("G01", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("B01 B02 B03 B04", "BSD-3-Clause", BSD3.format("1. ", "2. ", "3. ")), ("B01 B02 B03", "BSD-2-Clause", BSD.format("(a) ", "(b) ")),
    ("B01 B02 B03 B04", "BSD-3-Clause", BSD3.format("* ", "* ", "* ")),
    *(("B01 B02 B03 B04", "BSD-3-Clause", BSD3.format("1. ", "2. ", "3. ").replace("the name of the copyright holder", name))
      for name in ("the name of the <organization>", "the name of Example Works, Inc.", "the names of the authors")),
    ("P01 P02", "MPL-2.0", MPL), ("P01", "MPL-2.0", MPL[:MPL.index(" If")]),
    ("C01", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("C02", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("C03", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("C04", "CC-BY-4.0", CC.format("")),
    ("C05", "CC-BY-SA-4.0", CC.format("-ShareAlike")), ("C06", "CC-BY-NC-4.0", CC.format("-NonCommercial")),
    ("U01", "Unlicense", "This is free and unencumbered software released into the public domain."),
    ("R01", "All-Rights-Reserved", "Copyright (c) 2020 A. Author. All rights reserved."),
]


def wrapped(text, width, start="", blank=""):
    return "\n".join(start + line if line else blank for p in text.split("\n") for line in (textwrap.wrap(p, width) or [""]))


FORMS = {
    "one line": lambda t: " ".join(t.split()),
    "wrapped": lambda t: wrapped(t, 70),
    "wrapped elsewhere": lambda t: wrapped(t, 47).replace("\n", "\r\n"),
    "block comment": lambda t: f"/*\n{wrapped(t, 60, ' * ', ' *')}\n */\nint main;",
    "line comment": lambda t: f"#!/bin/sh\n{wrapped(t, 66, '# ', '#')}\nexit 0",
    "batch comment": lambda t: wrapped(t, 66, "REM ", "REM"),
}


def test_every_rule_has_a_text():
    assert {r for r, _, _ in TEXTS} == set(licenses.RULES)
    assert all(licenses.RULES[r] == name for r, name, _ in TEXTS)
    assert {i for r, _, _ in TEXTS for i in r.split()} == set(licenses.SENTENCES)


@pytest.mark.parametrize("form", FORMS)
def test_standard_texts(spark, form):
    docs = spark.createDataFrame([(i, FORMS[form](t)) for i, (_, _, t) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: (" ".join(r.sentence_ids), r.licenses) for r in licenses.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [(rule, [name]) for rule, name, _ in TEXTS]


def test_parts_of_sentences_are_none(spark):
    rows = [(1, "It is not licensed under the MIT License."), (2, "Licensed under the MIT License and others."), (3, "the mit | license"),
            (4, "SPDX-License-Identifier: MIT OR Apache-2.0"), (5, "SPDX-License-Identifier: GPL-2.0+"),
            (6, "This project is not licensed under the MIT License."), (7, "To the extent possible under law, all is well.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.sentence_ids == [] for r in licenses.scan_licenses(docs).collect())
