import time

import pytest

from larkspur.llm import licences
from tests.llm.frames import LONG, documents

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list.
2. Redistributions in binary form must reproduce the above copyright notice, too.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""
CASES = [
    (MIT, ["MIT"]), (BSD, ["BSD-2-Clause"]), (BSD + "3. Neither the name of X may be used to endorse or promote products.", ["BSD-3-Clause"]),
    (GPL, ["GPL-3.0-or-later"]), ("Released under the MIT License.", ["MIT"]), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("text before.\nThis work is licensed under the GNU General Public License, version 3.\nafter", ["GPL-3.0"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]), ("// SPDX-License-Identifier: BSD-3-Clause\nint x;", ["bsd-3-clause"]),
    ("no full stop before\nReleased under the MIT Licence\nnone after", ["MIT"]), ("We asked for permission to visit.", []),
    (MIT + "\n" + BSD, ["MIT", "BSD-2-Clause"]), ("", []), (None, []), (LONG + "\nAll rights reserved.", ["All-Rights-Reserved"]),
    ("Licensed under the Blue Oak Model License 1.0.", ["Other: blue oak model license 1.0"]),
]


def test_licences(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(None, MIT), (4, "Released under the MIT License.")]
    got = licences.scan(documents(spark, rows)).collect()
    for row, (text, want) in zip(got, CASES):
        assert [x["licence"] for x in row["_licences"]] == want, text
    assert [x["licence"] for x in got[-2]["_licences"]] == ["MIT"] and licences.scan(documents(spark, [])).collect() == []


def test_spans_are_the_sentences(spark):
    text = "é intro.\nReleased under the MIT License. More text."
    row = licences.scan(documents(spark, [(1, text)])).collect()[0]
    span = row["_licences"][0]
    assert text[span["start"]:span["end"]] == "Released under the MIT License."


HEADER = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


@pytest.mark.parametrize("text,want", [
    (HEADER,["GPL-2.0-or-later"]),
    (HEADER.replace("GNU General","GNU Lesser General"),["LGPL-2.0-or-later"]),
    (HEADER.replace("General Public","Affero General Public").replace("version 2","version 3"),["AGPL-3.0-or-later"]),
("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",["MPL-2.0"]),
("Licensed under the MIT license, see LICENSE",["MIT"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.",["EPL-1.0"]),
("All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",["All-Rights-Reserved","EPL-2.0"]),
("Licensed under the MIT license or the Apache License, Version 2.0",["MIT","Apache-2.0"]),
    ("This code is not licensed under the MIT license.",[]),
("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",["0BSD"]),
("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",["ISC"]),
("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",["Zlib"]),
("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)",["BSL-1.0"]),
("Licensed under the Artistic License 2.0.",["Artistic-2.0"])])
def test_published_headers(text, want):
    assert [x[0] for x in licences.licences([k[2] for k in licences.sentences(text)])] == want


@pytest.mark.parametrize("identifiers,want", [
    (["bsd-grant", "copyright", "bsd-source", "bsd-binary"], ["BSD-2-Clause"]), (["bsd-source", "bsd-grant", "bsd-binary"], []),
    (["mit-grant", "mit-notice", "mit-grant", "mit-notice", "as-is"], ["MIT", "MIT"]), ([], [])])
def test_rules_need_the_order(identifiers, want):
    assert [x[0] for x in licences.licences(identifiers)] == want


LINE = "words without any stop " * 400


@pytest.mark.parametrize("text,licence,identifier", [
    ("This document is proprietary and confidential.", "Proprietary", "proprietary"), ("Creative Commons Zero", "CC0-1.0", "cc0"),
    ("CC0", "CC0-1.0", "cc0"), ("(c) 2020 Acme", None, "copyright"), ("© 2021 Acme", None, "copyright"), ("Released under GPL v3", "GPL-3.0", "gpl==3="),
    ("Released under the 3-clause BSD.", "BSD-3-Clause", "bsd-name=3"), ("# All rights\n# reserved.", "All-Rights-Reserved", "all-rights-reserved"),
    (LINE + "licensed under the MIT License", "MIT", "mit-name"), (LINE + "proprietary and confidential " + LINE, "Proprietary", "proprietary")])
def test_texts_with_a_single_sentence_of_any_length(spark, text, licence, identifier):
    row = licences.scan(documents(spark, [(1, text)])).collect()[0]
    assert [x["licence"] for x in row["_licences"]] == ([licence] if licence else [])
    assert [x["identifier"] for x in row["_sentences"]] == [identifier]


def test_long_sentences_take_linear_time():
    start = time.time()
    for text in (" ", "/", "copyright ", "under the ", "license, ", "x\n*\n", "licensed under a", "licensed under a or b "):
        licences.sentences("license " + text * 100_000 + "x")
    assert time.time() - start < 30
