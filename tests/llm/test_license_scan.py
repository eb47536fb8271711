import pytest

from microtally.llm import license_scan, operators  # noqa: F401
from microtally.llm.registry import ORACLES, QUERIES
from tests.llm.cases import SF_DIR, awkward, clashing, same_as_sql, tables
from workload.check import compare, connect

MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY."""
HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list.

2. Redistributions in binary form must reproduce the above copyright notice.
"""
BSD3 = HEAD + "\n3. Neither the name of X nor the names of others may be used to endorse or promote products without specific prior written permission.\n"
TEXTS = [
    ("Some prose.\nReleased under the MIT License.\nMore prose.", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "GPL-3.0"]),
    (MIT, ["MIT"]), (HEAD, ["BSD-2-Clause"]), (BSD3, ["BSD-3-Clause"]), (MIT + "\n\n" + BSD3, ["BSD-3-Clause", "MIT"]),
    ("Released under the MIT License. Released under the MIT License.", ["MIT"]),
    ("He had a license to fish.", []), ("Permission is hereby granted, free of charge.", []), ("", []), (None, []),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", []),
]


def test_licenses_of_texts(spark):
    docs = clashing(awkward(spark, [(n, text, None, None, None) for n, (text, _) in enumerate(TEXTS)]))
    found = license_scan.scan_licenses(docs, into="l")
    assert found.columns == [*docs.columns, "l"]
    assert {row.doc_id: row.l.names for row in found.collect()} == {n: names for n, (_, names) in enumerate(TEXTS)}


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF_DIR), QUERIES["op9_license_scan"], ORACLES["op9_license_scan"], SF_DIR) is None


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows_agree_with_sql(spark, tmp_path, extra):
    rows = [(n, text, None, None, None) for n, (text, _) in enumerate(TEXTS)]
    docs = awkward(spark, rows) if extra else awkward(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(QUERIES["op9_license_scan"](spark, str(tmp_path)), tables({"documents": docs}), ORACLES["op9_license_scan"])


def test_every_known_sentence_has_a_hint():
    import re

    for name, pattern in license_scan.SENTENCES:
        shape = re.sub(r"\([^()]*\)\?", "", pattern).replace(" ", "-")
        assert re.search(license_scan.HINT, shape.split("(")[0] + shape), name


def test_empty_table(spark):
    assert license_scan.scan_licenses(awkward(spark, [])).count() == 0


GNU = """{what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind} Public License as published by
the Free Software Foundation{either} version {version} of the License, or
(at your option) any later version.

{what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind} Public License for more details.
"""
NOTICES = [
    (GNU.format(what="This program", mark=":", either=", either", kind="General", version="3"), "GPL-3.0"),
    (GNU.format(what="This program", mark=";", either="; either", kind="General", version="2"), "GPL-2.0"),
    (GNU.format(what="This program", mark=";", either="; either", kind="General", version="3"), "GPL-3.0"),
    (GNU.format(what="This program", mark=":", either=", either", kind="General", version="2"), "GPL-2.0"),
    (GNU.format(what="This library", mark=":", either=", either", kind="Lesser General", version="3"), "LGPL-3.0"),
    (GNU.format(what="This library", mark=";", either="; either", kind="Lesser General", version="2.1"), "LGPL-2.1"),
    (GNU.format(what="This library", mark=";", either="; either", kind="Library General", version="2"), "LGPL-2.0"),
    (GNU.format(what="This program", mark=":", either=", either", kind="Affero General", version="3"), "AGPL-3.0"),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "MPL-2.0"),
    ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", "ISC"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("This code is licensed under the MIT License.", "MIT"),
    ("The data set is released under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
]


def test_published_notices(spark):
    docs = awkward(spark, [(n, text, None, None, None) for n, (text, _) in enumerate(NOTICES)])
    found = {row.doc_id: row.license.names for row in license_scan.scan_licenses(docs).collect()}
    assert found == {n: [name] for n, (_, name) in enumerate(NOTICES)}


def test_published_notices_agree_with_sql(spark, tmp_path):
    commented = [("# " + text.replace("\n", "\n# "), name) for text, name in NOTICES]
    docs = awkward(spark, [(n, text, None, None, None) for n, (text, _) in enumerate(NOTICES + commented)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(QUERIES["op9_license_scan"](spark, str(tmp_path)), tables({"documents": docs}), ORACLES["op9_license_scan"])


# Names, titles and tags as they stand in files, and the licenses a reader sees in them.
TITLES = [
    ("SPDX-License-Identifier: MIT", ["MIT"]), ("// SPDX-License-Identifier: GPL-2.0-or-later\nint main() {}", ["GPL-2.0"]),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause */", ["Apache-2.0", "BSD-3-Clause", "MIT"]),
    ("# SPDX-License-Identifier: GPL-3.0-only WITH Classpath-exception-2.0", ["GPL-3.0"]),
    ("Code first. SPDX-License-Identifier:\tZlib", ["Zlib"]), ("SPDX-License-Identifier: LicenseRef-Own", []),
    ("MIT License\n\nCopyright (c) 2020 A", ["MIT"]), ("The MIT License (see below)", ["MIT"]),
    ("Apache License, Version 2.0", ["Apache-2.0"]), ("Released under the MIT License (see LICENSE).", ["MIT"]),
    ("This project is MIT licensed.", ["MIT"]), ("License: BSD-2-Clause", ["BSD-2-Clause"]), ("CC0 1.0 Universal", ["CC0-1.0"]),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", ["BSL-1.0"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is at https://www.eclipse.org/legal/epl-2.0/", ["EPL-2.0"]),
    ("The library is distributed under the zlib license.", ["Zlib"]), ("Released under MIT.", ["MIT"]),
    ("Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:", ["Zlib"]),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ["CC0-1.0"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", ["GPL-3.0"]),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", ["LGPL-2.1"]),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", ["AGPL-3.0"]),
    ("MIT License\n\n" + MIT, ["MIT"]), ("You may use it under the GPL-3.0 or later.", []),
    ("Licensed under the GPLv3 or later.", ["GPL-3.0"]), ("Licensed under the Mozilla Public License 2.0.", ["MPL-2.0"]),
    ("She studied at MIT.\nMIT", []), ("A driving licence: valid for a year.", []), ("The exhibition is licensed under a city permit.", []),
    ("GNU General Public License", []), ("Version 3, 29 June 2007", []), ("Apache helicopters, version 2.0", []),
    ("The mit licensed driver", []),
]


def test_titles_tags_and_names(spark):
    docs = awkward(spark, [(n, text, None, None, None) for n, (text, _) in enumerate(TITLES)])
    found = {row.doc_id: row.license.names for row in license_scan.scan_licenses(docs).collect()}
    assert found == {n: names for n, (_, names) in enumerate(TITLES)}


def test_titles_agree_with_sql(spark, tmp_path):
    docs = awkward(spark, [(n, text, None, None, None) for n, (text, _) in enumerate(TITLES)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(QUERIES["op9_license_scan"](spark, str(tmp_path)), tables({"documents": docs}), ORACLES["op9_license_scan"])
