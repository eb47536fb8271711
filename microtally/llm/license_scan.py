"""License scans by sentence rules, in DataFrame expressions only.

A text is cut into sentences twice: once with every line end as the end of a sentence, for notices
on a line of their own, and once with lines joined, for license texts that are wrapped. Normalised
sentences (letters a-z and digits, single blanks) that are known get the identifier of a license
sentence. What remains of a text is a sequence of identifiers, and the rules are matched against
it in their order: a rule is a license and the identifiers it consists of, and what it has matched
is taken out of the sequence, so that a shorter rule does not match a part of a longer license. Sentences
that name a license, titles, "licensed under ..." and the terms of an SPDX expression, count for themselves
where no rule has taken them.

Most texts name no license: a look for the words that every known sentence has decides that before
any sentence is cut.

Defined results
    null and empty texts, and texts without known sentences: no licenses, no sentences. Repeated
    sentences: each counts, each license is named once. Repeated rows: one row each. Empty table: no
    rows. The columns of the table are kept, whatever their names.
"""

import re

from pyspark.sql import functions as F

from microtally.llm.registry import query, read
from microtally.llm.text import whole

# Licenses by name, as normalised patterns: titles that may stand alone, and short forms that need
# a tag or a verb beside them. Versions are part of a name.
NAMES = (
    ("0BSD", r"(zero clause bsd|bsd zero clause|bsd 0 clause) license", r"0bsd|bsd 0 clause"),
    ("AGPL-3.0", r"gnu affero general public license( version)? v?3( 0)?", r"(gnu )?agpl v?3( 0)?|agplv3"),
    ("Apache-2.0", r"apache (software )?license( version)? v?2( 0)?", r"apache( version)? v?2( 0)?"),
    ("Artistic-2.0", r"artistic license( version)? v?2 0", r"artistic 2 0"),
    ("BSD-2-Clause", r"(bsd 2 clause|2 clause bsd|simplified bsd|bsd 2 clause simplified) license", r"bsd 2 clause|2 clause bsd|simplified bsd"),
    ("BSD-3-Clause", r"(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd|bsd 3 clause new or revised) license", r"bsd 3 clause|3 clause bsd|new bsd|modified bsd"),
    ("BSL-1.0", r"boost software license( version)? v?1 0", r"(boost|bsl) 1 0"),
    ("CC-BY-4.0", r"creative commons attribution 4 0( international)?( public)?( license)?", r"cc by 4 0( international)?( public)?( license)?"),
    ("CC-BY-NC-4.0", r"creative commons attribution non ?commercial 4 0( international)?( public)?( license)?", r"cc by nc 4 0( international)?( public)?( license)?"),
    ("CC-BY-SA-4.0", r"creative commons attribution share ?alike 4 0( international)?( public)?( license)?", r"cc by sa 4 0( international)?( public)?( license)?"),
    ("CC0-1.0", r"(cc0|creative commons (zero|cc0))( v?1 0)?( universal| license| public domain dedication)+", r"cc0( v?1 0)?"),
    ("EPL-1.0", r"eclipse public license( version)? v ?1 0|eclipse public license( version)? 1 0", r"epl v?1 0"),
    ("EPL-2.0", r"eclipse public license( version)? v ?2 0|eclipse public license( version)? 2 0", r"epl v?2 0"),
    ("GPL-2.0", r"gnu general public license( version)? v?2( 0)?", r"(gnu )?gpl( version)? v?2( 0)?|gplv2"),
    ("GPL-3.0", r"gnu general public license( version)? v?3( 0)?", r"(gnu )?gpl( version)? v?3( 0)?|gplv3"),
    ("ISC", r"isc license", r"isc"),
    ("LGPL-2.1", r"gnu lesser general public license( version)? v?2 1", r"(gnu )?lgpl( version)? v?2 1|lgplv2 1"),
    ("LGPL-3.0", r"gnu lesser general public license( version)? v?3( 0)?", r"(gnu )?lgpl( version)? v?3( 0)?|lgplv3"),
    ("MIT", r"(mit|expat) license", r"mit|expat"),
    ("MPL-2.0", r"mozilla public license( version)? v?2( 0)?", r"mpl v?2( 0)?|mplv2"),
    ("Unlicense", r"the unlicense", r"unlicense"),
    ("Zlib", r"zlib( libpng)? license", r"zlib"),
)

# Identifiers of other license sentences and what a normalised sentence must look like. Sentences
# stand as SENTENCE_END leaves them: "free software: you can ...", "Foundation; either version 2" and
# "v. 2.0" are cut in two.
SENTENCES = (
    ("apache2.comply", r"you may not use this file except in compliance with the license"),
    ("apache2.copy", r"you may obtain a copy of the license at.*"),
    ("apache2.asis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("mit.grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit.notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit.asis", r"the software is provided as is without warranty of any kind.*"),
    ("mit.liability", r"in no event shall the authors or copyright holders be liable for any claim.*"),
    ("bsd.grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("bsd.source", r"(1 )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd.binary", r"(2 )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd.endorse", r"(3 )?neither the name of .* may be used to endorse or promote products.* without specific prior written permission"),
    ("bsd.asis", r"this software is provided by the copyright holders? and contributors as is.*"),
    ("gpl3.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu general public license.* version 3.*"),
    ("gpl2.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu general public license.* version 2.*"),
    ("lgpl3.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu lesser general public license.* version 3.*"),
    ("lgpl21.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu lesser general public license.* version 2 1.*"),
    ("agpl3.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu affero general public license.* version 3.*"),
    ("gpl.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu general public license( as published by the free software foundation)?"),
    ("lgpl.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license( as published by the free software foundation)?"),
    ("agpl.grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu affero general public license( as published by the free software foundation)?"),
    ("gnu.version3", r"(either )?version 3 of the license.*"),
    ("gnu.version21", r"(either )?version 2 1 of the license.*"),
    ("gnu.version2", r"(either )?version 2 of the license.*"),
    ("gpl.warranty", r"this (program|library|file|software) is distributed in the hope that it will be useful but without any warranty.*"),
    ("gpl.title", r"gnu general public license"),
    ("lgpl.title", r"gnu lesser general public license"),
    ("agpl.title", r"gnu affero general public license"),
    ("gnu.copying", r"everyone is permitted to copy and distribute verbatim copies of this license document.*"),
    ("gnu.june2007", r"version 3 29 june 2007"),
    ("gnu.november2007", r"version 3 19 november 2007"),
    ("gnu.february1999", r"version 2 1 february 1999"),
    ("gnu.june1991", r"version 2 june 1991"),
    ("mpl2.name", r"this source code form is subject to the terms of the mozilla public license v( 2 0)?"),
    ("isc.grant", r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib.grant", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely.*"),
    ("cc0.waiver", r"to the extent possible under law .* waived all copyright and related or neighbou?ring rights.*"),
    ("unlicense.grant", r"this is free and unencumbered software released into the public domain"),
)

# Licenses by the sequence of their sentences, longer sequences first; a question mark
# ends a sentence that may be missing. After them every name that is left counts for itself.
RULES = (
    ("MIT", "name.MIT? mit.grant mit.notice mit.asis mit.liability?"),
    ("BSD-3-Clause", "name.BSD-3-Clause? bsd.grant bsd.source bsd.binary bsd.endorse bsd.asis?"),
    ("BSD-2-Clause", "name.BSD-2-Clause? bsd.grant bsd.source bsd.binary bsd.asis?"),
    ("Apache-2.0", "name.Apache-2.0 apache2.comply? apache2.copy? apache2.asis?"),
    ("GPL-3.0", "gpl.grant gnu.version3 gpl.warranty?"),
    ("GPL-2.0", "gpl.grant gnu.version2 gpl.warranty?"),
    ("LGPL-3.0", "lgpl.grant gnu.version3 gpl.warranty?"),
    ("LGPL-2.1", "lgpl.grant gnu.version21 gpl.warranty?"),
    ("LGPL-2.0", "lgpl.grant gnu.version2 gpl.warranty?"),
    ("AGPL-3.0", "agpl.grant gnu.version3 gpl.warranty?"),
    ("GPL-3.0", "gpl3.grant gpl.warranty?"),
    ("GPL-2.0", "gpl2.grant gpl.warranty?"),
    ("LGPL-3.0", "lgpl3.grant gpl.warranty?"),
    ("LGPL-2.1", "lgpl21.grant gpl.warranty?"),
    ("AGPL-3.0", "agpl3.grant gpl.warranty?"),
    ("GPL-3.0", "gpl.title gnu.june2007 gnu.copying?"),
    ("GPL-2.0", "gpl.title gnu.june1991 gnu.copying?"),
    ("LGPL-3.0", "lgpl.title gnu.june2007 gnu.copying?"),
    ("LGPL-2.1", "lgpl.title gnu.february1999 gnu.copying?"),
    ("AGPL-3.0", "agpl.title gnu.november2007 gnu.copying?"),
    ("ISC", "isc.grant"),
    ("MPL-2.0", "mpl2.name"),
    ("Zlib", "zlib.grant"),
    ("CC0-1.0", "cc0.waiver"),
    ("Unlicense", "unlicense.grant"),
)

# How a name is used: what may stand before a title or a short form, what may follow, and the tag that TAG leaves.
VERB = r"(.* )?(licensed|released|distributed|available|provided|published|offered) under( the (terms|conditions) of)?( the| a| an)?"
AFTER = r"( only| or later| or( at your option)? any later version)?( the license)?( see .*| which .*| for details)?"
TAG_MARK = "license tag"


def _named(title, short):
    """The pattern of sentences that name a license."""
    return (rf"((the )?({title})|{VERB} ({title}|{short})( license)?|{TAG_MARK} (the )?({title}|{short})|"
            rf"(.* (is|are) )?({short}) licensed){AFTER}")


KNOWN = tuple((f"name.{license}", _named(title, short)) for license, title, short in NAMES) + SENTENCES

# Every known sentence has one of these, in any case of letters.
HINT = (r"(?i)licen[sc]e|unencumbered|permission|redistribut|warranty|copyright|cc[^a-z0-9]+by|cc0|creative[^a-z0-9]+commons|"
        r"version[^a-z0-9]+[23]|(released|distributed|available|provided|published|offered)[^a-z0-9]+under")
# A point between digits, as in version numbers, ends no sentence: an end is followed by white space.
SENTENCE_END = r"([.!?;:])[\x20\x09-\x0D]+"
EMPTY_LINE = r"\n[\x20\x09-\x0D]*\n"
# Tags before a license name, anywhere or at the start of a line; without their colon they are no end of a sentence.
# The expression behind a tag is cut at its operators.
TAG = r"(?i)(SPDX-License-Identifier|(^|\n)[^A-Za-z0-9\n]*licen[sc]e)[\x20\x09]*:[\x20\x09]*"
OPERATOR = r"[\x20\x09()]+(OR|AND|WITH)[\x20\x09()]+"


# A name that no rule has taken out of a sequence.
LONE_NAME = r" name\.([^ ]+)"


def _pattern(rule):
    """A rule as a pattern over identifiers that each stand between blanks."""
    out = ""
    for step in rule.split(" "):
        name = re.escape(step.rstrip("?")) + " "
        out += f"(?:{name})?" if step.endswith("?") else name
    return " " + out


def _identifier(sentence):
    """The identifier of a sentence, or null."""
    plain = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    found = None
    for name, pattern in KNOWN:
        hit = plain.rlike(f"^(?:{pattern})$")
        found = F.when(hit, F.lit(name)) if found is None else found.when(hit, F.lit(name))
    return F.when(sentence.rlike(HINT), found)


def _sequence(text):
    """Identifiers of the known sentences of a text in order, as a string of them between blanks."""
    tagged = F.regexp_replace(text, TAG, f"\n{TAG_MARK} ")
    sentences = F.split(F.regexp_replace(tagged, SENTENCE_END, "$1\n"), "\n", -1)
    cut = F.transform(sentences, lambda each: F.when(
        each.startswith(TAG_MARK), F.split(F.regexp_replace(each, OPERATOR, f"\n{TAG_MARK} "), "\n", -1)).otherwise(F.array(each)))
    known = F.array_compact(F.transform(F.flatten(cut), _identifier))
    return F.concat(F.lit(" "), F.transform(F.array(F.array_join(known, "  ")), lambda ids: F.concat(ids, F.lit(" ")))[0])


def _matched(sequence):
    """Licenses whose rules match, in the order of the rules."""
    licenses = []
    for name, rule in RULES:
        pattern = _pattern(rule).replace(" ", " +")
        licenses.append(F.when(sequence.rlike(pattern), F.lit(name)))
        sequence = F.regexp_replace(sequence, pattern, " ")
    return F.concat(F.array_compact(F.array(*licenses)), F.regexp_extract_all(sequence, F.lit(LONE_NAME), F.lit(1)))


def scan_licenses(docs, text="text", into="license"):
    """The rows of ``docs`` with a struct ``into``: ``names``, the licenses in alphabetical order, and ``sentences``,
    the identifiers found on lines of their own, then those found in wrapped text."""
    body = whole(F.col(text))
    hinted = body.rlike(HINT)
    wrapped = F.replace(F.regexp_replace(body, EMPTY_LINE, ".\x1e"), F.lit("\n"), F.lit(" "))
    wrapped = F.replace(wrapped, F.lit("\x1e"), F.lit("\n"))
    df = docs.select(*[F.col(f"`{name}`") for name in docs.columns],
                     F.when(hinted, _sequence(body)).alias("l$lines"), F.when(hinted, _sequence(wrapped)).alias("l$wrapped"))
    none = F.array().cast("array<string>")
    names = F.array_sort(F.array_distinct(F.concat(
        F.coalesce(_matched(F.col("l$lines")), none), F.coalesce(_matched(F.col("l$wrapped")), none))))
    found = F.struct(names.alias("names"), F.coalesce(F.trim(F.regexp_replace("l$lines", " +", " ")), F.lit("")).alias("lines"),
                     F.coalesce(F.trim(F.regexp_replace("l$wrapped", " +", " ")), F.lit("")).alias("wrapped"))
    return df.select(*[F.col(f"`{name}`") for name in docs.columns], found.alias(into))


def _sql():
    """The same as one DuckDB statement, from the same tables of sentences and rules."""
    cases = " ".join(f"WHEN regexp_full_match(plain, '{pattern}') THEN '{name}'" for name, pattern in KNOWN)
    steps, previous = [], "sequences"
    for number, (name, rule) in enumerate(RULES):
        pattern = _pattern(rule).replace(" ", " +")
        steps.append(f"rule{number} AS MATERIALIZED (SELECT doc_id, row_id, way, ids, CASE WHEN regexp_matches(rest, '{pattern}') THEN list_append(names, '{name}') ELSE names END AS names, "
                     f"regexp_replace(rest, '{pattern}', ' ', 'g') AS rest FROM {previous})")
        previous = f"rule{number}"
    return f"""
WITH base AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS body FROM documents),
ways AS (
    SELECT row_id, doc_id, 'lines' AS way, body FROM base
    UNION ALL
    SELECT row_id, doc_id, 'wrapped', replace(replace(regexp_replace(body, '\\n[\\x20\\x09-\\x0D]*\\n', '.' || chr(30), 'g'), chr(10), ' '), chr(30), chr(10)) FROM base
), sentences AS (
    SELECT row_id, way, place, trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g')) AS plain
    FROM (SELECT row_id, way, unnest(list) AS sentence, generate_subscripts(list, 1) AS place FROM (
        SELECT row_id, way, flatten(list_transform(
            string_split(regexp_replace(regexp_replace(body, '{TAG}', chr(10) || '{TAG_MARK} ', 'g'), '([.!?;:])[\\x20\\x09-\\x0D]+', '\\1' || chr(10), 'g'), chr(10)),
            lambda each: CASE WHEN starts_with(each, '{TAG_MARK}') THEN string_split(regexp_replace(each, '{OPERATOR}', chr(10) || '{TAG_MARK} ', 'g'), chr(10)) ELSE [each] END)) AS list FROM ways
        WHERE regexp_matches(body, '{HINT}')))
), known AS (
    SELECT row_id, way, place, CASE {cases} END AS id FROM sentences
), joined AS (
    SELECT row_id, way, string_agg(id, ' ' ORDER BY place) AS ids FROM known WHERE id IS NOT NULL GROUP BY row_id, way
), sequences AS MATERIALIZED (
    SELECT w.doc_id, w.row_id, w.way, coalesce(j.ids, '') AS ids, CAST([] AS VARCHAR[]) AS names, ' ' || replace(coalesce(j.ids, ''), ' ', '  ') || ' ' AS rest
    FROM ways w LEFT JOIN joined j USING (row_id, way)
), {', '.join(steps)}
SELECT any_value(doc_id) AS doc_id, array_to_string(list_sort(list_distinct(flatten(list(list_concat(names, regexp_extract_all(rest, '{LONE_NAME}', 1)))))), ',') AS licenses,
       coalesce(max(ids) FILTER (WHERE way = 'lines'), '') AS sentences
FROM {previous} GROUP BY row_id
"""


@query("op9_license_scan", _sql())
def op9_license_scan(spark, sf_dir):
    """All documents with the licenses they name and the license sentences on lines of their own."""
    found = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("license.names", ",").alias("licenses"), F.col("license.lines").alias("sentences"))
