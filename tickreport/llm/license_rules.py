"""Licence scans by sentence rules.

A text is split into sentences, each sentence is normalised and looked up in a
table of known licence sentences, and the sequence of identifiers is matched
against ordered rules: a rule that matches turns its run of identifiers into the
rule's licence, so that later (more general) rules can't use them again.

A sentence that isn't known is tried line by line, since headings and notices
often lack a full stop.  Unknown sentences end a run.  Known sentences that the
splitter cuts (at ':', ';' or 'v.') are put together again from their parts.  Names
and the like inside a known sentence are slots (``SLOTS``).  Bare list numbers and
copyright lines between known sentences don't end a run, and neither does "all
rights reserved".  Everything is a column expression: no shuffle, no Python, and
work in proportion to the text; sentences are looked up only in texts that hold
one of ``ANCHORS``, without one of which no sentence is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, fresh, table

# Known sentences in normal form (lower case, runs of anything but
# letters, digits, '.' and '+' as one blank, full stops at the end dropped).
SENTENCES: list[tuple[str, str]] = [
    ("MIT_NAME", "mit license"),
    ("MIT_NAME", "the mit license"),
    ("MIT_NAME", "the mit license mit"),
    ("MIT_REL", "released under the mit license"),
    ("MIT_REL", "licensed under the mit license"),
    ("MIT_REL", "this project is licensed under the mit license"),
    ("MIT_REL", "this software is released under the mit license"),
    ("MIT_REL", "distributed under the mit license"),
    ("MIT_GRANT", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
                  " associated documentation files the software to deal in the software without restriction including"
                  " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
                  " copies of the software and to permit persons to whom the software is furnished to do so subject to"
                  " the following conditions"),
    ("MIT_NOTICE", "the above copyright notice and this permission notice shall be included in all copies or"
                   " substantial portions of the software"),
    ("AS_IS_MIT", "the software is provided as is without warranty of any kind express or implied including but not"
                  " limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("ISC_GRANT", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
                  " hereby granted provided that the above copyright notice and this permission notice appear in all"
                  " copies"),
    ("BSD_GRANT", "redistribution and use in source and binary forms with or without modification are permitted provided"
                  " that the following conditions are met"),
    ("BSD_SOURCE", "redistributions of source code must retain the above copyright notice this list of conditions and"
                   " the following disclaimer"),
    ("BSD_BINARY", "redistributions in binary form must reproduce the above copyright notice this list of conditions and"
                   " the following disclaimer in the documentation and or other materials provided with the"
                   " distribution"),
    ("BSD_NAMES", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
                  " promote products derived from this software without specific prior written permission"),
    ("APACHE2_REF", "licensed under the apache license version 2.0"),
    ("APACHE2_REF", "licensed under the apache license version 2.0 the license"),
    ("APACHE2_REF", "licensed under the apache license 2.0"),
    ("APACHE2_NAME", "apache license"),
    ("APACHE2_VERSION", "version 2.0 january 2004"),
    ("APACHE_COMPLIANCE", "you may not use this file except in compliance with the license"),
    ("APACHE_COPY", "you may obtain a copy of the license at"),
    ("APACHE_AS_IS", "unless required by applicable law or agreed to in writing software distributed under the license is"
                     " distributed on an as is basis without warranties or conditions of any kind either express or"
                     " implied"),
    ("GPL3_REF", "this work is licensed under the gnu general public license version 3"),
    ("GPL3_REF", "licensed under the gnu general public license version 3"),
    ("GPL3_REF", "licensed under the gnu general public license v3.0"),
    ("GPL3_REF", "licensed under the gpl version 3"),
    ("GPL2_REF", "this work is licensed under the gnu general public license version 2"),
    ("GPL2_REF", "licensed under the gnu general public license version 2"),
    ("GPL2_REF", "licensed under the gpl version 2"),
    ("GPL3_PLUS", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                  " general public license as published by the free software foundation either version 3 of the license"
                  " or at your option any later version"),
    ("GPL2_PLUS", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                  " general public license as published by the free software foundation either version 2 of the license"
                  " or at your option any later version"),
    ("LGPL_PLUS", "this library is free software you can redistribute it and or modify it under the terms of the gnu"
                  " lesser general public license as published by the free software foundation either version 2.1 of the"
                  " license or at your option any later version"),
    ("GPL_USEFUL", "this program is distributed in the hope that it will be useful but without any warranty without even"
                   " the implied warranty of merchantability or fitness for a particular purpose"),
    ("GPL_DETAILS", "see the gnu general public license for more details"),
    ("MPL2_REF", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("CC_BY_NC4", "licensed under cc by nc 4.0"),
    ("CC_BY_NC4", "this work is licensed under cc by nc 4.0"),
    ("CC_BY_NC4", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("CC_BY_SA4", "licensed under cc by sa 4.0"),
    ("CC_BY_SA4", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("CC_BY4", "licensed under cc by 4.0"),
    ("CC_BY4", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("CC0", "licensed under cc0 1.0"),
    ("BSD_ADVERT", "all advertising materials mentioning features or use of this software must display the following"
                   " acknowledgement"),
    ("BSD_ACK", "this product includes software developed by the organization"),
    ("AGPL_DETAILS", "see the gnu affero general public license for more details"),
    ("LGPL_DETAILS", "see the gnu lesser general public license for more details"),
    ("GPL3_REF", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                 " general public license version 3 as published by the free software foundation"),
    ("GPL2_REF", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                 " general public license version 2 as published by the free software foundation"),
    ("GPL2_REF", "released under the gnu general public license version 2"),
    ("GPL3_REF", "released under the gnu general public license version 3"),
    ("AGPL3_REF", "licensed under the gnu affero general public license version 3"),
    ("LGPL3_REF", "licensed under the gnu lesser general public license version 3"),
    ("APACHE2_REF", "released under the apache license version 2.0"),
    ("BSD3_REF", "licensed under the bsd 3 clause license"),
    ("BSD2_REF", "licensed under the bsd 2 clause license"),
    ("ISC_REF", "licensed under the isc license"),
    ("MPL2_REF", "licensed under the mozilla public license version 2.0"),
    ("UNLICENSE", "this is free and unencumbered software released into the public domain"),
    ("ZLIB_GRANT", "permission is granted to anyone to use this software for any purpose including commercial applications"
                   " and to alter it and redistribute it freely subject to the following restrictions"),
    ("0BSD_GRANT", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
                   " hereby granted"),
    ("RIGHTS", "all rights reserved"),
]

# SPDX identifiers and their normal form after "SPDX-License-Identifier:".
SPDX = ["MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "Apache-2.0", "MPL-2.0", "Zlib", "Unlicense",
        "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0"]

# Known sentences as the splitter cuts them, in normal form.
_CLAUSE3 = "endorse or promote products derived from this software without specific prior written permission"
_FSF = "you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
_OR_LATER = [("GPL2_PLUS", "program", "general public license", "2"), ("GPL3_PLUS", "program", "general public license", "3"),
             ("LGPL_PLUS", "library", "lesser general public license", "2.1"),
             ("LGPL3_PLUS", "library", "lesser general public license", "3"),
             ("LGPL3_PLUS", "program", "lesser general public license", "3"),
             ("AGPL3_PLUS", "program", "affero general public license", "3")]
PARTED: list[tuple[str, list[str]]] = [
    *[(name, [f"this {what} is free software", *rest]) for name, what, licence, v in _OR_LATER for rest in (
        [f"{_FSF.format(licence)} {_LATER.format(v)}"], [_FSF.format(licence), _LATER.format(v)])],
    *[(f"GPL{v}_REF", ["this program is free software",
                       "you can redistribute it and or modify it under the terms of the gnu general public license version"
                       f" {v} as published by the free software foundation"]) for v in (2, 3)],
    ("BSD_NAMES", ["neither the name of", f"nor the names of its contributors may be used to {_CLAUSE3}"]),
    *[(f"SPDX_{x}", ["spdx license identifier", x.lower().replace("-", " ")]) for x in SPDX],
    ("GPL_USEFUL", ["this program is distributed in the hope that it will be useful but without any warranty",
                    "without even the implied warranty of merchantability or fitness for a particular purpose"]),
    ("MPL2_REF", ["this source code form is subject to the terms of the mozilla public license v", "2.0"]),
]

# Slots as (pattern of a normal sentence, known sentence).  Both forms of
# the third BSD clause forbid the use of names; who is named does not matter.
SLOTS: list[tuple[str, str]] = [
    (f"^(?:neither the names? of .* nor the names? of .*|the names? of .*)may (?:not )?be used to {_CLAUSE3}$",
     f"neither the name of the copyright holder nor the names of its contributors may be used to {_CLAUSE3}"),
    # A name with a full stop ("... Inc. nor ...") is cut in two by the splitter.
    ("^neither the names? of( [^ ]+){1,7}$", "neither the name of"),
    (f"^nor the names? of .* may be used to {_CLAUSE3}$", f"nor the names of its contributors may be used to {_CLAUSE3}"),
    ("^this product includes software developed by .*$", "this product includes software developed by the organization"),
]

#: One of these is in every known sentence (and in a first part of every parted one), in lower case.
ANCHORS = ["license", "permission", "redistribut", "copyright", "warranty", "reserved", "advertising", "this product includes",
           "free software", "unencumbered", "spdx", "version 2.0 january 2004", "under cc", "apache"]
_RIGHTS = "<RIGHTS>"
_COPYRIGHT = "^[^a-z0-9]*(?:copyright[^a-z]|[(]c[)] *[0-9])[^\\n]{0,200}$"
_NOTICES = "^(?:[^\\n]*[Cc]opyright[^\\n]*\\n)+"

# Fixed values: (licence, run of identifiers), tried in this order.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["MIT_NAME", "MIT_GRANT", "MIT_NOTICE", "AS_IS_MIT"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE", "AS_IS_MIT"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE"]),
    ("BSD-4-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ADVERT", "BSD_ACK", "BSD_NAMES"]),
    ("BSD-3-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES"]),
    ("BSD-2-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY"]),
    ("Apache-2.0", ["APACHE2_REF", "APACHE_COMPLIANCE", "APACHE_COPY", "APACHE_AS_IS"]),
    ("Apache-2.0", ["APACHE2_REF", "APACHE_COMPLIANCE"]),
    ("Apache-2.0", ["APACHE2_NAME", "APACHE2_VERSION"]),
    ("GPL-3.0-or-later", ["GPL3_PLUS", "GPL_USEFUL", "GPL_DETAILS"]),
    ("GPL-2.0-or-later", ["GPL2_PLUS", "GPL_USEFUL", "GPL_DETAILS"]),
    ("GPL-3.0-or-later", ["GPL3_PLUS"]),
    ("GPL-2.0-or-later", ["GPL2_PLUS"]),
    ("LGPL-2.1-or-later", ["LGPL_PLUS"]),
    ("Apache-2.0", ["APACHE2_REF"]),
    ("GPL-3.0-only", ["GPL3_REF"]),
    ("GPL-2.0-only", ["GPL2_REF"]),
    ("MPL-2.0", ["MPL2_REF"]),
    ("ISC", ["ISC_GRANT"]),
    ("CC-BY-NC-4.0", ["CC_BY_NC4"]),
    ("CC-BY-SA-4.0", ["CC_BY_SA4"]),
    ("CC-BY-4.0", ["CC_BY4"]),
    ("CC0-1.0", ["CC0"]),
    ("MIT", ["MIT_REL"]),
    ("MIT", ["MIT_NAME"]),
    ("AGPL-3.0-or-later", ["AGPL3_PLUS"]),
    ("LGPL-3.0-or-later", ["LGPL3_PLUS"]),
    ("AGPL-3.0-only", ["AGPL3_REF"]),
    ("LGPL-3.0-only", ["LGPL3_REF"]),
    ("BSD-3-Clause", ["BSD3_REF"]),
    ("BSD-2-Clause", ["BSD2_REF"]),
    ("ISC", ["ISC_REF"]),
    ("Unlicense", ["UNLICENSE"]),
    ("Zlib", ["ZLIB_GRANT"]),
    ("0BSD", ["0BSD_GRANT"]),
    *[(x, [f"SPDX_{x}"]) for x in SPDX],
]

#: A sentence ends at . ! ? : or ; before white space or the end, and at an empty line.
_SPLIT = r"[.!?:;]+(?:[\x20\x09-\x0D]+|$)|\n[\x20\x09\x0D]*\n"
_JUNK = r"[^a-z0-9.+]+"
#: What the splitter leaves of a list number ('1.', '(2).', 'a.').
_NUMBER = r"^[^A-Za-z0-9]*(?:[0-9]{1,2}|[A-Za-z])[^A-Za-z0-9]*$"


def normal(sentence: Column) -> Column:
    words = F.btrim(F.regexp_replace(F.lower(sentence), _JUNK, " "), F.lit(" "))
    return F.regexp_replace(words, r"[. ]+$", "")


def filled(sentence: Column) -> Column:
    """A normal sentence with its slots as the table has them."""
    for pattern, known in SLOTS:
        sentence = F.regexp_replace(sentence, pattern, known)
    return sentence


def _marks(sentences: list[tuple[str, str]], parted: list[tuple[str, list[str]]]) -> dict[str, str]:
    """Normal sentence -> its mark: <ID>, or {n} for what is only a part."""
    marks = {x: f"<{i}>" for i, x in reversed(sentences)}  # the first of two equal sentences counts
    for part in sorted({x for _, parts in parted for x in parts} - set(marks)):
        marks[part] = "{%d}" % len(marks)
    return marks


def _runs(sentences: list[tuple[str, str]], parted: list[tuple[str, list[str]]]) -> list[tuple[str, str]]:
    """(marks of the parts, mark of the sentence), longest first."""
    marks = _marks(sentences, parted)
    return [("".join(marks[x] for x in run), f"<{name}>") for name, run in sorted(parted, key=lambda p: -len(p[1]))]


def _lookup(sentence: Column, sentences: list[tuple[str, str]]) -> Column:
    """The identifier of a normal sentence, null if it isn't known."""
    found = F.lit(None).cast("string")
    ids = list(dict.fromkeys(i for i, _ in sentences))
    for name in reversed(ids):
        found = F.when(sentence.isin(*[s for i, s in sentences if i == name]), name).otherwise(found)
    return found


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  sentences: list[tuple[str, str]] = SENTENCES,
                  rules: list[tuple[str, list[str]]] = RULES,
                  parted: list[tuple[str, list[str]]] = PARTED) -> DataFrame:
    """``keep`` columns (default all) plus n_sentences, sentence_ids (array: the
    identifiers of the known sentences in order), sequence (the same with '~' for
    a run of unknown ones, list numbers between known ones left out) and licenses
    (array, in the order of the text, repeats included).  n_sentences counts what
    the splitter cuts; of ``parted`` count the identifiers in ``sentences`` and ``rules``.  Null, empty and blank texts have none; new columns take leading
    underscores where the input has their names."""
    keep = docs.columns if keep is None else keep
    parted = [(i, x) for i, x in parted if i in {name for name, _ in sentences} | {x for _, run in rules for x in run}]
    marks = _marks(sentences, parted)
    starts = sorted({x.split(" ")[0] for x in marks})  # other sentences are spared the look
    new = fresh(docs.select(*map(col, keep)), "n_sentences", "sentence_ids", "sequence", "licenses")
    t, s, q, m = fresh(docs, "text_", "parts_", "sequence_", "matched_")
    maybe = "^[^a-z0-9]*(?:" + "|".join(x.replace(".", "[.]").replace("+", "[+]") for x in starts) + ")"

    def mark(line: Column) -> Column:
        found = _lookup(filled(normal(line)), [(i, x) for x, i in marks.items()])
        return F.when(F.lower(line).rlike(maybe), F.coalesce(found, F.lit("~"))).otherwise(F.lit("~"))

    def marked_line(line: Column) -> Column:
        return F.when(F.lower(line).rlike(_COPYRIGHT), "#").otherwise(mark(line))

    def marked(sentence: Column) -> Column:
        whole, lines = mark(sentence), F.transform(F.split(sentence, "\n"), marked_line)
        notice = F.lower(sentence).contains("copyright") & sentence.rlike(_NOTICES)
        bare = F.when(notice, mark(F.regexp_replace(sentence, _NOTICES, "")))
        return F.when(whole != "~", whole).when(bare != "~", F.concat(F.lit("#"), bare)) \
            .when((F.length(sentence) < 16) & sentence.rlike(_NUMBER), "#") \
            .when(sentence.contains("\n"), F.array_join(lines, "")).otherwise(marked_line(sentence))

    def result(parts: Column) -> Column:
        sequence = F.array_join(F.transform(parts, marked), "")
        for run, name in _runs(sentences, parted):
            sequence = F.replace(sequence, F.lit(run), F.lit(name))
        sequence = F.regexp_replace(F.regexp_replace(sequence, "[{][0-9]+[}]", "~"), "(?<=>)#+(?=<)", "")
        sequence = F.regexp_replace(sequence, "[#~]+", "~")
        lower = F.lower(F.col(t))
        held = F.lit(False)
        for word in ANCHORS if sentences is SENTENCES else [""]:
            held = held | lower.contains(word)
        sequence = F.when(held, sequence).when(F.size(parts) > 0, "~").otherwise("")
        return F.struct(F.size(parts).cast("long").alias(s), sequence.alias(q))

    text = F.coalesce(col(text_col), F.lit(""))
    out = docs.select(*map(col, keep), text.alias(t))
    out = out.select(*map(col, keep), F.inline(F.transform(F.array(
        F.filter(F.split(F.col(t), _SPLIT), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), result)))
    matched = F.replace(F.col(q), F.lit(_RIGHTS), F.lit(""))
    for licence, run in rules:
        matched = F.replace(matched, F.lit("".join(f"<{x}>" for x in run)), F.lit(f"[{licence}]"))
    out = out.withColumn(m, matched)
    return out.select(
        *map(col, keep), F.col(s).alias(new[0]),
        F.regexp_extract_all(q, F.lit("<([^>]*)>"), 1).alias(new[1]), F.col(q).alias(new[2]),
        F.regexp_extract_all(m, F.lit(r"\[([^\]]*)\]"), 1).alias(new[3]))


def op1_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return out.select("doc_id", "n_sentences", F.size("sentence_ids").cast("long").alias("n_known"), "sequence",
                      F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({q(i)}, {q(s)})" for s, i in _marks(SENTENCES, PARTED).items())
    runs = "string_agg(mark, '' ORDER BY i)"
    for run, name in _runs(SENTENCES, PARTED):
        runs = f"replace({runs}, {q(run)}, {q(name)})"
    matched = f"replace(sequence, {q(_RIGHTS)}, '')"
    for licence, run in RULES:
        matched = f"replace({matched}, {q(''.join(f'<{x}>' for x in run))}, {q(f'[{licence}]')})"

    def norm(x: str) -> str:
        x = f"regexp_replace(trim(regexp_replace(lower({x}), '[^a-z0-9.+]+', ' ', 'g'), ' '), '[. ]+$', '')"
        for pattern, known in SLOTS:
            x = f"regexp_replace({x}, {q(pattern)}, {q(known)})"
        return x

    return rf"""
WITH known(mark, sentence) AS (VALUES {values}),
split AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''),
            '[.!?:;]+(?:[\x20\x09-\x0D]+|$)|\n[\x20\x09\x0D]*\n'), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS parts
          FROM documents),
sentences AS (SELECT doc_id, i, parts[i] AS s, regexp_replace(parts[i], '{_NOTICES}', '') AS bare
              FROM split, range(1, 1 + len(parts)) AS r(i)),
lines AS (SELECT doc_id, i, j, string_split(s, chr(10))[j] AS line
          FROM sentences, range(1, 1 + len(string_split(s, chr(10)))) AS r(j)),
by_line AS (SELECT l.doc_id, l.i, string_agg(CASE WHEN regexp_matches(lower(l.line), '{_COPYRIGHT}') THEN '#'
                                                  ELSE coalesce(k.mark, '~') END, '' ORDER BY l.j) AS marks
            FROM lines l LEFT JOIN known k ON {norm('l.line')} = k.sentence GROUP BY l.doc_id, l.i),
marks AS (SELECT b.doc_id, b.i, coalesce(w.mark, '#' || x.mark, CASE
                   WHEN length(t.s) < 16 AND regexp_matches(t.s, '{_NUMBER}') THEN '#' ELSE b.marks END) AS mark
          FROM by_line b JOIN sentences t ON b.doc_id = t.doc_id AND b.i = t.i
          LEFT JOIN known w ON {norm('t.s')} = w.sentence
          LEFT JOIN known x ON t.bare <> t.s AND {norm('t.bare')} = x.sentence),
joined AS (SELECT doc_id, {runs} AS marks FROM marks GROUP BY doc_id),
sequences AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(marks, '[{{][0-9]+[}}]', '~', 'g'),
                                                           '>#+<', '><', 'g'), '[#~]+', '~', 'g') AS sequence FROM joined),
scanned AS (SELECT s.doc_id, CAST(len(s.parts) AS BIGINT) AS n_sentences, coalesce(q.sequence, '') AS sequence
            FROM split s LEFT JOIN sequences q ON s.doc_id = q.doc_id)
SELECT doc_id, n_sentences, CAST(len(regexp_extract_all(sequence, '<([^>]*)>', 1)) AS BIGINT) AS n_known, sequence,
       array_to_string(regexp_extract_all({matched}, '\[([^\]]*)\]', 1), ',') AS licenses
FROM scanned
"""


QUERIES = {"op1_license_rules": op1_license_rules}
ORACLES = {"op1_license_rules": _sql()}
