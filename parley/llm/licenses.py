"""License scans by sentence rules, in DataFrame functions only.

Texts are cut into pieces at line ends and after ., !, ? or ; before white space (but not
in "v. 2"); a piece is normalised (lower case, runs of other signs than letters and digits
as one space, trimmed). A piece, or several that only single line ends part (hard-wrapped
text, comment signs before its lines included), is mapped to the identifier of the known
licence sentence that it equals; the longest counts. A document's
identifiers, in order, are matched against ordered rules: a rule holds where its
identifiers follow each other, with unknown sentences between them ignored. Per licence (or
family of licences) the first rule that holds counts. Documents without any cue that each known sentence
contains skip the cutting.

A null or empty text matches nothing (empty strings, zero counts). Repeated rows are
scanned alike; columns other than the key and the text are not read; an empty table gives
no rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import text_or_empty

#: Known licence sentences, normalised (fixed values: wording of the public licences). Where a licence
#: has "free software;", its sentence starts after the semicolon.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "apache-2-licensed": "licensed under the apache license version 2 0",
    "apache-2-the-license": "licensed under the apache license version 2 0 the license",
    "apache-2-compliance": "you may not use this file except in compliance with the license",
    "apache-2-obtain": "you may obtain a copy of the license at",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3-program": "this program is licensed under the gnu general public license version 3",
    "gpl-free-software": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "apache-2-software": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2-language": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-2-free-software": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-2-only-terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-details": "see the gnu general public license for more details",
    "lgpl-2-1-free-software": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-2-1-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-free-software": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "lgpl-details": "see the gnu lesser general public license for more details",
    "agpl-3-free-software": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-details": "see the gnu affero general public license for more details",
    "agpl-received": "you should have received a copy of the gnu affero general public license along with this program",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-3-licensed": "licensed under the bsd 3 clause license",
    "bsd-2-licensed": "licensed under the bsd 2 clause license",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl-2-copy-http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "epl-2-program": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl-2-spdx": "spdx license identifier epl 2 0",
    "epl-1-program": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "cc0-waived": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "cc0-licensed": "licensed under cc0 1 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache-2": "spdx license identifier apache 2 0",
    "spdx-bsd-2": "spdx license identifier bsd 2 clause",
    "spdx-bsd-3": "spdx license identifier bsd 3 clause",
    "spdx-isc": "spdx license identifier isc",
    "spdx-cc0": "spdx license identifier cc0 1 0",
    "spdx-gpl-2-only": "spdx license identifier gpl 2 0 only",
    "spdx-gpl-3-later": "spdx license identifier gpl 3 0 or later",
    "spdx-mpl-2": "spdx license identifier mpl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

#: Licences of one family: a text has the first of their rules that holds.
FAMILIES = {"BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD"}

#: (rule, licence, sentence identifiers in order); the longer rules of a licence come first, and a
#: rule may stand several times, with different sentences.
RULES = [
    ("mit-full", "MIT", ["mit-grant", "mit-notice"]),
    ("mit-grant", "MIT", ["mit-grant"]),
    ("mit-mention", "MIT", ["mit-released"]),
    ("mit-mention-2", "MIT", ["mit-licensed"]),
    ("mit-spdx", "MIT", ["spdx-mit"]),
    ("apache-2-body", "Apache-2.0", ["apache-2-the-license", "apache-2-compliance", "apache-2-obtain", "apache-2-software", "apache-2-language"]),
    ("apache-2-full", "Apache-2.0", ["apache-2-the-license", "apache-2-compliance", "apache-2-obtain"]),
    ("apache-2-mention", "Apache-2.0", ["apache-2-licensed"]),
    ("apache-2-mention-2", "Apache-2.0", ["apache-2-the-license"]),
    ("apache-2-spdx", "Apache-2.0", ["spdx-apache-2"]),
    ("gpl-2-full", "GPL-2.0-or-later", ["gpl-2-free-software", "gpl-hope", "gpl-details", "gpl-received"]),
    ("gpl-2-full", "GPL-2.0-or-later", ["gpl-2-terms", "gpl-hope", "gpl-details", "gpl-received"]),
    ("gpl-2-grant", "GPL-2.0-or-later", ["gpl-2-free-software"]),
    ("gpl-2-grant", "GPL-2.0-or-later", ["gpl-2-terms"]),
    ("gpl-2-only-grant", "GPL-2.0", ["gpl-2-only"]),
    ("gpl-2-only-grant", "GPL-2.0", ["gpl-2-only-terms"]),
    ("gpl-2-mention", "GPL-2.0", ["gpl-2-work"]),
    ("gpl-2-spdx", "GPL-2.0", ["spdx-gpl-2-only"]),
    ("gpl-3-full", "GPL-3.0", ["gpl-free-software", "gpl-hope", "gpl-details", "gpl-received"]),
    ("gpl-3-full", "GPL-3.0", ["gpl-free-software", "gpl-hope", "gpl-received"]),
    ("gpl-3-grant", "GPL-3.0", ["gpl-free-software"]),
    ("gpl-3-spdx", "GPL-3.0", ["spdx-gpl-3-later"]),
    ("gpl-3-mention", "GPL-3.0", ["gpl-3-work"]),
    ("gpl-3-mention-2", "GPL-3.0", ["gpl-3-program"]),
    ("lgpl-2-1-full", "LGPL-2.1", ["lgpl-2-1-free-software", "lgpl-hope", "lgpl-details"]),
    ("lgpl-2-1-full", "LGPL-2.1", ["lgpl-2-1-terms", "lgpl-hope", "lgpl-details"]),
    ("lgpl-2-1-grant", "LGPL-2.1", ["lgpl-2-1-free-software"]),
    ("lgpl-2-1-grant", "LGPL-2.1", ["lgpl-2-1-terms"]),
    ("lgpl-3-full", "LGPL-3.0", ["lgpl-3-free-software", "lgpl-hope", "lgpl-details"]),
    ("lgpl-3-full", "LGPL-3.0", ["lgpl-3-terms", "lgpl-hope", "lgpl-details"]),
    ("lgpl-3-grant", "LGPL-3.0", ["lgpl-3-free-software"]),
    ("lgpl-3-grant", "LGPL-3.0", ["lgpl-3-terms"]),
    ("agpl-3-full", "AGPL-3.0", ["agpl-3-free-software", "gpl-hope", "agpl-details", "agpl-received"]),
    ("agpl-3-grant", "AGPL-3.0", ["agpl-3-free-software"]),
    ("isc-full", "ISC", ["isc-grant"]),
    ("isc-spdx", "ISC", ["spdx-isc"]),
    ("bsd-3-full", "BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("bsd-3-mention", "BSD-3-Clause", ["bsd-3-licensed"]),
    ("bsd-3-spdx", "BSD-3-Clause", ["spdx-bsd-3"]),
    ("bsd-2-mention", "BSD-2-Clause", ["bsd-2-licensed"]),
    ("bsd-2-spdx", "BSD-2-Clause", ["spdx-bsd-2"]),
    ("bsd-2-full", "BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("bsd-full", "BSD", ["bsd-redistribution", "bsd-source"]),
    ("bsd-mention", "BSD", ["bsd-redistribution"]),
    ("mpl-2-notice", "MPL-2.0", ["mpl-2-form", "mpl-2-copy"]),
    ("mpl-2-notice", "MPL-2.0", ["mpl-2-form", "mpl-2-copy-http"]),
    ("mpl-2-notice", "MPL-2.0", ["mpl-2-form"]),
    ("mpl-2-spdx", "MPL-2.0", ["spdx-mpl-2"]),
    ("epl-2-notice", "EPL-2.0", ["epl-2-program"]),
    ("epl-2-spdx", "EPL-2.0", ["epl-2-spdx"]),
    ("epl-1-notice", "EPL-1.0", ["epl-1-program"]),
    ("cc0-waiver", "CC0-1.0", ["cc0-waived"]),
    ("cc0-mention", "CC0-1.0", ["cc0-licensed"]),
    ("cc0-spdx", "CC0-1.0", ["spdx-cc0"]),
    ("cc-by-mention", "CC-BY-4.0", ["cc-by-4"]),
    ("cc-by-work", "CC-BY-4.0", ["cc-by-work"]),
    ("cc-by-sa-mention", "CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("cc-by-nc-mention", "CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("unlicense", "Unlicense", ["unlicense"]),
]

#: Ends of sentences that a line end cannot bridge; ``END`` stands for them in lower-case text.
END, ENDS = "E", r"(?!(?<=\bv)\.[ \t\r\n]+[^a-z0-9\n]*[0-9])[.!?;][ \t\r\n]+"


def cues(sentences: dict[str, str]) -> list[str]:
    """A few words such that every known sentence holds one of them."""
    left, out = [set(s.split()) for s in sentences.values()], []
    while left:
        words = sorted({w for s in left for w in s}, key=lambda w: (-sum(w in s for s in left), -len(w), w))
        out.append(next(w for w in words if len(w) > 5 or not any(len(x) > 5 for x in words)))
        left = [s for s in left if out[-1] not in s]
    return out


def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order, as array<string>."""
    ended = F.regexp_replace(F.lower(text), ENDS, END)
    plain = F.regexp_replace(F.regexp_replace(ended, f"[^a-z0-9\n{END}]+", " "), f" ?([\n{END}]) ?", "$1")
    # a blank line ends a sentence too
    marked = F.concat(F.lit(END), F.regexp_replace(F.trim(plain), "\n\n+", END), F.lit(END))
    longest = sorted(sentences.values(), key=lambda s: (-len(s), s))
    either = "|".join("[ \n]".join(rf"\Q{w}\E" for w in s.split(" ")) for s in longest)
    found = F.regexp_extract_all(marked, F.lit(f"(?<=[\n{END}])(?:{either})(?=[\n{END}])"), F.lit(0))
    known = F.create_map(*[F.lit(x) for k, s in sentences.items() for x in (s, k)])
    return F.transform(found, lambda s: F.try_element_at(known, F.translate(s, "\n", " ")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences: dict[str, str] | None = None, rules: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """(id_col, n_sentences int, sentences string, rules string, licenses string) for
    every row: counts and comma-joined identifiers; rules and licences in rule order."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    text = text_or_empty(text_col)
    hinted = functools.reduce(Column.__or__, [F.contains(F.lower(text), F.lit(c)) for c in cues(sentences)])
    found = docs.select(F.col(id_col), F.when(hinted, sentence_ids(text, sentences)).otherwise(F.array().cast("array<string>")).alias("ids"))
    chain = F.concat(F.lit(","), F.concat_ws(",", "ids"), F.lit(","))
    first, licence = {}, {}
    for name, own in by_family(rules).items():
        case, named = F, F
        for r, lic, ids in own:
            holds = F.contains(chain, F.lit("," + ",".join(ids) + ","))
            case, named = case.when(holds, F.lit(r)), named.when(holds, F.lit(lic))
        first[name], licence[name] = case, named
    out = found.select(id_col, F.size("ids").alias("n_sentences"), F.concat_ws(",", "ids").alias("sentences"),
                       F.concat_ws(",", *first.values()).alias("rules"), F.concat_ws(",", *licence.values()).alias("licenses"))
    return out.select(id_col, "n_sentences", "sentences", "rules", "licenses")


def by_family(rules: list[tuple[str, str, list[str]]]) -> dict[str, list[tuple[str, str, list[str]]]]:
    """The rules of each family of licences, in rule order."""
    out: dict[str, list] = {}
    for rule in rules:
        out.setdefault(FAMILIES.get(rule[1], rule[1]), []).append(rule)
    return out


def oracle_sql() -> str:
    """The scan in DuckDB SQL: sentences as runs of successive lines of a piece, joined and looked
    up; of runs that lie in one another the longest counts."""
    known = ", ".join(f"('{s}', '{k}')" for k, s in SENTENCES.items())
    reach = max(len(s.split(" ")) for s in SENTENCES.values())
    def case(own: list, k: int) -> str:
        return "CASE " + " ".join(f"WHEN contains(chain, ',{','.join(x[2])},') THEN '{x[k]}'" for x in own) + " END"

    families = by_family(RULES).values()
    rules, names = (", ".join(case(own, k) for own in families) for k in (0, 1))
    hinted = " OR ".join(f"contains(lower(text), '{c}')" for c in cues(SENTENCES))
    version = "regexp_replace(lower(text), '(^|[^a-z0-9_])v\\.([ \\t\\r\\n]+[^a-z0-9\\n]*[0-9])', '\\1v \\2', 'g')"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
t AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
e AS (SELECT r, regexp_replace({version}, '[.!?;][ \\t\\r\\n]+', 'E', 'g') AS x FROM t WHERE {hinted}),
w AS (SELECT r, regexp_replace(regexp_replace(x, '[^a-z0-9\\nE]+', ' ', 'g'), ' ?([\\nE]) ?', '\\1', 'g') AS x FROM e),
p AS (SELECT r, unnest(string_split(regexp_replace(trim(x, ' '), '\\n\\n+', 'E', 'g'), 'E')) AS piece,
             generate_subscripts(string_split(regexp_replace(trim(x, ' '), '\\n\\n+', 'E', 'g'), 'E'), 1) AS place FROM w),
l AS (SELECT r, place, string_split(piece, chr(10)) AS lines FROM p WHERE piece <> ''),
runs AS (SELECT r, place, lines, unnest(range(1, len(lines) + 1)) AS a FROM l),
ends AS (SELECT *, unnest(range(a, least(a + {reach}, len(lines) + 1))) AS b FROM runs),
hits AS (SELECT r, place, a, b, known.id FROM ends JOIN known ON array_to_string(lines[a:b], ' ') = known.sentence),
f AS (SELECT r, count(*)::INT AS n, string_agg(id, ',' ORDER BY place, a) AS ids FROM hits h
      WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.r = h.r AND g.place = h.place AND g.a <= h.a AND g.b >= h.b AND g.b - g.a > h.b - h.a) GROUP BY r),
d AS (SELECT doc_id, coalesce(n, 0)::INT AS n_sentences, coalesce(ids, '') AS sentences, ',' || coalesce(ids, '') || ',' AS chain
      FROM t LEFT JOIN f USING (r))
SELECT doc_id, n_sentences, sentences, concat_ws(',', {rules}) AS rules, concat_ws(',', {names}) AS licenses FROM d
"""
