"""Licence scans by sentence rules.

A text is cut into sentences. Each normalised sentence that is a known licence
sentence becomes an identifier; the identifiers in page order are matched
against ordered rules, first rule first, longest reading of the text per rule.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Every pattern below needs one of these in the normalised sentence.
HINTS = ("license", "copyright", "(c)", "©", "permission", "redistribut", "spdx", "public domain", "all rights reserved", "cc0", "cc zero",
         "cc-zero", "creative commons", "provided", "liable", "endorse", "advertising", "applicable law", "free software", "in the hope",
         "gpl", "bsd", "confidential")

_NAME = r"(?:the )?(?:terms of )?(?:the )?"
_CC = r"(?:creative commons|cc)[ -]"
_REST = r"(?:(?:[,;:(]| -| see| -- ).*)?"
_UNDER = r"(?:released|licensed|distributed|available|published|provided|covered)(?: to you)? under"

#: Identifier and pattern of each known sentence (fixed values: the wording of public licences).
SENTENCES = (
    ("spdx={0}", r"spdx-license-identifier: ?([a-z0-9.+-]+(?: (?:or|and|with) [a-z0-9.+-]+)*)"),
    ("copyright", r"(?:copyright|\(c\)|©).*\d{4}.*|copyright (?:\(c\)|©|by) .*"),
    ("all-rights-reserved", r"all rights reserved"),
    ("cc0", rf"(?:.*\b)?(?:cc0(?: 1\.0)?|{_CC}zero)\b.*"),
    ("cc={0}={1}", rf".*\blicensed under (?:a |the )?(?:{_CC})(by(?:[ -](?:nc|nd|sa))*)(?:[ -]?(?:license,? ?)?(?:version )?(\d\.\d)(?: \w+)?)?(?: license)?"),
    ("cc={0}={1}", rf".*\blicensed under (?:a |the )?creative commons (attribution(?:-(?:noncommercial|noderivatives|noderivs|sharealike))*) (\d\.\d)(?: \w+)? license"),
    ("mit-name", rf".*\b(?:released|licensed|distributed|available|published|provided) under {_NAME}mit(?: \(expat\))? license{_REST}"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r"(?:this|the) (?:software|program|library) is provided .*as is.*"),
    ("no-liability", r"in no event shall .* be liable for any .*"),
    ("isc-grant", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted,? provided that .*"),
    ("0bsd-grant", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.*"),
    ("boost-grant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license.*"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:\(?[0-9a-z]?[.)]? ?)redistributions of source code must retain the (?:above )?copyright notice.*"),
    ("bsd-binary", r"(?:\(?[0-9a-z]?[.)]? ?)redistributions in binary form must reproduce the (?:above )?copyright notice.*"),
    ("bsd-endorse", r"(?:\(?[0-9a-z]?[.)]? ?)(?:neither )?the names? of .* may (?:not )?be used to endorse or promote products.*"),
    ("bsd-advert", r"(?:\(?[0-9a-z]?[.)]? ?)all advertising materials mentioning features or use of this software must display.*"),
    ("bsd-name={0}{1}", rf".*\b(?:released|licensed|distributed|available) under {_NAME}(?:(2|3|4)[ -]clause )?bsd(?:[ -](2|3|4)[ -]clause)?(?: license)?{_REST}"),
    ("apache={0}", rf".*\b(?:licensed|released|distributed|available) (?:to you )?under {_NAME}apache(?: software)? license,?(?: ?version| ?v)? ?(\d(?:\.\d)?)?(?: \(the license\))?{_REST}"),
    ("apache-comply", r"you may not use this (?:file|work) except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at.*"),
    ("apache-unless", r"unless required by applicable law or agreed to in writing, .*"),
    ("gpl={0}={1}={2}", rf".*\b(?:licensed|released|distributed|available) under {_NAME}(?:gnu )?(lesser |library |affero )?(?:general public license|l?gpl|agpl),? ?(?:version |v)?(\d(?:\.\d)?)?(?:,? (?:only|(or (?:\(at your option\) )?(?:any )?later)(?: version)?))?"),
    ("gpl-free={0}={1}", r".* is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (lesser |library |affero )?general public license as published by the free software foundation(?:[,;] either version (\d(?:\.\d)?) of the license, or \(at your option\) any later version)?"),
    ("gpl-either={0}", r"(?:.*[,;] ?)?either version (\d(?:\.\d)?) of the license, or \(at your option\) any later version"),
    ("gpl-hope", r".* is distributed in the hope that it will be useful.*"),
    ("gpl-see", r"see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("mpl={0}", rf".*\b(?:subject to|{_UNDER}) {_NAME}mozilla public license,? ?v?(?:ersion|\.)? ?(\d\.\d){_REST}"),
    ("epl={0}", rf".*\b{_UNDER} {_NAME}eclipse public license(?:,? ?(?:version |v\.? ?|- v ?)?(\d\.\d))?(?: which .*)?{_REST}"),
    ("boost={0}", rf".*\b{_UNDER} {_NAME}boost software license(?:,? ?(?:version )?(\d\.\d))?{_REST}"),
    ("artistic={0}", rf".*\b{_UNDER} {_NAME}artistic license(?:,? ?(?:version )?(\d\.\d))?{_REST}"),
    ("zlib-name", rf".*\b{_UNDER} {_NAME}zlib(?:/libpng)? license{_REST}"),
    ("isc-name", rf".*\b{_UNDER} {_NAME}isc license{_REST}"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", r".*\b(?:released|placed|dedicated) (?:in)?to the public domain"),
    ("proprietary", r".*\b(?:proprietary and confidential|confidential and proprietary)\b.*"),
    ("named={0}", r".*\b(?:released|licensed|distributed) under (?:the terms of )?(?:the )?([a-z0-9.+ -]{2,40}? licen[sc]e(?:,? (?:version )?\d(?:\.\d)?)?)"),
)

#: Licence and the identifiers it needs in this order (patterns over identifiers); first matching rule first.
RULES = (
    ("{0}", (r"spdx=(.+)",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-name",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-{0}-Clause", (r"bsd-name=(\d)",)),
    ("BSD", (r"bsd-name=",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-name",)),
    ("0BSD", ("0bsd-grant",)),
    ("Zlib", ("as-is", "no-liability", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("Zlib", ("zlib-name",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-{0}", (r"boost=(.+)",)),
    ("BSL-1.0", ("boost=",)),
    ("Apache-{0}", (r"apache=(\d[\d.]*)", "apache-comply", "apache-copy", "apache-unless")),
    ("Apache-{0}", (r"apache=(\d[\d.]*)",)),
    ("Apache", ("apache=",)),
    ("{0}GPL-{1}-or-later", (r"gpl-free=([^=]*)=", r"gpl-either=(.+)", "gpl-hope", "gpl-see")),
    ("{0}GPL-{1}-or-later", (r"gpl-free=([^=]*)=(.+)", "gpl-hope", "gpl-see")),
    ("{0}GPL-{1}-or-later", (r"gpl-free=([^=]*)=", r"gpl-either=(.+)")),
    ("{0}GPL-{1}-or-later", (r"gpl-free=([^=]*)=(.+)",)),
    ("{0}GPL", (r"gpl-free=([^=]*)=",)),
    ("{0}GPL-{1}-or-later", (r"gpl=([^=]*)=([^=]+)=(?:.+)",)),
    ("{0}GPL-{1}", (r"gpl=([^=]*)=([^=]+)=",)),
    ("{0}GPL", (r"gpl=([^=]*)==.*",)),
    ("MPL-{0}", (r"mpl=(.+)",)),
    ("EPL-{0}", (r"epl=(.+)",)),
    ("EPL", ("epl=",)),
    ("Artistic-{0}", (r"artistic=(.+)",)),
    ("Artistic", ("artistic=",)),
    ("CC-{0}-{1}", (r"cc=([^=]+)=([^=]+)",)),
    ("CC-{0}", (r"cc=([^=]+)=",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("Public-Domain", ("public-domain",)),
    ("Proprietary", ("proprietary",)),
    ("Other: {0}", (r"named=(.+)",)),
    ("All-Rights-Reserved", ("all-rights-reserved",)),
)

_SENTENCES = tuple((name, re.compile(pattern)) for name, pattern in SENTENCES)
_RULES = tuple((name, tuple(re.compile(p) for p in parts)) for name, parts in RULES)
_CUT = re.compile(r"[.!?;](?=\s)|\n[\s*#/]*\n|\n(?=[\s*#/]*(?:\d+[.)]|[•-])\s)|\Z")
_NOT = re.compile(r"\bnot (?:be )?(?:released|licensed|distributed|available|published|covered)\b")
_LAST_UNDER = re.compile(rf"\b{_UNDER}(?: either)? ")
_EITHER = re.compile(r",? (?:and/or|or|and) (?:under )?")
_NAMED = re.compile(r"\b(?:license|gpl|bsd|mit)\b")
#: Known sentences that a cut may divide: how their first piece ends.
_OPENINGS = re.compile(r"(?:free software[:;]|license,? v\.|license;|granted[;,]?|foundation[;,.]?)\s*$", re.I)
JOINED = 4
_TAIL = 200
_DECORATION = re.compile(r"(?m)^[\s*#/;>|•-]+|(?<![\s*/])[\s*/]+$")


def normalised(sentence: str) -> str:
    """Lower case, one space for white space, plain quotes left out, comment marks and end marks stripped."""
    text = _DECORATION.sub(" ", sentence.lower().replace("licence", "license"))
    text = re.sub(r"[\"'`“”‘’«»]", "", text)
    return " ".join(text.split()).strip(" .,;:!?")


def _fill(template: str, groups) -> str:
    return re.sub(r"\{(\d)\}", lambda m: (groups[int(m[1])] or "") if int(m[1]) < len(groups) else "", template)


def _identified(plain: str) -> str | None:
    for name, pattern in _SENTENCES:
        if found := pattern.fullmatch(plain):
            return _fill(name, [(g or "").strip() for g in found.groups()])
    return None


def _known(raw: str) -> list[str]:
    """Identifiers of a sentence: one, or one for each licence it offers, or none.

    "under A or B" is read as "under A" and "under B". What is said not to be
    under a licence names none.
    """
    plain = normalised(raw)
    if not any(h in plain for h in HINTS) or _NOT.search(plain):
        return []
    under = None
    for under in _LAST_UNDER.finditer(plain):
        pass
    parts = _EITHER.split(plain[under.end():], maxsplit=1) if under else []
    if len(parts) == 2 and _NAMED.search(parts[1]):
        names = [_identified(f"licensed under {part}") for part in parts]
        if all(n and n.partition("=")[0] != "named" for n in names):
            return names
    name = _identified(plain)
    return [name] if name else []


def sentences(text: str) -> list[tuple[int, int, str]]:
    """Known sentences as (start, end, identifier), in order.

    A cut may fall inside a known sentence, at a semicolon or an abbreviation;
    so the longest of up to ``JOINED`` pieces in a row that is known is taken.
    A piece that is in none is tried line by line. Sentences may be of any length.
    """
    out, start, pieces = [], 0, []
    for cut in _CUT.finditer(text):
        pieces.append((start, cut.end(), cut[0][:1] in (";", ".")))
        start = cut.end()

    def add(low: int, high: int) -> bool:
        raw = text[low:high]
        names = _known(raw)
        out.extend((low + len(raw) - len(raw.lstrip()), low + len(raw.rstrip()), name) for name in names)
        return bool(names)

    i = 0
    while i < len(pieces):
        low, high, goes_on = pieces[i]
        reach = 1
        if goes_on and _OPENINGS.search(" ".join(_DECORATION.sub(" ", text[max(low, high - _TAIL):high]).split())):
            while reach < JOINED and i + reach < len(pieces) and pieces[i + reach - 1][2]:
                reach += 1
        for count in range(reach, 1, -1):
            if add(low, pieces[i + count - 1][1]):
                i += count
                break
        else:
            raw = text[low:high]
            if not add(low, high) and "\n" in raw:
                at = low
                for line in raw.split("\n"):
                    add(at, at + len(line))
                    at += len(line) + 1
            i += 1
    return out


def licences(identifiers: list[str]) -> list[tuple[str, int, int]]:
    """(licence, first, last) of each rule match in the sequence; copyright lines between parts of a rule are passed over."""
    at = [i for i, name in enumerate(identifiers) if name != "copyright"]
    taken, out = set(), []
    for template, parts in _RULES:
        for low in range(len(at) - len(parts) + 1):
            places = at[low:low + len(parts)]
            if taken.intersection(places):
                continue
            groups = []
            for part, place in zip(parts, places):
                found = part.fullmatch(identifiers[place])
                if not found:
                    break
                groups += found.groups()
            else:
                taken.update(places)
                out.append((_named(template, groups), places[0], places[-1]))
    return sorted(out, key=lambda x: x[1:])


def _named(template: str, groups: list[str]) -> str:
    short = {"lesser": "L", "library": "L", "affero": "A"}
    tidy = [short.get(g, g) if "GPL" in template else g.upper().replace(" ", "-") if template.startswith("CC") else g
            for g in ((g or "").strip() for g in groups)]
    name = _fill(template, tidy)
    for word, brief in (("ATTRIBUTION", "BY"), ("NONCOMMERCIAL", "NC"), ("NODERIVATIVES", "ND"), ("NODERIVS", "ND"), ("SHAREALIKE", "SA")):
        name = name.replace(word, brief) if name.startswith("CC-") else name
    return re.sub(r"(GPL-\d)(?=-|\Z)", r"\1.0", name)


def scan(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` with _licences and _sentences, over whole texts.

    ``_licences`` is an array of (licence, start, end), ``_sentences`` one of
    (start, end, identifier); positions are code points, end exclusive. Both are
    empty for a null or empty text. Other columns are kept; one that has an added name is replaced.
    """
    documents = documents.drop("_licences", "_sentences", "_judged")
    schema = "licences array<struct<licence:string,start:int,end:int>>, sentences array<struct<start:int,end:int,identifier:string>>"

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            known = sentences(text or "")
            found = [{"licence": name, "start": known[a][0], "end": known[b][1]}
                     for name, a, b in licences([k[2] for k in known])]
            rows.append((found, [{"start": s, "end": e, "identifier": i} for s, e, i in known]))
        return pd.DataFrame({"licences": [r[0] for r in rows], "sentences": [r[1] for r in rows]})

    return documents.select("*", judge(F.col(text_col).cast("string")).alias("_judged")).select(
        *[F.col(f"`{c}`") for c in documents.columns],
        F.col("_judged.licences").alias("_licences"), F.col("_judged.sentences").alias("_sentences"))
