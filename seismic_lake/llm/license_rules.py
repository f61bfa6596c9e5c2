"""Signature rules of licences, written on lower-case words parted by single spaces.

A rule fires where its first word stands and its pattern matches the words after it. Rules of a higher
priority or, at one priority, longer matches suppress what they contain.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    first: str  # the keyword that lets the rule be tried
    pattern: str  # of the words that follow
    label: str
    priority: int
    confidence: float


MAX_WORDS = 24  # of a match, at most; patterns are shorter

# Names as they stand in running text: (label, first word, the words after it).
NAMES = [
    ("mit", "mit", "(?:license|licence)"),
    ("mit", "expat", "(?:license|licence)"),
    ("apache-2.0", "apache", "(?:software )?(?:license|licence) (?:version |v)?2(?: 0)?"),
    ("apache-1.1", "apache", "(?:software )?(?:license|licence) (?:version |v)?1 1"),
    ("apache", "apache", "(?:software )?(?:license|licence)"),
    ("gpl-3.0", "gnu", "(?:gpl|general public (?:license|licence)) (?:version |v)?3(?: 0)?"),
    ("gpl-2.0", "gnu", "(?:gpl|general public (?:license|licence)) (?:version |v)?2(?: 0)?"),
    ("gpl", "gnu", "(?:gpl|general public (?:license|licence))"),
    ("gpl-3.0", "gpl", "(?:version 3|v3|3 0)(?: 0)?(?: (?:license|licence))?"),
    ("gpl-2.0", "gpl", "(?:version 2|v2|2 0)(?: 0)?(?: (?:license|licence))?"),
    ("gpl-3.0", "general", "public (?:license|licence) (?:version |v)3(?: 0)?"),
    ("gpl-2.0", "general", "public (?:license|licence) (?:version |v)2(?: 0)?"),
    ("gpl", "general", "public (?:license|licence)"),
    ("lgpl", "gnu", "(?:lgpl|(?:lesser|library) general public (?:license|licence))(?: (?:version |v)?[23](?: [01])?)?"),
    ("lgpl", "lesser", "general public (?:license|licence)"),
    ("agpl-3.0", "gnu", "(?:agpl|affero general public (?:license|licence))(?: (?:version |v)?3(?: 0)?)?"),
    ("agpl-3.0", "affero", "general public (?:license|licence)"),
    ("fdl", "gnu", "free documentation (?:license|licence)(?: (?:version |v)?1 [1-3])?"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause(?: (?:license|licence))?"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause(?: (?:license|licence))?"),
    ("bsd", "bsd", "(?:style )?(?:license|licence)"),
    ("bsd-3-clause", "new", "bsd (?:license|licence)"),
    ("bsd-2-clause", "simplified", "bsd (?:license|licence)"),
    ("mpl-2.0", "mozilla", "public (?:license|licence) (?:version |v)?2(?: 0)?"),
    ("mpl", "mozilla", "public (?:license|licence)"),
    ("epl", "eclipse", "public (?:license|licence)(?: (?:version |v)?[12](?: 0)?)?"),
    ("eupl", "european", "union public (?:license|licence)"),
    ("cddl", "common", "development and distribution (?:license|licence)"),
    ("artistic", "artistic", "(?:license|licence)(?: 2 0)?"),
    ("isc", "isc", "(?:license|licence)"),
    ("zlib", "zlib", "(?:libpng )?(?:license|licence)"),
    ("boost", "boost", "software (?:license|licence)"),
    ("unlicense", "the", "unlicense"),
    ("wtfpl", "wtfpl", "(?:license|licence)"),
    ("ofl", "sil", "open font (?:license|licence)"),
    ("odbl", "open", "database (?:license|licence)"),
    ("psf", "python", "software foundation (?:license|licence)"),
    ("cc-by-nc-nd", "cc", "by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", "by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", "by(?: [1-4] [05])?"),
    ("cc0", "cc0", "(?:1 0|(?:license|licence))"),
    ("cc-by-nc", "creative", "commons attribution noncommercial(?: [1-4] [05])?(?: (?:international )?(?:license|licence))?"),
    ("cc-by-sa", "creative", "commons attribution sharealike(?: [1-4] [05])?(?: (?:international )?(?:license|licence))?"),
    ("cc-by", "creative", "commons attribution(?: [1-4] [05])?(?: (?:international )?(?:license|licence))?"),
    ("cc", "creative", "commons (?:license|licence)"),
]

# Verbs that announce a licence; each makes a rule with each name.
ANNOUNCED = ["licensed", "licenced", "released", "distributed", "published", "provided", "covered"]
UNDER = "(?:under|by|with) (?:the )?(?:terms of (?:the )?)?(?:conditions of (?:the )?)?"

# Sentences of the licences themselves, notices and identifiers.
SENTENCES = [
    ("mit", "permission", "is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this", "program is free software you can redistribute it and or modify it"),
    ("gpl", "this", "program is distributed in the hope that it will be useful"),
    ("lgpl", "this", "library is free software you can redistribute it and or modify it"),
    ("apache-2.0", "you", "may not use this file except in compliance with the (?:license|licence)"),
    ("mpl-2.0", "this", "source code form is subject to the terms of the mozilla public (?:license|licence)"),
    ("boost", "distributed", "under the boost software (?:license|licence)"),
    ("unlicense", "this", "is free and unencumbered software released into the public domain"),
    ("public-domain", "released", "(?:in|into|to) the public domain"),
    ("public-domain", "in", "the public domain"),
    ("proprietary", "all", "rights reserved"),
    ("warranty", "without", "warranty of any kind"),
    ("warranty", "provided", "as is without warranty"),
]
IDENTIFIERS = "mit isc zlib unlicense apache-2.0 gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-2.0 epl-2.0 bsd-2-clause bsd-3-clause cc0-1.0 cc-by-4.0 cc-by-sa-4.0".split()

#: A text without any of these has no rule that can fire.
GATE = "licen|copyright|public domain|rights reserved|warranty|redistribut|permission|cc0|cc by|in the hope that|creative commons|lgpl|gpl|spdx|bsd "


def rules() -> list[Rule]:
    out = []
    for label, first, rest in NAMES:
        out.append(Rule(first, rest, label, 2, 0.8))
        out += [Rule(verb, f"{UNDER}{first} {rest}", label, 3, 0.95) for verb in ANNOUNCED]
    out += [Rule(first, rest, label, 4 if len(rest) > 24 else 1, 0.9 if len(rest) > 24 else 0.4) for label, first, rest in SENTENCES]
    for name in IDENTIFIERS:
        out.append(Rule("spdx", f"license identifier {name.replace('-', ' ').replace('.', ' ')}", name, 5, 1.0))
    out.append(Rule("copyright", "(?:c )?(?:19|20)[0-9][0-9]", "copyright", 1, 0.3))
    return out
