"""License scans: base phrases, then ordered signature rules.

Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. Base: places
where a fixed phrase's words stand consecutively. Method: an ordered table of a few
hundred signature rules (label, level, keyword, regular expression). A rule runs only
on texts that hold its keyword. Each match is an interval of words; a detection is
dropped when its interval lies within that of another one of the same or a better
level (equal intervals: the better level, then the earlier rule, stays). The labels of
the rest are the method's, joined with the base labels, which always stay.

The rules: ``SIGNATURES``, written one by one for the licences' own sentences, short names,
SPDX identifiers and negations; then the names of ``LICENSES`` in the phrasings of
``PHRASINGS``, and notices. Level 0 is a negation ("not licensed under the ..."): it has no
label and hides the detections within it.

Score: 0 without any label; else the weight of the best surviving level, at least that
of a bare name if there is a base label (``LEVEL_WEIGHTS``). So a negated name that is
also a base phrase keeps its label, as a base label always stays, with a bare name's score.

Plan: Spark expressions only. One pass over all texts counts words and finds the gated
texts (those with any keyword). Their detections are exploded, and the containment is
one window per document over detections sorted by interval with running maxima, so
it is n log n; only detections are shuffled, never a text. Labels are joined back on
the document's key (AQE splits a hot one).

Defined results: null or empty text: no words, no labels, null first and last word,
score 0. Repeated rows: judged alike, returned as often as given. Empty table: empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.text import let, text_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Label, keyword, name pattern (on words joined by one space), and whether the
# name says enough alone.
LICENSES = [
    ("mit", "mit", "mit(?: expat| x11)?", False),
    ("mit", "expat", "expat", False),
    ("mit", "x11", "x11", False),
    ("apache-2.0", "apache", "apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)?", True),
    ("apache-1.1", "apache", "apache (?:software )?licen[sc]e (?:version |v )?1 1", True),
    ("apache", "apache", "apache(?: software)?", False),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[sc]e (?:version |v )?3(?: 0)?", True),
    ("agpl", "affero", "(?:gnu )?affero(?: general public)?", False),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v )?3(?: 0)?", True),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v )?2 1", True),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", False),
    ("gpl-3.0", "general", "(?:gnu )?general public licen[sc]e (?:version |v )?3(?: 0)?", True),
    ("gpl-2.0", "general", "(?:gnu )?general public licen[sc]e (?:version |v )?2(?: 0)?", True),
    ("gpl", "general", "(?:gnu )?general public", False),
    ("gpl", "gpl", "(?:gnu )?gpl", False),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2", False),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3", False),
    ("bsd-2-clause", "clause", "(?:bsd 2 clause|2 clause bsd)", False),
    ("bsd-2-clause", "simplified", "simplified bsd", False),
    ("bsd-3-clause", "clause", "(?:bsd 3 clause|3 clause bsd)", False),
    ("bsd-3-clause", "new", "new bsd", False),
    ("bsd-4-clause", "clause", "(?:bsd 4 clause|4 clause bsd)", False),
    ("bsd", "bsd", "bsd", False),
    ("bsd", "berkeley", "berkeley software distribution", False),
    ("cc-by-nc-sa", "nc", "cc by nc sa(?: 4 0| 3 0)?", True),
    ("cc-by-nc-sa", "sharealike", "creative commons attribution noncommercial sharealike(?: 4 0| 3 0)?", True),
    ("cc-by-nc-nd", "nc", "cc by nc nd(?: 4 0| 3 0)?", True),
    ("cc-by-nc-nd", "noderivatives", "creative commons attribution noncommercial noderivatives(?: 4 0| 3 0)?", True),
    ("cc-by-nc", "nc", "cc by nc(?: 4 0| 3 0)?", True),
    ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial(?: 4 0| 3 0)?", True),
    ("cc-by-sa", "sa", "cc by sa(?: 4 0| 3 0)?", True),
    ("cc-by-sa", "sharealike", "creative commons attribution sharealike(?: 4 0| 3 0)?", True),
    ("cc-by-nd", "nd", "cc by nd(?: 4 0| 3 0)?", True),
    ("cc-by", "cc", "cc by(?: 4 0| 3 0)?", True),
    ("cc-by", "attribution", "creative commons attribution(?: 4 0| 3 0)?", True),
    ("cc0", "cc0", "cc0(?: 1 0)?", True),
    ("cc0", "zero", "creative commons zero(?: 1 0)?", True),
    ("mpl-2.0", "mozilla", "mozilla public licen[sc]e (?:version |v )?2(?: 0)?", True),
    ("mpl", "mozilla", "mozilla public", False),
    ("epl-2.0", "eclipse", "eclipse public licen[sc]e (?:version |v )?2(?: 0)?", True),
    ("epl", "eclipse", "eclipse public", False),
    ("cddl", "cddl", "cddl", False),
    ("cddl", "development", "common development and distribution", False),
    ("isc", "isc", "isc", False),
    ("zlib", "zlib", "zlib(?: libpng)?", False),
    ("bsl-1.0", "boost", "boost software(?: licen[sc]e (?:version )?1 0)?", False),
    ("unlicense", "unlicense", "(?:the )?unlicense", True),
    ("artistic-2.0", "artistic", "artistic licen[sc]e (?:version )?2(?: 0)?", True),
    ("artistic", "artistic", "artistic", False),
    ("ofl-1.1", "sil", "sil open font", False),
    ("wtfpl", "wtfpl", "wtfpl", True),
    ("postgresql", "postgresql", "postgresql", False),
    ("python-2.0", "python", "python(?: software foundation)?", False),
    ("eupl", "european", "european union public", False),
    ("odbl", "database", "open database", False),
    ("proprietary", "proprietary", "proprietary", False),
]

# Level and phrasing around a name. Level 1 is a grant, 2 a named licence, 3 a bare name.
PHRASINGS = [
    (1, "(?:this work is |this software is |this file is )?(?:licensed|released|distributed|published|available|provided)"
        " under (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[sc]e)?(?: (?:version |v )?[0-9](?: [0-9])?)?"),
    (1, "(?:permission is|rights are) granted under (?:the )?(?:{name})(?: licen[sc]e)?"),
    (1, "spdx licen[sc]e identifier (?:{name})(?: [0-9](?: [0-9])?)?(?: only| or later)?"),
    (1, "subject to the (?:terms (?:and conditions )?of the )?(?:{name})(?: licen[sc]e)?"),
    (2, "(?:{name}) licen[sc]e(?:s|d)?(?: (?:version |v )?[0-9](?: [0-9])?)?"),
    (2, "licen[sc]e (?:is )?(?:{name})"),
]

# Notices that name no licence; level 2.
NOTICES = [
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("public-domain", "domain", "(?:released (?:in)?to|dedicated to|in) the public domain"),
    ("as-is", "warranty", "provided as is without warranty(?: of any kind)?"),
    ("copyleft", "copyleft", "copyleft"),
]
# Signatures written one by one: level, label, keyword (words that every match holds) and
# expression. Level 0 tells what a text is not under: it names no label, but contains others.
SIGNATURES = [
    (0, "", "not", "not (?:licen[sc]ed|released|distributed|published|available|provided|offered|covered) (?:under|by) (?:[^ ]+ ){0,6}?"
                   "(?:licen[sc]es?|expat|mit|apache(?: software)?|bsd|isc|zlib|[al]?gpl(?:v[23])?|mpl|epl|cddl|unlicense|cc by)(?: licen[sc]es?)?"
                   "(?: (?:version |v )?[0-9](?: [0-9])?)?(?: only| or later)?(?: licen[sc]e[sd]?)?"),
    (0, "", "not", "not (?:under|subject to) (?:the |an? |any )?(?:terms of (?:the )?)?(?:mit|apache|bsd|isc|zlib|[al]?gpl(?:v[23])?|gnu general public|mozilla public)"
                   "(?: licen[sc]es?)?(?: (?:version |v )?[0-9](?: [0-9])?)?(?: licen[sc]e[sd]?)?"),
    (0, "", "incompatible with", "incompatible with (?:the )?(?:mit|apache|bsd|isc|zlib|[al]?gpl(?:v[23])?|gnu general public|mozilla public)"
                                 "(?: licen[sc]es?)?(?: (?:version |v )?[0-9](?: [0-9])?)?(?: licen[sc]e[sd]?)?"),
    # MIT, ISC and other short permissive texts
    (1, "mit", "hereby granted", "permission is hereby granted free of charge(?: to any person obtaining a copy of this software and associated documentation files)?"),
    (2, "mit", "substantial portions", "(?:the above|this) copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    (2, "mit", "merge", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    (1, "mit-0", "deal", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    (1, "bsl-1.0", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation(?: covered by this licen[sc]e)?"),
    (1, "ofl-1.1", "font", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    (1, "isc", "hereby granted", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    (1, "hpnd", "its documentation", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and without fee| is hereby granted without fee| with or without fee)"),
    (1, "postgresql", "written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    (2, "hpnd", "supporting documentation", "that both that copyright notice and this permission notice appear in supporting documentation"),
    (2, "isc", "author disclaims", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    (1, "x11", "consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    (1, "ntp", "suitability", "makes no representations about the suitability of this software for any purpose"),
    # BSD
    (1, "bsd", "redistribution", "redistribution and use in source and binary forms(?: with or without modification are permitted)?"),
    (2, "bsd", "redistributions of", "redistributions of source code must retain the above copyright notice"),
    (2, "bsd", "redistributions in", "redistributions in binary form must reproduce the above copyright notice"),
    (2, "bsd-3-clause", "endorse", "neither the names? of [^ ]+(?: [^ ]+){0,12}? may be used to endorse or promote products derived from this software"),
    (2, "bsd-3-clause", "specific prior", "endorse or promote products derived from this software without specific prior written permission"),
    (2, "bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    (2, "bsd-2-clause", "freebsd project", "(?:interpreted as )?representing official policies either expressed or implied of the freebsd project"),
    (2, "bsd-3-clause-clear", "patent rights", "no express or implied licenses to any party s patent rights are granted by this licen[sc]e"),
    (1, "bsd-source-code", "retained", "redistribution of source code must retain the above copyright notice this list of conditions and the following disclaimer retained"),
    # Apache
    (1, "apache-2.0", "compliance with", "you may not use this (?:file|software|work) except in compliance with the licen[sc]e"),
    (1, "apache-2.0", "apache", "licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    (2, "apache-2.0", "apache", "(?:http|https) www apache org licenses licen[sc]e 2 0(?: txt| html)?"),
    (2, "apache-2.0", "conditions of", "distributed on an as is basis without warranties or conditions of any kind"),
    (2, "apache-2.0", "contributor hereby", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[sc]e"),
    (2, "apache-1.1", "apache", "this product includes software developed by the apache (?:software foundation|group)"),
    (2, "apache-1.1", "apache", "products derived from this software may not be called apache"),
    (3, "apache-2.0", "asl", "asl 2 0"),
    # GNU
    (1, "gpl", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    (1, "gpl-2.0", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 2(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (1, "gpl-3.0", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (1, "lgpl", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    (1, "lgpl-2.0", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu library general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 2(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (1, "lgpl-2.1", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 2 1(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (1, "lgpl-3.0", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (1, "agpl", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    (1, "agpl-3.0", "redistribute it", "(?:you can )?redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    (2, "gpl", "received a", "you should have received a copy of the gnu general public licen[sc]e"),
    (2, "lgpl", "received a", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    (2, "agpl", "received a", "you should have received a copy of the gnu affero general public licen[sc]e"),
    (2, "lgpl-2.0", "library general", "(?:gnu )?library general public licen[sc]e(?: (?:version |v )?2(?: 0)?)?"),
    (2, "gfdl", "documentation", "(?:gnu )?free documentation licen[sc]e(?: (?:version |v )?1 [1-3])?"),
    (1, "gfdl", "documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    (2, "gpl-linking-exception", "special exception", "as a special exception (?:the copyright holders of this (?:library|program|software) give you permission to link|you may use this file as part of a free software library without restriction)"),
    (2, "classpath-exception", "classpath", "(?:gpl 2 0 with )?classpath exception(?: 2 0)?"),
    (2, "gpl", "copying", "see the file copying for (?:the )?(?:licen[sc]e|copying conditions|details)"),
    # GNU names and identifiers
    (1, "gpl-2.0", "spdx", "spdx licen[sc]e identifier gpl 2 0(?: only| or later)?"),
    (1, "gpl-3.0", "spdx", "spdx licen[sc]e identifier gpl 3 0(?: only| or later)?"),
    (1, "lgpl-2.0", "spdx", "spdx licen[sc]e identifier lgpl 2 0(?: only| or later)?"),
    (1, "lgpl-2.1", "spdx", "spdx licen[sc]e identifier lgpl 2 1(?: only| or later)?"),
    (1, "lgpl-3.0", "spdx", "spdx licen[sc]e identifier lgpl 3 0(?: only| or later)?"),
    (1, "agpl-3.0", "spdx", "spdx licen[sc]e identifier agpl 3 0(?: only| or later)?"),
    (1, "lgpl", "lgpl", "(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?lgpl"),
    (1, "agpl", "agpl", "(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?agpl"),
    (3, "gpl-2.0", "gpl", "gpl (?:version |v )?2(?: 0)?(?: only| or later)?"),
    (3, "gpl-3.0", "gpl", "gpl (?:version |v )?3(?: 0)?(?: only| or later)?"),
    (3, "gpl-2.0", "gplv2", "gplv2"),
    (3, "gpl-3.0", "gplv3", "gplv3"),
    (3, "lgpl-2.0", "lgpl", "lgpl (?:version |v )?2(?: 0)?(?: only| or later)?"),
    (3, "lgpl-2.1", "lgpl", "lgpl (?:version |v )?2 1(?: only| or later)?"),
    (3, "lgpl-2.1", "lgplv2", "lgplv2 1"),
    (3, "lgpl-3.0", "lgpl", "lgpl (?:version |v )?3(?: 0)?(?: only| or later)?"),
    (3, "lgpl-3.0", "lgplv3", "lgplv3"),
    (3, "agpl-3.0", "agpl", "agpl (?:version |v )?3(?: 0)?(?: only| or later)?"),
    (3, "agpl-3.0", "agplv3", "agplv3"),
    (3, "agpl", "agpl", "(?:gnu )?agpl"),
    (3, "lgpl", "lgpl", "(?:gnu )?lgpl"),
    (3, "gpl", "gpl", "gnu gpl"),
    # Mozilla, Eclipse and other file-based copyleft
    (1, "mpl-2.0", "subject to", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    (2, "mpl-2.0", "mozilla", "if a copy of the mpl was not distributed with this file you can obtain one at (?:http|https) mozilla org mpl 2 0"),
    (1, "mpl-1.1", "contents of", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    (1, "mpl-2.0", "spdx", "spdx licen[sc]e identifier mpl 2 0"),
    (3, "mpl-2.0", "mpl", "mpl (?:version |v )?2(?: 0)?"),
    (3, "mpl-1.1", "mpl", "mpl (?:version |v )?1 1"),
    (1, "epl-2.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v(?:ersion)? 2 0"),
    (1, "epl-1.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v(?:ersion)? 1 0"),
    (1, "epl-2.0", "spdx", "spdx licen[sc]e identifier epl 2 0"),
    (1, "epl-1.0", "spdx", "spdx licen[sc]e identifier epl 1 0"),
    (3, "epl-2.0", "epl", "epl (?:version |v )?2(?: 0)?"),
    (3, "epl-1.0", "epl", "epl (?:version |v )?1(?: 0)?"),
    (1, "cddl", "contents of", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    (3, "cddl", "cddl", "cddl (?:version |v )?1 [01]"),
    (2, "cpl-1.0", "common", "common public licen[sc]e(?: (?:version |v )?1(?: 0)?)?"),
    (2, "osl-3.0", "open", "open software licen[sc]e(?: (?:version |v )?3(?: 0)?)?"),
    (2, "afl-3.0", "academic", "academic free licen[sc]e(?: (?:version |v )?3(?: 0)?)?"),
    (2, "ms-pl", "microsoft", "microsoft public licen[sc]e(?: ms pl)?"),
    (2, "ms-rl", "microsoft", "microsoft reciprocal licen[sc]e(?: ms rl)?"),
    (2, "eupl-1.2", "european", "european union public licen[sc]e (?:version |v )?1 2"),
    (3, "eupl-1.2", "eupl", "eupl (?:version |v )?1 2"),
    (2, "ecl-2.0", "educational", "educational community licen[sc]e(?: (?:version |v )?2(?: 0)?)?"),
    (2, "upl-1.0", "permissive", "universal permissive licen[sc]e(?: (?:version |v )?1(?: 0)?)?"),
    (2, "ncsa", "illinois", "university of illinois(?: ncsa)? open source licen[sc]e"),
    (2, "cecill", "cecill", "cecill(?: [bc])? licen[sc]e(?: agreement)?"),
    # zlib, public domain and other short ones
    (1, "zlib", "held liable", "in no event will the authors? be held liable for any damages arising from the use of this software"),
    (2, "zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    (2, "zlib", "plainly marked", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    (1, "unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    (2, "unlicense", "anyone is", "anyone is free to copy modify publish use compile sell or distribute this software"),
    (1, "cc0", "waived", "to the extent possible under law [^ ]+(?: [^ ]+){0,10}? has waived all copyright and related or neighboring rights"),
    (1, "cc0", "spdx", "spdx licen[sc]e identifier cc0 1 0"),
    (2, "cc0", "publicdomain", "creativecommons org publicdomain zero 1 0"),
    (2, "cc-by", "creativecommons", "creativecommons org licenses by [1-4] [05]"),
    (2, "cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] [05]"),
    (2, "cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] [05]"),
    (2, "cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] [05]"),
    (2, "cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] [05]"),
    (2, "cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] [05]"),
    (2, "cc-by", "commons", "creative commons attribution [1-4] [05] international(?: public)? licen[sc]e"),
    (2, "cc-by-sa", "commons", "creative commons attribution share(?: )?alike [1-4] [05] international(?: public)? licen[sc]e"),
    (2, "cc-by-nc", "commons", "creative commons attribution non(?: )?commercial [1-4] [05] international(?: public)? licen[sc]e"),
    (2, "cc-by-nc-sa", "commons", "creative commons attribution non(?: )?commercial share(?: )?alike [1-4] [05] international(?: public)? licen[sc]e"),
    (2, "cc-by-nc-nd", "commons", "creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s [1-4] [05] international(?: public)? licen[sc]e"),
    (1, "wtfpl", "what the", "do what the f[^ ]* you want to public licen[sc]e"),
    (2, "beerware", "ware", "(?:the )?beer ware licen[sc]e"),
    (2, "beerware", "beerware", "(?:the )?beerware licen[sc]e"),
    (1, "beerware", "whatever you", "as long as you retain this notice you can do whatever you want with this stuff"),
    (1, "public-domain", "placed", "(?:is )?(?:hereby )?placed in the public domain"),
    (1, "public-domain", "disclaims", "the author hereby disclaims copyright to this source code"),
    (2, "public-domain", "blessing", "the author disclaims copyright to this source code in place of a legal notice here is a blessing"),
    (1, "ofl-1.1", "font", "this font software is licensed under the sil open font licen[sc]e version 1 1"),
    (3, "ofl-1.1", "ofl", "ofl (?:version |v )?1 1"),
    (2, "artistic", "copyright holder", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains"),
    (1, "artistic", "perl", "(?:you can )?redistribute it and or modify it under the same terms as perl itself"),
    (1, "ruby", "ruby", "(?:you can )?redistribute it and or modify it under the same terms as ruby(?: itself)?"),
    (2, "ruby", "ruby", "ruby licen[sc]e"),
    (2, "php-3.01", "php", "php licen[sc]e (?:version |v )?3 01"),
    (2, "php-3.01", "php", "this product includes php software freely available from"),
    (2, "openssl", "openssl", "this product includes software developed by the openssl project"),
    (2, "openssl", "openssl", "openssl licen[sc]e"),
    (2, "python-2.0", "psf", "psf licen[sc]e agreement(?: for python)?(?: 2(?: [0-9])?)?"),
    (2, "odbl", "odbl", "odbl(?: (?:version |v )?1(?: 0)?)? licen[sc]e"),
    (2, "odc-by", "commons", "open data commons attribution licen[sc]e"),
    (2, "pddl", "commons", "open data commons public domain dedication and licen[sc]e"),
    (2, "json", "evil", "the software shall be used for good not evil"),
    (2, "lppl", "latex", "latex project public licen[sc]e(?: (?:version |v )?1 3[ac]?)?"),
    (2, "vim", "vim", "vim licen[sc]e"),
    (2, "curl", "curl", "curl licen[sc]e"),
    (2, "0bsd", "0bsd", "(?:licen[sc]e )?0bsd(?: licen[sc]e)?"),
    (2, "bsd-0-clause", "zero clause", "zero clause bsd licen[sc]e"),
    # source-available and closed
    (1, "busl-1.1", "business source", "(?:licensed under (?:the )?)?business source licen[sc]e (?:version |v )?1 1"),
    (2, "sspl-1.0", "server side", "server side public licen[sc]e(?: (?:version |v )?1)?"),
    (2, "elastic-2.0", "elastic", "elastic licen[sc]e (?:version |v )?2(?: 0)?"),
    (2, "commons-clause", "commons clause", "commons clause licen[sc]e condition(?: (?:version |v )?1 0)?"),
    (2, "polyform", "polyform", "polyform (?:noncommercial|strict|small business|shield|perimeter) licen[sc]e(?: 1 0 0)?"),
    (2, "openrail", "rail", "(?:creativeml )?open rail(?: [m+])? licen[sc]e"),
    (1, "proprietary", "confidential", "(?:this (?:software|file|document) (?:is|contains) )?(?:confidential and proprietary|proprietary and confidential)(?: information)?"),
    (1, "proprietary", "prohibited", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|work)(?: via any medium)? is strictly prohibited"),
    (2, "proprietary", "prior written", "no part of this (?:publication|document|work|book) may be reproduced(?: stored| distributed)?(?: [^ ]+){0,20}? without (?:the )?prior written permission"),
    (2, "proprietary", "personal", "for personal(?: and| or)? non commercial use only"),
    (1, "proprietary", "end user", "end user licen[sc]e agreement"),
    (2, "as-is", "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose"),
]
LEVEL_WEIGHTS = {0: 0.0, 1: 1.0, 2: 0.8, 3: 0.5}


# A text that holds none of these (any case) can match no rule and no phrase.
TRIGGERS = ["licen", "spdx", "reserved", "copyleft", "warrant", "domain", "cc0", "wtfpl", "commons", "released",
            "distribut", "published", "available", "provided", "granted", "subject", "gpl", "permission", "notice",
            "waived", "0bsd", "disclaim", "suitability", "endorse", "advertising", "freebsd", "apache", "classpath", "openssl",
            "copying", "copyright", "liable", "misrepresented", "evil", "confidential", "prohibited", "commercial", "exception"]
# lower case: a Creative Commons code standing alone, short names with a version
TRIGGER_CODE = "(?:cc[^a-z0-9]+by|(?:mpl|epl|cddl|asl|ofl|eupl)[^a-z0-9]+[v0-9])"

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rules() -> list[tuple[int, int, str, str, str]]:
    """(order, level, label, keyword, regex): the signatures, each licence in each phrasing, then names
    that say enough alone, then the notices. The expressions run on words that each stand between two
    spaces of their own (``" a  b "``), so they match whole words only, without look-around."""
    table = list(SIGNATURES)
    table += [(level, label, key, form.format(name=name))
              for label, key, name, _ in LICENSES for level, form in PHRASINGS]
    table += [(3, label, key, name) for label, key, name, alone in LICENSES if alone]
    table += [(2, label, key, regex) for label, key, regex in NOTICES]
    return [(i, level, label, f" {key} ".replace(" ", "  ")[1:-1], " (?:" + regex.replace(" ", "  ") + ") ")
            for i, (level, label, key, regex) in enumerate(table)]


def gated(text: Column) -> Column:
    def found(low: Column) -> Column:
        return reduce(or_, [F.contains(low, F.lit(word)) for word in TRIGGERS], low.rlike(TRIGGER_CODE))

    return let(F.lower(text), found)


def word_count(text: Column) -> Column:
    parts = F.split(text, SEPARATORS)
    return (F.size(parts) - F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
            - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


def lower_words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def phrase_starts(w: Column, phrase: str) -> Column:
    """Word numbers where the phrase's words stand consecutively (found by its last word)."""
    p = phrase.split()

    def fits(i: Column) -> Column:
        ok = F.lit(True)
        for k, word in enumerate(p[:-1]):
            ok = ok & (F.get(w, i - (len(p) - 1 - k)) == word)
        return F.coalesce(ok, F.lit(False))

    ends = F.filter(F.transform(w, lambda x, i: F.when(x == p[-1], i)), lambda i: i.isNotNull())
    return F.transform(F.filter(ends, fits), lambda i: i - (len(p) - 1))


def spans(spaced: Column, regex: Column) -> Column:
    """Word intervals [a, b) of the matches, counted from the texts between and of them."""
    def n_words(s: Column) -> Column:
        return F.shiftright(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))), 1)

    found = F.regexp_extract_all(spaced, regex, F.lit(0))
    steps = F.zip_with(F.slice(F.split(spaced, regex), F.lit(1), F.size(found)), found,
                       lambda p, m: F.struct(n_words(p).alias("gap"), n_words(m).alias("len")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        a = s["at"] + x["gap"]
        return F.struct((a + x["len"]).alias("at"),
                        F.concat(s["out"], F.array(F.struct(a.alias("a"), (a + x["len"]).alias("b")))).alias("out"))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def detections(docs: DataFrame, text: str = "text", table: list[tuple] | None = None) -> DataFrame:
    """Every rule match: _id, _key, rule, level, label, a, b (word interval [a, b))."""
    table = rules() if table is None else table
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.filter(gated(t)).select(
        F.col("doc_id").alias("_id"), text_key(F.col(text)).alias("_key"),
        F.concat(F.lit(" "), F.array_join(lower_words(t), "  "), F.lit(" ")).alias("_s"))
    listed = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("rule", "level", "label", "key", "regex"), r)])
                       for r in table])
    run = d.select("_id", "_key", "_s", F.inline(F.filter(listed, lambda r: F.contains(F.col("_s"), r["key"]))))
    return run.select("_id", "_key", "rule", "level", "label", F.inline(spans(F.col("_s"), F.col("regex"))))


def surviving(found: DataFrame) -> DataFrame:
    """Detections whose interval lies in no other one of the same or a better level.

    Sorted by start, longest first, then level and rule, all containers of a detection
    stand before it; it is contained if one of them ends no earlier."""
    before = (Window.partitionBy("_id", "_key").orderBy("a", F.desc("b"), "level", "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    best = {n: F.max(F.when(F.col("level") <= n, F.col("b"))).over(before) for n in LEVEL_WEIGHTS}
    reach = F.coalesce(*[F.when(F.col("level") == n, e) for n, e in best.items()], F.lit(-1))
    return found.withColumn("_reach", reach).filter(F.col("_reach") < F.col("b")).drop("_reach")


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs``."""
    t = F.coalesce(F.col(text), F.lit(""))

    def labelled(w: Column, phrase: str, label: str) -> Column:
        return F.transform(phrase_starts(w, phrase), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    places = let(lower_words(t), lambda w: F.flatten(F.array(*[labelled(w, p, label) for p, label in PHRASES])))
    none = F.array().cast("array<struct<at:int,label:string>>")
    base = docs.select(F.col("doc_id").alias("_id"), text_key(F.col(text)).alias("_key"), word_count(t).alias("n_words"),
                       F.when(gated(t), places).otherwise(none).alias("_base"))
    weight = F.coalesce(*[F.when(F.min("level") == n, w) for n, w in LEVEL_WEIGHTS.items()])
    per = (surviving(detections(docs, text)).filter("level > 0").groupBy(F.col("_id").alias("_rid"), F.col("_key").alias("_rkey"))
           .agg(F.collect_set("label").alias("_more"), weight.alias("_weight")))
    j = base.join(per, base["_id"].eqNullSafe(per["_rid"]) & (base["_key"] == per["_rkey"]), "left")
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda e: e["label"])))
    labels = F.array_sort(F.array_union(F.transform("_base", lambda e: e["label"]),
                                        F.coalesce("_more", F.array().cast("array<string>"))))
    least = F.when(F.size("_base") > 0, LEVEL_WEIGHTS[3]).otherwise(0.0)
    starts = F.transform("_base", lambda e: e["at"].cast("long"))
    return j.select(F.col("_id").alias("doc_id"), "n_words", F.size("_base").cast("long").alias("n_base"),
                    F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                    F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                    F.greatest(F.coalesce("_weight", F.lit(0.0)), least).alias("score"))
