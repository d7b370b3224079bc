"""The signature rules of the license scan.

A rule is (label, priority, keyword, pattern, weight). Patterns are written for normalised text: lower case, words of
letters and digits, single blanks. The keyword must occur for the pattern to be tried. Among detections, one that
lies within another of the same or a higher priority (a smaller number) is suppressed.
"""

#: Families: label, keyword, the ways its name is written. Versions follow as "v2", "version 2 0", "2 0" and so on.
NAMES = (
    ("mit", "mit", "mit(?: expat)?"),
    ("expat", "expat", "expat"),
    ("isc", "isc", "isc"),
    ("apache-1", "apache", "apache(?: software)?(?: foundation)?(?: license)? (?:v|version )?1(?: [01])?"),
    ("apache-2", "apache", "apache(?: software)?(?: foundation)?(?: license)? (?:v|version )?2(?: 0)?"),
    ("bsd-2", "bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)"),
    ("bsd-3", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    ("bsd-4", "bsd", "(?:original bsd|old bsd|bsd 4 clause|4 clause bsd|four clause bsd)"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("gpl-1", "g", "(?:gnu (?:general public|gpl)|gpl)(?: license)? ?(?:v|version )?1(?: 0)?"),
    ("gpl-2", "g", "(?:gnu (?:general public|gpl)|gpl)(?: license)? ?(?:v|version )?2(?: 0)?"),
    ("gpl-3", "g", "(?:gnu (?:general public|gpl)|gpl)(?: license)? ?(?:v|version )?3(?: 0)?"),
    ("lgpl-2", "l", "(?:gnu (?:lesser|library) general public|lgpl)(?: license)? ?(?:v|version )?2(?: [01])?"),
    ("lgpl-3", "l", "(?:gnu lesser general public|lgpl)(?: license)? ?(?:v|version )?3(?: 0)?"),
    ("agpl-3", "a", "(?:gnu affero general public|affero gpl|agpl)(?: license)? ?(?:v|version )?3(?: 0)?"),
    ("gfdl", "gnu", "gnu free documentation"),
    ("mpl-1", "m", "(?:mozilla public|mpl)(?: license)? ?(?:v|version )?1(?: [01])?"),
    ("mpl-2", "m", "(?:mozilla public|mpl)(?: license)? ?(?:v|version )?2(?: 0)?"),
    ("epl-1", "e", "(?:eclipse public|epl)(?: license)? ?(?:v|version )?1(?: 0)?"),
    ("epl-2", "e", "(?:eclipse public|epl)(?: license)? ?(?:v|version )?2(?: 0)?"),
    ("eupl", "e", "(?:european union public|eupl)(?: license)?(?: (?:v|version )?1(?: [0-2])?)?"),
    ("cddl", "c", "(?:common development and distribution|cddl)(?: license)?(?: (?:v|version )?1(?: [01])?)?"),
    ("cpl", "common", "common public"),
    ("cecill", "cecill", "cecill(?: [abc])?"),
    ("artistic", "artistic", "(?:perl )?artistic(?: license)?(?: (?:v|version )?[12](?: 0)?)?"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("libpng", "libpng", "libpng"),
    ("boost", "boost", "boost(?: software)?(?: license)?(?: (?:v|version )?1(?: 0)?)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "w", "(?:wtfpl|do what the f[a-z]* you want to(?: public)?)"),
    ("python", "p", "(?:python software foundation|psf|python)"),
    ("php", "php", "php"),
    ("ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ofl", "o", "(?:sil open font|open font|ofl)"),
    ("odbl", "o", "(?:open database|odbl|odc odbl)"),
    ("odc-by", "o", "(?:open data commons attribution|odc by)"),
    ("ms-pl", "m", "(?:microsoft public|ms pl)"),
    ("ms-rl", "m", "(?:microsoft reciprocal|ms rl)"),
    ("upl", "u", "(?:universal permissive|upl)(?: license)?(?: (?:v|version )?1(?: 0)?)?"),
    ("bsl", "b", "(?:business source|busl|bsl)(?: license)?(?: (?:v|version )?1(?: 1)?)?"),
    ("sspl", "s", "(?:server side public|sspl)"),
    ("elastic", "elastic", "elastic(?: license)?(?: (?:v|version )?2(?: 0)?)?"),
    ("json", "json", "json"),
    ("ncsa", "n", "(?:university of illinois ncsa|ncsa)"),
    ("cc0", "c", "(?:cc0|creative commons zero|cc zero)(?: (?:v|version )?1(?: 0)?)?"),
    ("cc-by-nc-nd", "c", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|noderivs|no derivatives)"),
    ("cc-by-nc-sa", "c", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)"),
    ("cc-by-nc", "c", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)"),
    ("cc-by-nd", "c", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|noderivs|no derivatives)"),
    ("cc-by-sa", "c", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)"),
    ("cc-by", "c", "(?:cc|creative commons) (?:by|attribution)"),
)

#: Families named without a version or clause count. Their rules come last, so that any telling name around them stands alone.
GENERIC = (
    ("gpl", "g", "(?:(?:gnu )?general public|gnu gpl|gpl)"),
    ("lgpl", "l", "(?:(?:gnu )?(?:lesser|library) (?:general public|gpl)|(?:gnu )?lgpl)"),
    ("agpl", "a", "(?:(?:gnu )?affero (?:general public|gpl)|(?:gnu )?agpl)"),
    ("mpl", "m", "(?:mozilla public|mozilla|mpl)"),
    ("epl", "e", "(?:eclipse public|eclipse|epl)"),
    ("bsd", "bsd", "bsd"),
    ("apache", "apache", "apache(?: software)?(?: foundation)?"),
    ("cc", "c", "(?:cc|creative commons)"),
)
#: The priority of those rules.
LAST = 4

#: The ways a license is granted, from the most to the least telling: name, priority, weight, keyword, pattern around %s.
GRANTS = (
    ("licensed", 1, 0.95, "licensed", "(?:is |are )?(?:dual |re )?licensed (?:under|with|by) (?:the )?(?:terms of the )?%s(?: licen[cs]e)?(?: (?:v|version )?[0-9](?: [0-9])?)?"),
    ("terms", 1, 0.9, "under", "(?:released|distributed|available|published|provided|redistributed|used) under (?:the )?(?:terms of )?(?:the )?%s(?: licen[cs]e)?(?: (?:v|version )?[0-9](?: [0-9])?)?"),
    ("tag", 1, 1.0, "spdx", "spdx license identifier %s(?: only| or later)?"),
    ("named", 2, 0.8, "licen", "%s(?: public| software)? licen[cs]e(?: (?:v|version )?[0-9](?: [0-9])?)?"),
    ("field", 3, 0.6, "licen", "licen[cs]e %s"),
    # "python licensed under" names what is licensed.
    ("adjective", 3, 0.6, "licensed", "%s licen[cs]ed(?! (?:under|with|by|to|for|from) )"),
)

#: Wording of license texts and notices themselves.
TEXTS = (
    ("mit", 1, 0.9, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, 0.9, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 1, 0.9, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", 2, 0.7, "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4", 2, 0.7, "advertising", "all advertising materials mentioning features or use of this software"),
    ("zlib", 1, 0.9, "warranty", "this software is provided as is without any express or implied warranty"),
    ("apache-2", 1, 0.9, "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", 1, 0.9, "free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", 2, 0.8, "gnu general", "gnu general public licen[cs]e"),
    ("lgpl", 2, 0.8, "gnu l", "gnu (?:lesser|library) general public licen[cs]e"),
    ("agpl", 2, 0.8, "affero", "(?:gnu )?affero general public licen[cs]e"),
    ("mpl-2", 1, 0.9, "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", 1, 0.9, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", 2, 0.7, "public domain", "(?:in|into|to) the public domain"),
    ("proprietary", 2, 0.6, "all rights", "all rights reserved"),
    ("warranty", 3, 0.3, "warranty", "(?:without|no) warranty(?: of any kind)?"),
    ("boost", 1, 0.9, "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("cc-by", 2, 0.8, "creativecommons", "creativecommons org licenses by [0-9]"),
    ("cc-by-sa", 2, 0.8, "creativecommons", "creativecommons org licenses by sa"),
    ("cc-by-nc", 2, 0.8, "creativecommons", "creativecommons org licenses by nc"),
    ("cc0", 2, 0.8, "creativecommons", "creativecommons org publicdomain zero"),
)

#: Phrases whose every place is reported, whatever else is found there.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)


def rules():
    """All rules as (label, priority, keyword, pattern, weight), in order of priority."""
    made = [(label, p, word, text, weight) for label, p, weight, word, text in TEXTS]
    for label, keyword, name in NAMES:
        for _, p, weight, word, around in GRANTS:
            # The longer of the two keywords is the rarer one.
            made.append((label, p, max(keyword, word, key=len), around % name, weight))
    for label, keyword, name in GENERIC:
        for _, _, weight, word, around in GRANTS:
            made.append((label, LAST, max(keyword, word, key=len), around % name, weight))
    return sorted(made, key=lambda r: r[1])
