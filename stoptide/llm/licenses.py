"""License scans by ordered signature rules (DataFrame functions only).

A text is looked at closely only if a keyword stands in it. Its words are joined by single spaces
and each rule whose own keyword occurs is run as a regular expression over them. Rules are sentences
of license texts and notices, and the forms in which a license is named. A detection inside a longer
or more trusted one is suppressed: rules rank by form (an identifier line over a license's own words
and a notice over an address over a mention over a bare name), then by order in the table. Starts of
detections are running sums, and what is suppressed follows from running maxima over detections in
order, both by steps that reach four times as far each, so the work grows with a text's length, not with its square.

Defined results: null or empty text has no words and no labels; a null doc_id stays null; repeated
rows are scanned each on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import lower_ascii, read_table

#: What separates words: ASCII other than digits and letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The phrases of the base scan and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Label, the license's name as a pattern over lower-case words, SPDX id.
FAMILIES = (
    ("mit", r"mit(?: x11)?|expat|massachusetts institute of technology", "mit"),
    ("apache-2", r"apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", r"apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    ("gpl-3", r"(?:gnu )?(?:gpl|general public license)(?: as published by the free software foundation)?(?: either)?(?: version)? ?v?3(?: 0)?", "gpl 3 0"),
    ("gpl-2", r"(?:gnu )?(?:gpl|general public license)(?: as published by the free software foundation)?(?: either)?(?: version)? ?v?2(?: 0)?", "gpl 2 0"),
    ("gpl-1", r"(?:gnu )?(?:gpl|general public license)(?: version)? ?v?1(?: 0)?", "gpl 1 0"),
    ("gpl", r"gnu general public license|gnu gpl|gpl", "gpl"),
    ("lgpl-3", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?v?3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?v?2 1", "lgpl 2 1"),
    ("lgpl-2", r"(?:gnu )?(?:lgpl|library general public license)(?: version)? ?v?2(?: 0)?", "lgpl 2 0"),
    ("agpl-3", r"(?:gnu )?(?:agpl|affero general public license)(?: version)? ?v?3(?: 0)?", "agpl 3 0"),
    ("gfdl", r"gnu free documentation license(?: version)?(?: 1 [123])?", "gfdl 1 3"),
    ("mpl-2", r"mozilla public license(?: version)? v?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", r"mozilla public license(?: version)? v?1 1", "mpl 1 1"),
    ("bsd-2-clause", r"bsd 2 clause|simplified bsd|freebsd", "bsd 2 clause"),
    ("bsd-3-clause", r"bsd 3 clause|new bsd|modified bsd|revised bsd", "bsd 3 clause"),
    ("bsd-4-clause", r"bsd 4 clause|original bsd", "bsd 4 clause"),
    ("0bsd", r"zero clause bsd|bsd zero clause", "0bsd"),
    ("bsd", r"bsd|berkeley software distribution", "bsd"),
    ("isc", r"isc|internet systems consortium", "isc"),
    ("epl-2", r"eclipse public license(?: version)? v?2(?: 0)?", "epl 2 0"),
    ("epl-1", r"eclipse public license(?: version)? v?1(?: 0)?", "epl 1 0"),
    ("cddl", r"common development and distribution license(?: version)?(?: 1 [01])?", "cddl 1 0"),
    ("cpl", r"common public license(?: version)?(?: 1 0)?", "cpl 1 0"),
    ("eupl", r"european union public licen[sc]e(?: version)?(?: 1 [012])?", "eupl 1 2"),
    ("artistic-2", r"artistic license(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("artistic-1", r"artistic license(?: version)? 1(?: 0)?", "artistic 1 0"),
    ("ofl", r"(?:sil )?open font license(?: version)?(?: 1 [01])?", "ofl 1 1"),
    ("bsl-1", r"boost software license(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("busl", r"business source license(?: version)?(?: 1 1)?", "busl 1 1"),
    ("zlib", r"zlib(?: libpng)?", "zlib"),
    ("unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", r"do what the fuck you want to public license", "wtfpl"),
    ("psf-2", r"python software foundation license(?: version)?(?: 2)?", "psf 2 0"),
    ("ruby", r"ruby", "ruby"),
    ("openssl", r"openssl", "openssl"),
    ("postgresql", r"postgresql", "postgresql"),
    ("vim", r"vim", "vim"),
    ("curl", r"curl", "curl"),
    ("ncsa", r"university of illinois(?: ncsa)?(?: open source)?", "ncsa"),
    ("upl", r"universal permissive license(?: version)?(?: 1 0)?", "upl 1 0"),
    ("ms-pl", r"microsoft public license", "ms pl"),
    ("ms-rl", r"microsoft reciprocal license", "ms rl"),
    ("odbl", r"open database license(?: version)?(?: 1 0)?", "odbl 1 0"),
    ("odc-by", r"open data commons attribution license(?: version)?(?: 1 0)?", "odc by 1 0"),
    ("pddl", r"open data commons public domain dedication(?: and license)?", "pddl 1 0"),
    ("cc0", r"cc0(?: 1 0)?|creative commons zero", "cc0 1 0"),
    ("cc-by-nc-nd", r"(?:cc|creative commons) (?:by nc nd|attribution noncommercial noderiv(?:ative)?s)(?: [1234] [05])?", "cc by nc nd 4 0"),
    ("cc-by-nc-sa", r"(?:cc|creative commons) (?:by nc sa|attribution noncommercial sharealike)(?: [1234] [05])?", "cc by nc sa 4 0"),
    ("cc-by-nc", r"(?:cc|creative commons) (?:by nc|attribution non ?commercial)(?: [1234] [05])?", "cc by nc 4 0"),
    ("cc-by-nd", r"(?:cc|creative commons) (?:by nd|attribution noderiv(?:ative)?s)(?: [1234] [05])?", "cc by nd 4 0"),
    ("cc-by-sa", r"(?:cc|creative commons) (?:by sa|attribution sharealike)(?: [1234] [05])?", "cc by sa 4 0"),
    ("cc-by", r"(?:cc|creative commons) (?:by|attribution)(?: [1234] [05])?", "cc by 4 0"),
    ("proprietary", r"all rights reserved", "proprietary"),
)

#: The forms a detection takes, most trusted first: rank, words before, words after.
FORMS = (
    (5, r"spdx license identifier (?:{spdx})", "spdx"),
    (4, r"(?:(?:re)?licen[sc]ed|released|distributed|published|available|provided|covered) (?:to you )?(?:only )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: licen[sc]e)?(?: version)?", "under"),
    (4, r"(?:subject to|governed by|conditions of|terms of) (?:the )?(?:{name})(?: licen[sc]e)?", ""),
    (3, r"(?:opensource org|spdx org|gnu org|creativecommons org|choosealicense com) licen[sc]es (?:{spdx})", "org|com"),
    (2, r"(?:{name}) licen[sc]ed?", "licen"),
)
#: Families whose name is a plain word or another thing's: it names a license only where that word follows.
PLAIN_NAMES = ("ruby", "openssl", "postgresql", "vim", "curl", "zlib", "ncsa")
#: Families whose bare name is a mention by itself: it can hardly mean anything else.
BARE = ("apache-2", "gpl-3", "gpl-2", "lgpl-3", "lgpl-2.1", "agpl-3", "mpl-2", "mpl-1.1", "bsd-2-clause", "bsd-3-clause", "epl-2", "epl-1", "eupl", "cddl", "ofl", "odbl", "cc0", "cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd", "unlicense", "proprietary")
#: Label and a sentence, or part of one, of the license's text or of its usual notice, as
#: a pattern over lower-case words.
SIGNATURES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit-0", r"mit no attribution(?: license)?|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", r"neither the names? of (?:the )?(?:copyright holder|\S+(?: \S+){0,5}) nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", r"this software is provided by the (?:copyright holders and contributors|regents and contributors|authors?) as is and any express or implied warranties"),
    ("bsd-2-clause-patent", r"bsd 2 clause plus patent license|each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-2", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("apache-2", r"you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("apache-1.1", r"the names apache and apache software foundation must not be used to endorse or promote products derived from this software"),
    ("gpl-2+", r"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3+", r"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program"),
    ("gpl", r"see the gnu general public license for more details"),
    ("gpl", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-2", r"gnu general public license version 2 june 1991"),
    ("gpl-3", r"gnu general public license version 3 29 june 2007"),
    ("gpl-3", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2", r"you may copy and distribute verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl-3", r"you may convey verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl-3", r"conveying under any other circumstances is permitted solely under the conditions stated below sublicensing is not allowed"),
    ("gpl-classpath", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-autoconf", r"you may (?:include|distribute) (?:it|that program) under the same distribution terms that you use for the rest of that program"),
    ("gpl-font", r"as a special exception if you create a document which uses this font and embed this font or unaltered portions of this font"),
    ("lgpl-2.1+", r"free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3+", r"free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2+", r"free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license along with this (?:library|program)"),
    ("lgpl", r"see the gnu lesser general public license for more details"),
    ("lgpl-2.1", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl-3+", r"free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3", r"the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software"),
    ("agpl-3", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl-1", r"affero general public license version 1 march 2002"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts a copy of the license is included"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file"),
    ("mpl-2", r"this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance"),
    ("mpl-1.1", r"alternatively the contents of this file may be used under the terms of either the gnu general public license version 2 or later"),
    ("npl-1.1", r"the contents of this file are subject to the netscape public license version 1 1"),
    ("epl-1", r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("epl-2", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0"),
    ("epl-1", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", r"this source code may also be made available under the following secondary licenses when the conditions for such availability"),
    ("cpl", r"the accompanying program is provided under the terms of this common public license agreement"),
    ("ipl-1", r"the accompanying program is provided under the terms of this ibm public license agreement"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", r"you can obtain a copy of the license at usr src opensolaris license or"),
    ("eupl", r"licensed under the eupl(?: version)?(?: 1 [012])?"),
    ("artistic-1", r"the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("perl", r"you can redistribute it and or modify it under the same terms as perl itself|licensed under the same terms as perl"),
    ("ofl", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl", r"the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself|permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("bsl-1", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1", r"distributed under the boost software license version 1 0 see accompanying file license 1 0 txt"),
    ("busl", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", r"server side public license(?: version 1)?(?: october 16 2018)?|if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available"),
    ("elastic-2", r"elastic license(?: version)? 2(?: 0)?|you may not provide the software to third parties as a hosted or managed service where the service provides users with access to any substantial set of the features or functionality of the software"),
    ("commons-clause", r"commons clause license condition|the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict|free trial|internal use) license(?: 1 0 0)?"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed"),
    ("libpng", r"the png reference library is supplied as is the contributing authors and group 42 inc disclaim all warranties|permission is hereby granted to use copy modify and distribute this source code or portions hereof for any purpose without fee subject to the following restrictions"),
    ("ijg", r"this software is based in part on the work of the independent jpeg group|permission is hereby granted to use copy modify and distribute this software or portions thereof for any purpose without fee subject to these conditions"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff|beer ?ware license(?: revision 42)?"),
    ("cc0", r"to the extent possible under law (?:the author|the authors|the person who associated cc0|\S+(?: \S+){0,4}) (?:has|have|has or have) (?:dedicated|waived) all copyright and related (?:and|or) neighboring rights"),
    ("cc-by", r"you are free to share copy and redistribute the material in any medium or format(?: and)? adapt remix transform and build upon the material for any purpose even commercially"),
    ("cc-by", r"this work is licensed under (?:a|the) creative commons attribution(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-sa", r"this work is licensed under (?:a|the) creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nd", r"this work is licensed under (?:a|the) creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc-sa", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc-nd", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-pdm", r"this work (?:has been identified as being free of known restrictions under copyright law|is free of known copyright restrictions)(?: including all related and neighboring rights)?"),
    ("public-domain", r"released into the public domain(?: without any warranty)?|dedicated to the public domain by (?:its|the) authors?|this software is in the public domain"),
    ("sqlite-blessing", r"the author disclaims copyright to this source code in place of a legal notice here is a blessing"),
    ("psf-2", r"python software foundation psf and the individual or organization licensee accessing and otherwise using|psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices"),
    ("php-3", r"this source file is subject to version 3(?: 01| 0| 1)? of the php license|this product includes php software freely available from"),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", r"this product includes cryptographic software written by eric young|the implementation was written so as to conform with netscapes ssl copyright"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", r"permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appear in all copies"),
    ("x11", r"except as contained in this notice the names? of (?:the )?(?:x consortium|\S+(?: \S+){0,4}) shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("curl", r"except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("vim", r"vim is charityware you can use and copy it as much as you like|there are no restrictions on distributing unmodified copies of vim except that they must include this license text"),
    ("icu", r"icu license icu 1 8 1 and later|unicode inc license agreement data files and software copyright"),
    ("unicode", r"permission is hereby granted free of charge to any person obtaining a copy of (?:the unicode data files|data files)(?: and any associated documentation)?"),
    ("ncsa", r"university of illinois ncsa open source license|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("llvm-exception", r"apache license v2 0 with llvm exceptions?|as an exception if as a result of your compiling your source code portions of this software are embedded into an object form"),
    ("w3c", r"this work is being provided by the copyright holders under the following license|w3c software notice and (?:document )?license"),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license if you do not accept the license do not use the software"),
    ("upl", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("odbl", r"made available under the open database license|any rights in individual contents of the database are licensed under the database contents license"),
    ("odc-by", r"made available under the open data commons attribution license"),
    ("pddl", r"made available under the public domain dedication and license v1 0"),
    ("ogl-uk", r"contains public sector information licensed under the open government licen[sc]e(?: v(?:ersion )?[123](?: 0)?)?"),
    ("afl-3", r"licensed under the academic free license version 3 0|academic free license(?: version)?(?: v)?(?: ?3(?: 0)?)?"),
    ("osl-3", r"licensed under the open software license version 3 0|open software license(?: version)?(?: v)?(?: ?3(?: 0)?)?"),
    ("qpl", r"q public license(?: version)?(?: 1 0)?|you may not distribute your modifications under this license unless also permission is granted to the initial developer to distribute your modification"),
    ("sleepycat", r"redistributions in any form must be accompanied by information on how to obtain complete source code for the db software"),
    ("jsonlic", r"the software shall be used for good not evil"),
    ("ecl-2", r"licensed under the educational community license version 2 0|educational community license(?: version)?(?: v)? ?2(?: 0)?"),
    ("cecill", r"governed by the cecill(?: [bc])? license under french law|cecill(?: [bc])? (?:free software )?license(?: agreement)?"),
    ("mulan-psl-2", r"licensed under mulan psl v2|mulan permissive software license(?: version)?(?: 2)?"),
    ("openrail", r"creativeml open ?rail m(?: license)?|bigscience (?:open ?)?rail (?:m )?license|use based restrictions set forth in attachment a of this license"),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)(?: information)?(?: all rights reserved)?|unauthorized (?:copying|reproduction|use) of this (?:file|document|software|work)(?: via any medium)? is strictly prohibited"),
    ("proprietary", r"no part of this (?:publication|book|document|work) may be reproduced (?:stored in a retrieval system or )?(?:distributed )?(?:or )?transmitted in any form or by any means without the prior (?:written )?permission"),
    ("eula", r"by installing copying or otherwise using the software you agree to be bound by the terms of this (?:end user licen[sc]e )?agreement|end user licen[sc]e agreement"),
)
#: The rank of a license's own words.
SIGNATURE_RANK = 4
#: A text holds no rule's and no base phrase's words without any of these, in either
#: case, unless it names a license after one of the words of the forms below.
GATE = ("licen", "spdx", "rights", "creative", "gnu", "gpl", "apache", "mozilla", "bsd", "eclipse", "cc0")
FORM_WORDS = ("released", "distributed", "published", "available", "provided", "covered", "subject", "governed", "conditions", "terms")
CC_BY = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+(?:by|attribution)"
TOP_RANK = 5
#: Words from this length on are taken as equally rare when those that open the gate are chosen.
RARE_LENGTH = 8


def _needed(parsed: list, run: str = "") -> list[list[str]]:
    """Sets of literals, of each of which every match of a parsed expression holds one, after ``run``."""
    found: list[list[str]] = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            run += chr(arg)
            continue
        if kind == "SUBPATTERN":
            found += _needed(arg[3], run)
        elif kind == "BRANCH":
            found.append([x for way in arg[1] for x in _best(_needed(way, run))])
        found.append([run])
        run = ""
    return [*found, [run]]


def _best(sets: list[list[str]]) -> list[str]:
    """The set whose literals are longest."""
    return max(sets, key=lambda xs: min(map(len, xs)))


def name_keywords(name: str) -> list[str]:
    """Literals of which every text with the name holds one; a name has spaces on both sides."""
    return sorted(set(_best(_needed(re._parser.parse(f" (?:{name}) ")))))


def signature_rules() -> list[tuple[str, str, str, int]]:
    """The rules in order: label, keyword pattern, expression over spaced words, rank."""
    out = [(label, f"(?:{'|'.join(name_keywords(rx))})", f"(?:{rx})", SIGNATURE_RANK) for label, rx in SIGNATURES]
    for label, name, spdx in FAMILIES:
        keyword = "|".join(name_keywords(name))
        for rank, form, _ in FORMS:
            if label in PLAIN_NAMES:
                form = form.replace("(?: licen[sc]e)?", " licen[sc]e")
            out.append((label, f"(?:{keyword}| spdx| licen[sc]es)", form.replace("{name}", name).replace("{spdx}", spdx), rank))
        if label in BARE:
            out.append((label, f"(?:{keyword})", f"(?:{name})", 1))
    return [(label, kw, f"(?<= )(?:{rx})(?= )", rank) for label, kw, rx, rank in out]


def signature_words() -> list[str]:
    """Words of which, beside the gate's, every text with a license's own words holds one: few, each chosen for what it covers."""
    out: list[str] = []
    left = [_needed(re._parser.parse(f" (?:{rx}) ")) for _, rx in SIGNATURES]
    while left := [sets for sets in left if not any(all(_held(x, out) for x in xs) for xs in sets)]:
        # literals that nothing covers yet, of each signature's sets of long words; a covered one is never chosen for again
        open_ = []
        for sets in left:
            least = min(RARE_LENGTH, max(map(_shortest, sets)))
            open_.append([x for xs in sets if 0 < least <= _shortest(xs) for x in xs if not _held(x, out)])
        words = {w for xs in open_ for x in xs for w in x.split() if len(w) >= min(RARE_LENGTH, max(map(len, x.split())))}
        if not words:
            raise ValueError("a signature has no words that every match holds")
        out.append(max(sorted(words), key=lambda w: (sum(any(w in x for x in xs) for xs in open_), len(w))))
    return out


def _shortest(literals: list[str]) -> int:
    """The length of the longest word of the literal in which that is shortest."""
    return min(max((len(w) for w in x.split()), default=0) for x in literals)


def _held(literal: str, words: list[str]) -> bool:
    """Whether a literal holds one of the gate's words or of these."""
    return any(w in literal for w in (*GATE, *words))


def name_words() -> list[str]:
    """Beginnings of words of which every text that names a license holds one."""
    return sorted({max(x.split(), key=len) for _, name, _ in FAMILIES for x in name_keywords(name)})


def _rules_sql(rules: list[tuple[str, str, str, int]]) -> str:
    def quoted(x: str) -> str:
        return "r'" + x + "'"

    # one entry per keyword, so that a keyword that is absent spares all its rules
    by_kw: dict[str, list[str]] = {}
    for order, (label, kw, rx, rank) in enumerate(rules):
        by_kw.setdefault(kw, []).append(f"struct({quoted(label)} AS label, {quoted(rx)} AS rx, {rank} AS rank, {order} AS ord)")
    return "array(" + ", ".join(f"struct({quoted(kw)} AS kw, array({', '.join(rs)}) AS rules)" for kw, rs in by_kw.items()) + ")"


def _places(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"get(_lw, i + {k}) = '{x}'" for k, x in enumerate(words))
    return f"filter(sequence(0, size(_lw) - 1), i -> coalesce({test}, false))"


#: Steps of a running sum or maximum, each over four times as many: no array has more elements than these reach.
STEPS = 16


def _running(values: str, step: str) -> str:
    """SQL for the running sums or maxima of an array: ``step`` puts x and the value y before it together, if there is one."""
    out = values
    for k in range(STEPS):
        joined = "x"
        for back in (4**k, 2 * 4**k, 3 * 4**k):
            if back < 1 << 31:
                joined = step.replace("x", joined).replace("y", f"get(a, i - {back})")
        out = f"transform(array({out}), a -> CASE WHEN size(a) > {4**k} THEN transform(a, (x, i) -> {joined}) ELSE a END)[0]"
    return out


def _hits(norm: str, rule: str) -> str:
    """SQL for a rule's detections: the expression splits the text once, and starts are running sums."""
    steps = "transform(z.ms, (m, k) -> length(get(z.gaps, k)) + coalesce(length(get(z.ms, k - 1)), 0))"
    spans = f"transform({_running(steps, 'x + ifnull(y, 0)')}, (s, k) -> struct(s AS start, -(s + length(get(z.ms, k))) AS stop, -{rule}.rank AS rank, {rule}.ord AS ord, {rule}.label AS label))"
    return f"flatten(transform(array(struct(regexp_extract_all({norm}, {rule}.rx, 0) AS ms, split({norm}, {rule}.rx, -1) AS gaps)), z -> {spans}))"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, base places and labels, all labels, spans (in words' characters) and score."""
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), body.alias("_body"), F.lower(body).alias("_low"))
    near: Column = reduce(or_, (F.contains("_low", F.lit(x)) for x in dict.fromkeys((*GATE, *signature_words()))))
    formed: Column = reduce(or_, (F.contains("_low", F.lit(x)) for x in FORM_WORDS))
    near = near | (formed & F.col("_low").rlike(rf"(?<![a-z0-9])(?:{'|'.join(name_words())})"))
    near = near | (F.contains("_low", F.lit("cc")) & F.col("_low").rlike(CC_BY))
    d = d.select("doc_id", F.array_remove(F.split("_body", NOT_WORD), "").alias("_w"), near.alias("_near"))
    d = d.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.when(F.col("_near") & (F.size("_w") > 0), lower_ascii(F.array_join("_w", " "))).alias("_text"),
    )
    d = d.withColumn("_lw", F.split("_text", " ")).withColumn("_norm", F.concat(F.lit(" "), "_text", F.lit(" ")))
    d = d.withColumn("_gate", F.col("_text").isNotNull())
    for k, (phrase, _) in enumerate(BASE_PHRASES):
        d = d.withColumn(f"_b{k}", F.expr(f"CASE WHEN _gate THEN {_places(phrase)} END"))
    base = F.flatten(F.array(*(F.coalesce(f"_b{k}", F.expr("array()").cast("array<int>")) for k in range(len(BASE_PHRASES)))))
    d = d.withColumn("_base", base).withColumn(
        "_base_labels",
        F.array_compact(F.array(*(F.when(F.size(f"_b{k}") > 0, label) for k, (_, label) in enumerate(BASE_PHRASES)))),
    )
    found = (
        f"flatten(transform(filter({_rules_sql(signature_rules())}, g -> rlike(_norm, g.kw)), g -> "
        f"flatten(transform(filter(g.rules, r -> rlike(_norm, r.rx)), r -> {_hits('_norm', 'r')}))))"
    )
    # in order of start, from the longest and most trusted on: one that ends no later than any before it is inside it
    d = d.withColumn("_hits", F.expr(f"CASE WHEN _gate THEN array_sort({found}) END"))
    upto = _running("transform(_hits, h -> -h.stop)", "greatest(x, y)")  # bound once: a lambda would work it out for each of its elements
    kept = "filter(z.hits, (s, k) -> k = 0 OR -s.stop > get(z.upto, k - 1))"
    d = d.withColumn("_spans", F.expr(f"flatten(transform(array(struct(_hits AS hits, {upto} AS upto)), z -> {kept}))"))
    own = F.coalesce(F.expr("transform(_spans, s -> s.label)"), F.expr("array()").cast("array<string>"))
    best = F.coalesce(F.expr(f"array_max(transform(_spans, s -> -s.rank)) / {float(TOP_RANK)}D"), F.lit(0.0))
    return d.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min("_base").cast("long").alias("first_word"),
        F.array_max("_base").cast("long").alias("last_word"),
        F.array_join(F.array_sort("_base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_base_labels", own))), ",").alias("labels"),
        F.greatest(best, F.when(F.size("_base") > 0, 0.8).otherwise(0.0)).alias("score"),
        F.expr("transform(_spans, s -> struct(s.start - 1 AS start, -s.stop - s.start AS len, s.label AS label, -s.rank AS rank))").alias("spans"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License scan over the whole of ``documents``."""
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")
