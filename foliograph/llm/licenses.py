r"""Operator 8, license scans by ordered signature rules, in DataFrame functions only.

A document is looked at closely only if it holds one of a few stems. Its rules are then gated by their keywords: a
regular expression runs only where its keyword stands. Matches are intervals of the lower-cased text (A-Z only); a
match that lies inside one of a higher-ranking rule, or of an equal-ranking rule that covers more, or the same by an
earlier rule, is suppressed. Labels of what remains join the base labels, which come from exact word sequences.
score: the highest rank among the remaining matches by 100; 0.6 with base places only; 0 with neither.

Defined results. Null or empty text: no words, no labels (empty strings), null first_word and last_word. A null doc_id
is a document. Repeated rows are scanned row by row. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Every match of a base phrase or rule holds one of these.
STEMS = ("licen", "copyright", "public domain", "creative commons", "creativecommons", "cc", "gnu", "apache", "mozilla", "warrant", "redistribution", "permission", "rights reserved", "opensource.org", "bsd", "gpl")
STEMS += ("cddl", "eupl", "cecill", "commons clause", "rail", "no attribution", "proprietary", "©", "advertising materials", "2.0", "neither the name of", "no part of this", "distributed under", "copying", "good, not evil")

#: Identifiers that an SPDX tag may name; each makes a rule of rank 100 and one of rank 70 for "licensed under <id>".
SPDX = """
    0BSD AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0
    Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause
    BSL-1.0 BUSL-1.1 CC0-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0
    CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-3.0
    CC-BY-SA-4.0 CDDL-1.0 CDDL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0
    EUPL-1.1 EUPL-1.2 FTL GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only
    GPL-3.0-or-later HPND ICU IJG IPL-1.0 ISC LGPL-2.0 LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only
    LGPL-3.0-or-later LPL-1.02 LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0
    OFL-1.0 OFL-1.1 OSL-2.1 OSL-3.0 PDDL-1.0 PostgreSQL Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SSPL-1.0 Unicode-DFS-2016
    Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()

#: rank, label, keyword that every match holds :: expression over the lower-cased text. The first of equals wins.
RULES = r"""
90 gpl-3.0 gnu :: gnu general public license,?\s+(?:version|v\.?)\s*3(?:\.0)?
90 gpl-2.0 gnu :: gnu general public license,?\s+(?:version|v\.?)\s*2(?:\.0)?
90 gpl-1.0 gnu :: gnu general public license,?\s+(?:version|v\.?)\s*1(?:\.0)?
92 gpl-3.0-or-later gnu :: gnu general public license[^.]{0,80}?version 3[^.]{0,60}?or \(at your option\) any later version
92 gpl-2.0-or-later gnu :: gnu general public license[^.]{0,80}?version 2[^.]{0,60}?or \(at your option\) any later version
88 gpl-3.0 gpl :: \bgpl[- ]?(?:version |v)?3(?:\.0)?\b
88 gpl-2.0 gpl :: \bgpl[- ]?(?:version |v)?2(?:\.0)?\b
60 gpl gnu :: gnu general public licen[cs]e
50 gpl gpl :: \bgnu gpl\b
90 lgpl-3.0 gnu :: gnu lesser general public license,?\s+(?:version|v\.?)\s*3(?:\.0)?
90 lgpl-2.1 gnu :: gnu lesser general public license,?\s+(?:version|v\.?)\s*2\.1
90 lgpl-2.0 gnu :: gnu library general public license,?\s+(?:version|v\.?)\s*2(?:\.0)?
88 lgpl-3.0 lgpl :: \blgpl[- ]?(?:version |v)?3(?:\.0)?\b
88 lgpl-2.1 lgpl :: \blgpl[- ]?(?:version |v)?2\.1\b
60 lgpl gnu :: gnu (?:lesser|library) general public licen[cs]e
50 lgpl lgpl :: \blgpl\b
90 agpl-3.0 affero :: (?:gnu )?affero general public license,?\s+(?:version|v\.?)\s*3(?:\.0)?
88 agpl-3.0 agpl :: \bagpl[- ]?(?:version |v)?3(?:\.0)?\b
60 agpl affero :: affero general public licen[cs]e
60 gfdl gnu :: gnu free documentation licen[cs]e
85 gpl-3.0 gnu.org/licenses :: gnu\.org/licenses/gpl-3\.0
85 gpl-2.0 gnu.org/licenses :: gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
85 lgpl-3.0 gnu.org/licenses :: gnu\.org/licenses/lgpl-3\.0
85 agpl-3.0 gnu.org/licenses :: gnu\.org/licenses/agpl-3\.0
55 gpl gnu.org/licenses :: gnu\.org/licenses/gpl
90 apache-2.0 apache :: apache licen[cs]e,?\s+(?:version|v\.?)?\s*2(?:\.0)?
90 apache-1.1 apache :: apache (?:software )?licen[cs]e,?\s+(?:version|v\.?)?\s*1\.1
90 apache-1.0 apache :: apache (?:software )?licen[cs]e,?\s+(?:version|v\.?)?\s*1\.0
85 apache-2.0 apache.org/licenses :: apache\.org/licenses/license-2\.0
60 apache apache :: apache (?:software )?licen[cs]e
50 apache 2.0 :: \bapl[- ]?2\.0\b|\basl[- ]?2\.0\b
95 mit permission :: permission is hereby granted, free of charge, to any person obtaining a copy
90 mit-0 mit :: mit no attribution
75 mit opensource.org :: opensource\.org/licenses/mit\b
60 mit mit :: \bmit licen[cs]e\b
60 mit mit :: licen[cs]ed? under (?:the )?(?:terms of the )?mit\b
60 x11 x11 :: \bx11 licen[cs]e\b
60 expat expat :: \bexpat licen[cs]e\b
95 bsd-3-clause neither :: neither the name of [^.]{0,120}? nor the names of its contributors
93 bsd-2-clause redistribution :: redistribution and use in source and binary forms, with or without modification
90 bsd-4-clause advertising :: all advertising materials mentioning features or use of this software
88 bsd-3-clause bsd :: \b(?:3-clause|three-clause|new|modified|revised) bsd\b|\bbsd[- ]3(?:[- ]clause)?\b
88 bsd-2-clause bsd :: \b(?:2-clause|two-clause|simplified|freebsd) bsd\b|\bbsd[- ]2(?:[- ]clause)?\b
88 bsd-4-clause bsd :: \b(?:4-clause|four-clause|original) bsd\b
60 bsd bsd :: \bbsd[- ](?:style )?licen[cs]e\b
85 0bsd bsd :: \bzero-clause bsd\b|\b0bsd\b
95 isc permission :: permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee
60 isc isc :: \bisc licen[cs]e\b
90 mpl-2.0 mozilla :: mozilla public licen[cs]e,?\s+(?:version|v\.?)?\s*2(?:\.0)?
90 mpl-1.1 mozilla :: mozilla public licen[cs]e,?\s+(?:version|v\.?)?\s*1\.1
85 mpl-2.0 mozilla :: mozilla\.org/(?:en-us/)?mpl/2\.0
60 mpl mozilla :: mozilla public licen[cs]e
60 epl eclipse :: eclipse public licen[cs]e
90 epl-2.0 eclipse :: eclipse public licen[cs]e[ ,-]+(?:version|v\.?)?\s*2\.0
90 epl-1.0 eclipse :: eclipse public licen[cs]e[ ,-]+(?:version|v\.?)?\s*1\.0
60 cddl cddl :: \bcddl\b
65 cddl common development :: common development and distribution licen[cs]e
60 cpl common public :: common public licen[cs]e
60 eupl european union :: european union public licen[cs]e
90 eupl-1.2 eupl :: \beupl[- ]?v?\.?\s?1\.2
60 artistic artistic :: \bartistic licen[cs]e\b
90 artistic-2.0 artistic :: \bartistic licen[cs]e,?\s+(?:version|v\.?)?\s*2\.0
60 bsl boost :: boost software licen[cs]e
60 busl business source :: business source licen[cs]e
60 sspl server side :: server side public licen[cs]e
60 zlib zlib :: \bzlib(?:/libpng)? licen[cs]e\b
90 zlib as-is :: this software is provided 'as-is', without any express or implied warranty
60 wtfpl what the :: do what the f[a-z*]+ you want to public licen[cs]e
60 unlicense unlicense :: \bthe unlicense\b|unlicense\.org
95 unlicense public domain :: free and unencumbered software released into the public domain
60 ofl open font :: (?:sil )?open font licen[cs]e
60 osl open software :: \bopen software licen[cs]e\b
60 afl academic free :: academic free licen[cs]e
60 python python software :: python software foundation licen[cs]e
60 postgresql postgresql :: \bpostgresql licen[cs]e\b
60 php php :: \bphp licen[cs]e\b
60 ruby ruby :: \bruby licen[cs]e\b
60 ms-pl microsoft :: microsoft public licen[cs]e
60 ms-rl microsoft :: microsoft reciprocal licen[cs]e
60 lppl latex :: latex project public licen[cs]e
60 ncsa ncsa :: (?:university of illinois/)?ncsa open source licen[cs]e
60 cecill cecill :: \bcecill(?:-[bc])?\b
60 mulan mulan :: mulan (?:permissive|public) (?:software )?licen[cs]e
60 odbl database :: open (?:data commons )?(?:open )?database licen[cs]e
60 pddl public domain :: public domain dedication and licen[cs]e
60 beerware beer-ware :: beer-ware licen[cs]e
60 vim vim :: \bvim licen[cs]e\b
60 w3c w3c :: w3c (?:software )?(?:notice and )?licen[cs]e
60 unicode unicode :: unicode(?:, inc\.)? licen[cs]e agreement
60 openssl openssl :: \bopenssl licen[cs]e\b
60 sleepycat sleepycat :: sleepycat licen[cs]e
60 upl universal permissive :: universal permissive licen[cs]e
60 blueoak blue oak :: blue oak model licen[cs]e
60 elastic elastic :: \belastic licen[cs]e\b
60 commons-clause commons clause :: \bcommons clause\b
60 polyform polyform :: polyform (?:noncommercial|small business|shield|strict) licen[cs]e
60 openrail rail :: \bopen(?:\s|-)?rail(?:-m)?\b
60 llama-community llama :: llama (?:\d(?:\.\d)? )?community licen[cs]e
95 cc0 creativecommons.org :: creativecommons\.org/publicdomain/zero/1\.0
95 cc-by-nc-nd creativecommons.org :: creativecommons\.org/licenses/by-nc-nd/\d\.\d
95 cc-by-nc-sa creativecommons.org :: creativecommons\.org/licenses/by-nc-sa/\d\.\d
95 cc-by-nc creativecommons.org :: creativecommons\.org/licenses/by-nc/\d\.\d
95 cc-by-nd creativecommons.org :: creativecommons\.org/licenses/by-nd/\d\.\d
95 cc-by-sa creativecommons.org :: creativecommons\.org/licenses/by-sa/\d\.\d
94 cc-by creativecommons.org :: creativecommons\.org/licenses/by/\d\.\d
92 cc-by-nc-nd cc :: \bcc[- ]by[- ]nc[- ]nd(?:[- ]\d\.\d)?\b
92 cc-by-nc-sa cc :: \bcc[- ]by[- ]nc[- ]sa(?:[- ]\d\.\d)?\b
90 cc-by-nc cc :: \bcc[- ]by[- ]nc(?:[- ]\d\.\d)?\b
90 cc-by-nd cc :: \bcc[- ]by[- ]nd(?:[- ]\d\.\d)?\b
90 cc-by-sa cc :: \bcc[- ]by[- ]sa(?:[- ]\d\.\d)?\b
80 cc-by cc :: \bcc[- ]by(?:[- ]\d\.\d)?\b
80 cc0 cc0 :: \bcc0(?:[- ]1\.0)?\b
91 cc-by-nc-nd creative commons :: creative commons attribution[- ]non-?commercial[- ]no ?deriv(?:ative)?s?
91 cc-by-nc-sa creative commons :: creative commons attribution[- ]non-?commercial[- ]share ?alike
89 cc-by-nc creative commons :: creative commons attribution[- ]non-?commercial
89 cc-by-nd creative commons :: creative commons attribution[- ]no ?deriv(?:ative)?s?
89 cc-by-sa creative commons :: creative commons attribution[- ]share ?alike
79 cc-by creative commons :: creative commons attribution
40 creative-commons creative commons :: \bcreative commons\b
70 proprietary rights reserved :: \ball rights reserved\b
65 proprietary confidential :: \bproprietary and confidential\b
65 proprietary no part of this :: no part of this (?:book|publication|work|document) may be (?:reproduced|copied)
45 public-domain public domain :: \b(?:in|into|to) the public domain\b
30 copyright copyright :: \bcopyright (?:\(c\)|©)?\s*(?:19|20)\d\d\b
30 copyright © :: ©\s*(?:19|20)\d\d\b
35 no-warranty warrant :: without warrant(?:y|ies) (?:or conditions )?of any kind
25 license-grant licen :: \blicen[cs]ed under (?:the )?(?:terms|conditions) of\b
25 license-grant distributed :: \bdistributed under (?:the )?(?:terms|conditions) of\b
20 license-mention see :: \bsee (?:the )?(?:file )?(?:licen[cs]e|copying)(?:\.txt|\.md)?\b
60 aladdin aladdin :: aladdin free public licen[cs]e
60 apsl apple :: apple public source licen[cs]e
90 apsl-2.0 apple :: apple public source licen[cs]e,?\s+(?:version|v\.?)?\s*2\.0
60 bittorrent bittorrent :: bittorrent open source licen[cs]e
60 bzip2 bzip2 :: \bbzip2 licen[cs]e\b
60 caldera caldera :: \bcaldera licen[cs]e\b
60 catosl computer associates :: computer associates trusted open source licen[cs]e
60 cern-ohl cern :: \bcern open hardware licen[cs]e
90 cern-ohl-2.0 cern :: \bcern[- ]ohl[- ][psw][- ]2\.0\b
60 clartistic clarified :: clarified artistic licen[cs]e
60 cnri cnri :: \bcnri (?:python )?(?:open source )?licen[cs]e
60 condor condor :: \bcondor public licen[cs]e
60 cua-opl cua office :: \bcua office public licen[cs]e
60 ecos ecos :: \becos licen[cs]e\b
60 ecl educational :: educational community licen[cs]e
90 ecl-2.0 educational :: educational community licen[cs]e,?\s+(?:version|v\.?)?\s*2\.0
60 efl eiffel :: eiffel forum licen[cs]e
60 entessa entessa :: entessa public licen[cs]e
60 erlpl erlang :: erlang public licen[cs]e
60 eudatagrid datagrid :: eu datagrid software licen[cs]e
60 fair fair :: \bfair licen[cs]e\b
60 frameworx frameworx :: frameworx (?:open )?licen[cs]e
60 ftl freetype :: freetype (?:project )?licen[cs]e
60 gsoap gsoap :: gsoap public licen[cs]e
60 hpnd historical :: historical permission notice and disclaimer
60 ipl ibm :: \bibm public licen[cs]e
60 icu icu :: \bicu licen[cs]e\b
60 ijg jpeg :: independent jpeg group licen[cs]e
60 info-zip info-zip :: info-zip licen[cs]e
60 intel intel :: \bintel open source licen[cs]e
60 ipa ipa :: \bipa font licen[cs]e
60 jasper jasper :: \bjasper(?:-2\.0)? licen[cs]e
60 json json :: \bjson licen[cs]e\b
85 json good, not evil :: shall be used for good, not evil
60 latex2e latex2e :: latex2e licen[cs]e
60 leptonica leptonica :: leptonica licen[cs]e
60 libpng libpng :: \blibpng licen[cs]e
60 libtiff libtiff :: \blibtiff licen[cs]e
60 lpl lucent :: lucent public licen[cs]e
60 miros miros :: \bmiros licen[cs]e
60 motosoto motosoto :: motosoto open source licen[cs]e
60 multics multics :: multics licen[cs]e
60 naumen naumen :: naumen public licen[cs]e
60 netcdf netcdf :: netcdf licen[cs]e
60 ngpl nethack :: nethack general public licen[cs]e
60 nokia nokia :: nokia open source licen[cs]e
60 npl netscape :: netscape public licen[cs]e
60 nosl netizen :: netizen open source licen[cs]e
60 nposl non-profit :: non-profit open software licen[cs]e
60 oclc oclc :: oclc research public licen[cs]e
60 ogtsl open group :: open group test suite licen[cs]e
60 oldap openldap :: openldap public licen[cs]e
60 opl open content :: open content licen[cs]e
60 opubl open publication :: open publication licen[cs]e
60 ogl open government :: open government licen[cs]e
90 ogl-3.0 open government :: open government licen[cs]e,?\s+(?:version|v\.?)?\s*3(?:\.0)?
60 tapr-ohl tapr :: tapr open hardware licen[cs]e
60 oset oset :: \boset public licen[cs]e
60 parity parity :: \bparity public licen[cs]e
60 prosperity prosperity :: \bprosperity public licen[cs]e
60 plexus plexus :: plexus classworlds licen[cs]e
60 qpl q public :: \bq public licen[cs]e
60 rpl reciprocal :: \breciprocal public licen[cs]e
60 rpsl realnetworks :: realnetworks public source licen[cs]e
60 rscpl ricoh :: ricoh source code public licen[cs]e
60 scea scea :: \bscea shared source licen[cs]e
60 simpl simple :: \bsimple public licen[cs]e
60 sissl sun industry :: sun industry standards source licen[cs]e
60 smlnj standard ml :: standard ml of new jersey licen[cs]e
60 spl sun public :: \bsun public licen[cs]e
60 sugarcrm sugarcrm :: sugarcrm public licen[cs]e
60 tcl tcl :: \btcl(?:/tk)? licen[cs]e
60 tmate tmate :: tmate open source licen[cs]e
60 vovida vovida :: vovida software licen[cs]e
60 watcom watcom :: open watcom public licen[cs]e
60 xfree86 xfree86 :: xfree86 licen[cs]e
60 xnet x.net :: \bx\.net(?:, inc\.)? licen[cs]e
60 ypl yahoo :: yahoo! public licen[cs]e
60 zend zend :: \bzend licen[cs]e
60 zimbra zimbra :: zimbra public licen[cs]e
60 zpl zope :: zope public licen[cs]e
90 zpl-2.1 zope :: zope public licen[cs]e,?\s+(?:version|v\.?)?\s*2\.1
60 hippocratic hippocratic :: hippocratic licen[cs]e
60 anti-996 996 :: anti[- ]996 licen[cs]e
60 fsl functional source :: functional source licen[cs]e
60 bigscience bigscience :: bigscience (?:bloom )?(?:open)?rail licen[cs]e
60 gemma gemma :: \bgemma licen[cs]e
60 deepseek deepseek :: deepseek licen[cs]e
60 qwen qwen :: \bqwen (?:research )?licen[cs]e
60 falcon falcon :: \bfalcon(?: llm| 180b)?(?: tii)? licen[cs]e
60 cdla community data :: community data licen[cs]e agreement
90 cdla-permissive community data :: community data licen[cs]e agreement[ ,-]+permissive
90 cdla-sharing community data :: community data licen[cs]e agreement[ ,-]+sharing
60 odc-by open data commons :: open data commons attribution licen[cs]e
60 etalab ouverte :: licence ouverte\b
60 freebsd-doc freebsd :: freebsd documentation licen[cs]e
70 eula user :: \bend[- ]user licen[cs]e agreement
50 dual-licensed dual :: \bdual[- ]licen[cs]ed\b
50 noncommercial commercial :: licen[cs]ed for non-?commercial (?:use|purposes)
30 license-grant permission is :: permission is (?:hereby )?granted
30 license-grant redistribution :: \bredistributions? (?:of source code|in binary form) must
35 no-warranty as is :: as is["']?,? without (?:any )?warrant(?:y|ies)
""".strip().splitlines()


def rules() -> list[tuple[int, str, str, str]]:
    out = []
    for spdx in SPDX:
        name = spdx.lower()
        plain = name.replace(".", r"\.").replace("+", r"\+")
        out.append((100, name, name, rf"spdx-license-identifier:\s*{plain}(?![\w.-]*\w)"))
        out.append((70, name, name, rf"licen[cs]ed? (?:under|:)\s*(?:the )?{plain}(?![\w-]|\.\d)"))
    for line in RULES:
        head, pattern = line.split(" :: ", 1)
        rank, label, keyword = head.split(" ", 2)
        out.append((int(rank), label, keyword, pattern))
    return out


#: Running sums and sweeps go block by block, as an array that grows by one is copied each time.
STEP = 512
MATCH = "array<struct<start:int,end:int,rank:int,place:int,label:string>>"


def _let(value: Column, use) -> Column:
    """use(value), with value computed once: inside lambdas, what is written twice is computed twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(x: Column) -> Column:
    """The array in pieces of STEP."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / STEP).cast("int")), lambda b: F.slice(x, b * STEP + 1, STEP))


def _sums(x: Column) -> Column:
    """0 and the running sums of an array of integers, which is not empty."""

    def plain(y: Column) -> Column:
        return F.aggregate(y, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    def joined(parts: Column, starts: Column) -> Column:
        whole = F.flatten(F.transform(parts, lambda p, i: F.transform(F.slice(p, 1, F.size(p) - 1), lambda v: v + F.get(starts, i))))
        return F.concat(whole, F.array(F.element_at(starts, -1)))

    return _let(F.transform(_blocks(x), plain), lambda parts: _let(plain(F.transform(parts, lambda p: F.element_at(p, -1))), lambda starts: joined(parts, starts)))


def _matches(low: Column, r: Column) -> Column:
    """Intervals of one rule's matches, of which there is one at least: the lengths of what stands between them and
    their own, added up."""
    gaps = F.transform(F.split(low, r["pattern"], -1), F.length)
    own = F.transform(F.regexp_extract_all(low, r["pattern"], F.lit(0)), F.length)

    def placed(found: Column, ends: Column) -> Column:
        def one(f: Column, i: Column) -> Column:
            end = F.get(ends, i + 1)
            return F.struct((end - f).alias("start"), end.alias("end"), r["rank"].alias("rank"), r["place"].alias("place"), r["label"].alias("label"))

        return F.transform(found, one)

    both = lambda found: F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: g + f)
    return _let(own, lambda found: _let(both(found), lambda steps: _let(_sums(steps), lambda ends: placed(found, ends))))


def _remaining(found: Column, ranks: list[int]) -> Column:
    """The matches that no match before them holds: one of higher rank, or of equal rank and longer, or the same by an
    earlier rule. In order of start, and of the longer, the higher and the earlier first, a match is held if one of its
    rank or a higher one has reached its end, so one sweep with the furthest ends by rank decides."""
    levels = F.array(*[F.lit(r) for r in ranks])
    none = F.transform(levels, lambda _: F.lit(-1))

    def reach(block: Column) -> Column:
        """The furthest ends in a block, by rank."""
        return F.aggregate(block, none, lambda ends, m: F.zip_with(ends, levels, lambda e, r: F.when(r <= -m["neg_rank"], F.greatest(e, -m["neg_end"])).otherwise(e)))

    def step(acc: Column, m: Column) -> Column:
        end, rank = -m["neg_end"], -m["neg_rank"]
        held = F.element_at(acc["ends"], F.array_position(levels, rank).cast("int")) >= end
        one = F.array(F.struct(m["start"].alias("start"), end.alias("end"), rank.alias("rank"), m["place"].alias("place"), m["label"].alias("label")))
        ends = F.zip_with(acc["ends"], levels, lambda e, r: F.when(r <= rank, F.greatest(e, end)).otherwise(e))
        return F.struct(ends.alias("ends"), F.when(held, acc["kept"]).otherwise(F.concat(acc["kept"], one)).alias("kept"))

    def sweep(block: Column, ends: Column) -> Column:
        return F.aggregate(block, F.struct(ends.alias("ends"), F.expr(f"cast(array() as {MATCH})").alias("kept")), step)["kept"]

    def swept(blocks: Column) -> Column:
        # what all blocks before a block have reached
        before = F.aggregate(F.transform(blocks, reach), F.array(none), lambda acc, x: F.concat(acc, F.array(F.zip_with(F.element_at(acc, -1), x, lambda a, b: F.greatest(a, b)))))
        return _let(before, lambda known: F.flatten(F.transform(blocks, lambda block, i: sweep(block, F.get(known, i)))))

    keyed = lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("neg_end"), (-m["rank"]).alias("neg_rank"), m["place"].alias("place"), m["label"].alias("label"))
    whole = _let(F.array_sort(F.transform(found, keyed)), lambda ordered: _let(_blocks(ordered), swept))
    return F.when(F.size(found) > 0, whole).otherwise(F.expr(f"cast(array() as {MATCH})"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections (what remains)."""
    table = F.array(*[F.struct(F.lit(n).alias("rank"), F.lit(k).alias("place"), F.lit(label).alias("label"), F.lit(word).alias("keyword"), F.lit(p).alias("pattern")) for k, (n, label, word, p) in enumerate(rules())])
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(F.col("loose"), F.lit(stem))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("loose", F.lower("text"))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), F.when(gate, F.translate("text", UPPER, LOWER)).alias("low"))
    rows = rows.withColumn("words", F.when(F.col("low").isNotNull(), F.filter(F.split("low", APART), lambda w: w != "")))
    firsts = sorted({p.split()[0] for p, _ in BASE})
    starts = F.filter(F.transform("words", lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("starts", starts)

    def places(phrase: str) -> Column:
        def stands(i: Column) -> Column:
            out = F.lit(True)
            for k, w in enumerate(phrase.split()):
                out = out & (F.coalesce(F.get("words", i + k), F.lit("")) == w)
            return out

        return F.filter("starts", stands)

    rows = rows.withColumns({f"p{k}": places(p) for k, (p, _) in enumerate(BASE)})
    hits = F.filter(table, lambda r: F.contains(F.col("low"), r["keyword"]) & F.rlike(F.col("low"), r["pattern"]))
    rows = rows.withColumn("found", F.when(F.col("low").isNotNull(), F.flatten(F.transform(hits, lambda r: _matches(F.col("low"), r)))))
    rows = rows.drop("low", "words", "starts")
    rows = rows.withColumn("detections", F.when(F.col("found").isNotNull(), _remaining(F.col("found"), sorted({r[0] for r in rules()}))))
    every = F.concat(*[F.coalesce(F.col(f"p{k}"), F.expr("cast(array() as array<int>)")) for k in range(len(BASE))])
    base = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())))
    rows = rows.withColumns({"every": every, "base": base, "own": F.coalesce(F.transform("detections", lambda d: d["label"]), F.expr("cast(array() as array<string>)"))})
    top = F.coalesce(F.array_max(F.transform("detections", lambda d: d["rank"])), F.lit(0)) / 100.0
    return rows.select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own")), ",").alias("labels"),
        F.greatest(top, F.when(F.size("every") > 0, 0.6).otherwise(0.0)).alias("score"),
        "detections",
    )


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("detections")
