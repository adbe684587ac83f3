"""License scan by ordered signature rules.

A rule is a hand-written pattern with a label, a priority, a confidence and the
keywords of which one must occur in the text, or the rule is not run. A text is
lower-cased (A-Z) and each run of white space, with the comment marks around a line
break, becomes one blank, so that a name or grant wrapped over the lines of a comment
is found. Its keywords are found by one pass of a multi-string automaton, then the
rules they open run over the whole text; spans are places in the given text. Detections
are taken by priority, then longest and leftmost first; one that lies in or contains
a detection taken before is suppressed (the name inside "licensed under ...", the
bare form inside a license field); those that only overlap stay both. An identifier in an SPDX expression or
a license field is a detection of its own, so that ``MIT OR Apache-2.0`` has two. Base phrases (a parameter) are counted word by word and
never suppressed.

Null texts count as empty; repeated rows are scanned row by row; other columns
are ignored.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, id_text, with_id

LOWER = {i: i + 32 for i in range(65, 91)}

#: White space other than one blank; around a line break with its comment marks.
#: Possessive throughout, so that long runs take linear time.
GAP = re.compile(r"[^\S\n]*+(?:(?:(?<!\*)\*++/|-->)[^\S\n]*+)?\n(?:\s|[*#/;%!|>]|--++|<!--)*+|[^\S\n]{2,}+|[^\S\n ]")


class Rule(NamedTuple):
    label: str
    priority: int  # a smaller one wins
    confidence: float
    keywords: tuple[str, ...]  # with "<" in front: only at the start of a word
    pattern: str


#: label, keywords (one for each alternative of the pattern), pattern of the
#: license's name, SPDX identifiers.
NAMES = (
    ("agpl", "affero|agpl", r"(?:gnu )?affero general public licen[sc]e|\bagpl\b", "agpl-1.0 agpl-3.0"),
    ("lgpl", "lesser|library general", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", "lgpl-2.0 lgpl-2.1 lgpl-3.0"),
    ("lgpl", "lgpl", r"\blgpl\b", ""),
    ("gpl", "general public", r"gnu general public licen[sc]e", "gpl-1.0 gpl-2.0 gpl-3.0"),
    ("gpl", "gpl", r"\bgnu gpl\b|\bgplv?[23]\b", ""),
    ("gfdl", "free documentation", r"gnu free documentation licen[sc]e", "gfdl-1.1 gfdl-1.2 gfdl-1.3"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", "apache-1.0 apache-1.1 apache-2.0"),
    ("mit", "mit|expat", r"\bmit licen[sc]e|\bexpat licen[sc]e", "mit mit-0"),
    ("bsd-2-clause", "bsd", r"(?:2|two)[- ]clause bsd licen[sc]e|simplified bsd licen[sc]e", "bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:3|three)[- ]clause bsd licen[sc]e|(?:new|modified|revised) bsd licen[sc]e", "bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:4|four)[- ]clause bsd licen[sc]e|original bsd licen[sc]e", "bsd-4-clause"),
    ("bsd", "bsd", r"\bbsd licen[sc]e", "0bsd"),
    ("isc", "isc", r"\bisc licen[sc]e", "isc"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl-1.0 mpl-1.1 mpl-2.0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "epl-1.0 epl-2.0"),
    ("cddl", "common development", r"common development and distribution licen[sc]e", "cddl-1.0 cddl-1.1"),
    ("cpl", "common public", r"common public licen[sc]e", "cpl-1.0"),
    ("eupl", "european union", r"european union public licen[sc]e", "eupl-1.1 eupl-1.2"),
    ("artistic", "artistic", r"artistic licen[sc]e", "artistic-1.0 artistic-2.0"),
    ("zlib", "zlib", r"\bzlib(?:/libpng)? licen[sc]e", "zlib"),
    ("boost", "boost", r"boost software licen[sc]e", "bsl-1.0"),
    ("unlicense", "unlicense", r"\bthe unlicense\b", "unlicense"),
    ("wtfpl", "want to public", r"do what the fuck you want to public licen[sc]e", "wtfpl"),
    ("cc0", "cc0|commons zero", r"\bcc0\b|creative commons zero", "cc0-1.0"),
    ("cc-by-nc-nd", "cc", r"\bcc[- ]by-nc-nd\b", "cc-by-nc-nd-3.0 cc-by-nc-nd-4.0"),
    ("cc-by-nc-sa", "cc", r"\bcc[- ]by-nc-sa\b", "cc-by-nc-sa-3.0 cc-by-nc-sa-4.0"),
    ("cc-by-nc", "cc", r"\bcc[- ]by-nc\b", "cc-by-nc-3.0 cc-by-nc-4.0"),
    ("cc-by-nd", "cc", r"\bcc[- ]by-nd\b", "cc-by-nd-3.0 cc-by-nd-4.0"),
    ("cc-by-sa", "cc", r"\bcc[- ]by-sa\b", "cc-by-sa-3.0 cc-by-sa-4.0"),
    ("cc-by", "cc", r"\bcc[- ]by\b", "cc-by-3.0 cc-by-4.0"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution[- ]noncommercial", ""),
    ("cc-by-sa", "sharealike", r"creative commons attribution[- ]sharealike", ""),
    ("cc-by-nd", "noderiv", r"creative commons attribution[- ]noderiv(?:ative)?s", ""),
    ("cc-by", "creative commons", r"creative commons attribution", ""),
    ("odbl", "open database", r"open database licen[sc]e", "odbl-1.0"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", "ofl-1.1"),
    ("psf", "python software", r"python software foundation licen[sc]e", "psf-2.0"),
    ("php", "php", r"\bphp licen[sc]e", "php-3.01"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("openssl", "openssl", r"openssl licen[sc]e", "openssl"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms-pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms-rl"),
    ("sspl", "server side", r"server side public licen[sc]e", "sspl-1.0"),
    ("busl", "business source", r"business source licen[sc]e", "busl-1.1"),
    ("ncsa", "illinois", r"university of illinois(?:/ncsa)? open source licen[sc]e", "ncsa"),
    ("afl", "academic free", r"academic free licen[sc]e", "afl-3.0"),
    ("osl", "open software", r"open software licen[sc]e", "osl-3.0"),
    ("vim", "vim", r"\bvim licen[sc]e", "vim"),
    ("ruby", "ruby", r"\bruby licen[sc]e", "ruby"),
    ("x11", "x11", r"\bx11 licen[sc]e", "x11"),
)

#: Short names and other ways to say it: label, keywords at the start of a word
#: (one for each alternative), pattern. ``{v}`` stands
#: for what may follow a version.
LATER = r"(?:[- ]only|[- ]or[- ](?:any )?later|\+)?(?![\w-])"
SHORT = (
    ("gpl", "gpl", r"\b(?:gnu )?gpl[- ]?v?[123](?:\.0)?{v}"),
    ("gpl", "gpl", r"\b(?:gnu )?gpl,? (?:licen[sc]e,? )?(?:version|ver\.?) ?[123](?:\.0)?{v}"),
    ("gpl", "gpl", r"\bgpl[- ]licen[sc]ed\b|\bgpl licen[sc]e"),
    ("lgpl", "lgpl", r"\b(?:gnu )?lgpl[- ]?v?[23](?:\.[01])?{v}"),
    ("lgpl", "lgpl", r"\b(?:gnu )?lgpl,? (?:licen[sc]e,? )?(?:version|ver\.?) ?[23](?:\.[01])?{v}"),
    ("lgpl", "lgpl", r"\blgpl[- ]licen[sc]ed\b"),
    ("agpl", "agpl", r"\b(?:gnu )?agpl[- ]?v?[13](?:\.0)?{v}"),
    ("agpl", "agpl", r"\b(?:gnu )?agpl,? (?:version|ver\.?) ?[13](?:\.0)?{v}"),
    ("apache", "apache", r"\bapache[- ]?(?:v|version )?[12](?:\.[01])?{v}"),
    ("apache", "apache", r"\bapache[- ]licen[sc]ed\b"),
    ("apache", "asl", r"\basl[- ]?2(?:\.0)?{v}"),
    ("mit", "mit licen|mit-licen|mit style|mit-style", r"\bmit[- ]licen[sc]ed\b|\bmit[- ]style licen[sc]e"),
    ("mit", "mit/", r"\bmit/x11\b|\bmit/expat\b"),
    ("bsd-2-clause", "bsd", r"\bbsd[- ](?:2|two)[- ]clause\b"),
    ("bsd-3-clause", "bsd", r"\bbsd[- ](?:3|three)[- ]clause\b"),
    ("bsd-4-clause", "bsd", r"\bbsd[- ](?:4|four)[- ]clause\b"),
    ("bsd", "bsd|0bsd", r"\bbsd[- ]licen[sc]ed\b|\bbsd[- ](?:style|like|type) licen[sc]e|\b0bsd\b"),
    ("isc", "isc", r"\bisc[- ]licen[sc]ed\b"),
    ("mpl", "mpl", r"\bmpl[- ]?v?[12](?:\.[01])?{v}"),
    ("mpl", "mpl", r"\bmpl[- ]licen[sc]ed\b"),
    ("eupl", "eupl", r"\beupl(?:[- ]?v?\.? ?1(?:\.[012])?)?{v}"),
    ("epl", "epl", r"\bepl[- ]?v?[12]\.0{v}"),
    ("cddl", "cddl", r"\bcddl(?:[- ]?v?1\.[01])?{v}"),
    ("cecill", "cecill", r"\bcecill(?:-[bc])?(?:[- ]?v?[12]\.[01])?{v}"),
    ("wtfpl", "wtfpl", r"\bwtfpl\b"),
    ("ofl", "ofl", r"\b(?:sil )?ofl[- ]?v?1\.[01]{v}"),
    ("unlicense", "unlicense", r"\bunlicense\b"),
    ("zlib", "zlib", r"\bzlib[- ]licen[sc]ed\b"),
    ("boost", "bsl", r"\bbsl-1\.0\b"),
    ("boost", "boost", r"\bboost[- ]licen[sc]ed\b"),
    ("busl", "busl", r"\bbusl-?1\.1\b"),
    ("sspl", "sspl", r"\bsspl(?:[- ]?v?1(?:\.0)?)?{v}"),
    ("artistic", "artistic", r"\bartistic[- ]?v?[12]\.0\b"),
    ("psf", "psf", r"\bpsf[- ](?:2\.0|licen[sc]e)"),
    ("ncsa", "ncsa", r"\bncsa(?: open source)? licen[sc]e"),
    ("odbl", "odbl", r"\bodbl(?:[- ]?v?1\.0)?{v}"),
    ("cc0", "cc0|cc zero|cc-zero|cczero", r"\bcc[- ]?zero\b|\bcc0[- ]?1\.0\b"),
    ("gfdl", "gfdl", r"\bgfdl(?:[- ]?v?1\.[123])?{v}"),
    ("beerware", "beer", r"\bbeer-?ware licen[sc]e|\bbeerware\b"),
    ("proprietary", "eula|end user licen|end-user licen", r"\bend[- ]user licen[sc]e agreement\b|\beula\b"),
)

#: Names that a license field or an SPDX expression may hold beside the versioned
#: identifiers: label, pattern.
FIELD_NAMES = (
    ("gpl", r"(?:gnu )?gpl"), ("lgpl", r"(?:gnu )?lgpl"), ("agpl", r"(?:gnu )?agpl"), ("apache", r"apache(?: licen[sc]e)?(?:,? (?:version )?2(?:\.0)?)?"),
    ("mit", r"mit"), ("bsd", r"bsd"), ("isc", r"isc"), ("mpl", r"mpl"), ("zlib", r"zlib"), ("unlicense", r"unlicense"), ("proprietary", r"proprietary"),
    ("proprietary", r"unlicensed"), ("public-domain", r"public[- ]domain"), ("cc0", r"cc0"), ("cc-by", r"cc[- ]by"), ("cc-by-sa", r"cc[- ]by[- ]sa"),
)

#: What opens a field, and an SPDX expression with the identifiers before ours.
FIELD_KEYWORDS = tuple(map("".join, itertools.product(["licen"], "sc", ["e", "es"], ["", '"', "'"], ["", " "], ":=")))
FIELD = r"""\blicen[sc]es?["']? ?[:=] ?[\[({]? ?["']?(?:the )?"""
EXPRESSION = r"spdx-license-identifier: ?(?:\(*[\w.+-]++\)* (?:or|and|with) )*\(*"

#: Whole phrases that are no license name: label, priority, confidence, keyword, pattern.
PHRASES = (
    ("mit", 20, 0.95, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", 20, 0.9, "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose"),
    ("bsd", 20, 0.9, "redistribution and use", r"redistribution and use in source and binary forms"),
    ("apache", 20, 0.95, "in compliance with", r"you may not use this file except in compliance with the license"),
    ("gpl", 20, 0.9, "free software", r"this program is free software[;:,] you can redistribute it"),
    ("lgpl", 20, 0.9, "free software", r"this library is free software[;:,] you can redistribute it"),
    ("public-domain", 30, 0.7, "public domain", r"(?:released|dedicated|placed) (?:in)?to the public domain|\bpublic domain\b"),
    ("proprietary", 40, 0.6, "all rights reserved", r"all rights reserved"),
    ("proprietary", 30, 0.8, "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("copyright", 50, 0.4, "copyright", r"copyright (?:\(c\)|©)? ?[12][0-9]{3}"),
    ("copyright", 50, 0.4, "©", r"© ?[12][0-9]{3}"),
)

#: Frames around a name: priority, confidence, text before, text after.
FRAMES = (
    (5, 1.0, r"licen[sc]ed under (?:the (?:terms of the )?)?", r"(?:,? (?:version )?v?[0-9]+(?:\.[0-9]+)*)"),
    (10, 0.95, r"licen[sc]ed under (?:the (?:terms of the )?)?", ""),
    (10, 0.95, r"(?:released|distributed|available|published) under (?:the (?:terms of the )?)?", ""),
    (20, 0.85, "", r"(?:,? (?:version )?v?[0-9]+(?:\.[0-9]+)*)"),
    (30, 0.75, "", ""),
)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: each name in each frame, each identifier, the phrases."""
    out = []
    for label, keyword, name, spdx in NAMES:
        for priority, confidence, before, after in FRAMES:
            out.append(Rule(label, priority, confidence, tuple(keyword.split("|")), f"{before}(?:{name}){after}"))
        for one in map(re.escape, spdx.split()):
            out.append(Rule(label, 0, 1.0, ("spdx-license-identifier",), rf"{EXPRESSION}(?P<at>{one}(?:-only|-or-later|\+)?)(?![\w.-])"))
            out.append(Rule(label, 2, 0.95, FIELD_KEYWORDS, rf"{FIELD}(?P<at>{one}(?:-only|-or-later|\+)?)(?![\w.-])"))
    for label, name in FIELD_NAMES:
        out.append(Rule(label, 3, 0.9, FIELD_KEYWORDS, rf"{FIELD}(?P<at>{name})(?![\w.-]*\w)"))
    frames = ((25, 0.8, ""), (10, 0.95, r"licen[sc]ed under (?:the )?"), (10, 0.95, r"(?:released|distributed|available|published) under (?:the )?"))
    for label, keywords, pattern in SHORT:
        at_start = tuple("<" + k for k in keywords.split("|"))
        out += [Rule(label, p, c, at_start, f"{before}(?:{pattern.replace('{v}', LATER)})") for p, c, before in frames]
    out += [Rule(label, p, c, (keyword,), pattern) for label, p, c, keyword, pattern in PHRASES]
    return tuple(out)


def blanked(text: str) -> tuple[str, list[int], list[int]]:
    """The text with each gap one blank, the places after each gap in it, and how
    many characters the text has lost up to there."""
    out, at, lost, done = [], [], [], 0
    for m in GAP.finditer(text):
        out.append(text[done : m.start()])
        done = m.end()
        if m.end() - m.start() > 1:
            lost.append((lost[-1] if lost else 0) + m.end() - m.start() - 1)
            at.append(m.end() - lost[-1])
    out.append(text[done:])
    return " ".join(out), at, lost


class Scanner:
    """The rules behind their keywords, and the base phrases."""

    def __init__(self, base: dict[str, str], ruleset: tuple[Rule, ...] | None = None):
        import ahocorasick

        self.base = [(b" " + p.encode().translate(WORD_BYTES) + b" ", label) for p, label in base.items()]
        self.opens: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        for rule in ruleset if ruleset is not None else rules():
            pattern = re.compile(rule.pattern)
            for k in rule.keywords:
                self.opens.setdefault(k, []).append((rule, pattern))
        self.automaton = ahocorasick.Automaton()
        for k in {k.removeprefix("<") for k in self.opens}:
            self.automaton.add_word(k, k)
        if self.opens:
            self.automaton.make_automaton()

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) after suppression, in order of the text."""
        low, at, lost = blanked(text.translate(LOWER))
        keys = set()
        for end, k in self.automaton.iter(low) if self.opens else ():
            keys.add(k)
            start = end - len(k) + 1
            if start == 0 or not low[start - 1].isalnum():
                keys.add("<" + k)
        opened = {id(pattern): (rule, pattern) for k in sorted(keys) for rule, pattern in self.opens.get(k, ())}
        place = lambda i: i + (lost[n - 1] if (n := bisect_right(at, i)) else 0)
        found = []
        for rule, pattern in opened.values():
            which = "at" if "at" in pattern.groupindex else 0
            found += [(place(m.start(which)), place(m.end(which) - 1) + 1, rule) for m in pattern.finditer(low) if m.end(which) > m.start(which)]
        found.sort(key=lambda f: (f[2].priority, f[0] - f[1], f[0], -f[2].confidence, f[2].label))
        kept: list[tuple[int, int, Rule]] = []  # none in another one: by start, and so by end
        for one in found:
            within, around = (b(kept, one[0], key=lambda k: k[0]) for b in (bisect_right, bisect_left))
            if not (within and kept[within - 1][1] >= one[1] or around < len(kept) and kept[around][1] <= one[1]):
                kept.insert(within, one)
        return kept

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
        n_words, starts, labels = len(words), [], set()
        joined = b" " + b" ".join(words) + b" "
        for phrase, label in self.base:
            at = joined.find(phrase)
            done = counted = 0
            while at >= 0:
                counted += joined.count(b" ", done, at)
                done = at
                starts.append(counted)
                labels.add(label)
                at = joined.find(phrase, at + 1)
        found = self.detections(text)
        every = labels | {rule.label for _, _, rule in found}
        score = max([rule.confidence for _, _, rule in found] + [0.75] * bool(starts), default=0.0)
        spans = [{"start": a, "end": b, "label": r.label, "confidence": r.confidence} for a, b, r in found]
        low, high = (min(starts), max(starts)) if starts else (None, None)
        return n_words, len(starts), low, high, ",".join(sorted(labels)), ",".join(sorted(every)), score, spans


def scan(docs: DataFrame, base: dict[str, str]) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans (start, end, label, confidence; in characters) by row.
    ``base``: phrase of lower-case words to label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(base)
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for pdf in batches:
            out = pd.DataFrame([scanner.scan(t) for t in pdf["text"].fillna("")], columns=names)
            out["first_word"], out["last_word"] = out["first_word"].astype("Int64"), out["last_word"].astype("Int64")
            out.insert(0, "doc_id", pdf["doc_id"].array)
            yield out

    schema = (
        "doc_id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<start:int,end:int,label:string,confidence:double>>"
    )
    return with_id(docs.select(id_text(), "text").mapInPandas(run, schema))
