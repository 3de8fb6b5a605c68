"""Licence scan: Aho-Corasick over words, and licence expressions by shunting-yard.

One automaton holds the notice phrases and the words of identifier tags; it reads each
text's words joined by single blanks, so whatever stands between two words does not
matter. Where an identifier tag (``SPDX-License-Identifier:``) is found, the expression
behind it is read from the text as written, turned into postfix order by a shunting-yard
parser (``with`` binds tighter than ``and``, ``and`` tighter than ``or``) and evaluated:

* a licence gives its label, ``with`` keeps it and adds the exception's label;
* ``and`` gives the labels of both sides, its confidence is the smaller one;
* ``or`` leaves the choice to the reader: the labels of both, the larger confidence.

A document's score is ``1 - prod(1 - confidence)`` over its distinct labels.

Defined results: a null text is empty; without words all counts are 0 and both word
places null; without labels ``labels`` is the empty string; an expression that cannot be
parsed gives the labels of the licence names in it at half confidence. An expression ends
before the next tag, and before an operator that is followed by a word which is not formed
like a licence's or exception's id; the name right behind the tag is taken as it is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from boardroll.llm.common import map_texts

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notices: phrase -> (label, confidence).
NOTICES = {
    "apache license": ("apache", 0.9),
    "mit license": ("mit", 0.9),
    "bsd license": ("bsd", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "lesser general public license": ("lgpl", 0.95),
    "affero general public license": ("agpl", 0.95),
    "creative commons attribution": ("cc-by", 0.9),
    "cc by nc": ("cc-by-nc", 0.95),
    "cc by sa": ("cc-by-sa", 0.95),
    "cc by nd": ("cc-by-nd", 0.95),
    "cc0": ("cc0", 0.8),
    "public domain": ("public-domain", 0.5),
    "permission is hereby granted free of charge": ("mit", 0.95),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "licensed under": ("notice", 0.3),
    "released under": ("notice", 0.2),
}
BASE_CONFIDENCE = {"cc-by": 0.9, "gpl": 0.95, "reserved": 0.7}
TAG = "spdx license identifier"

_WORDS = bytes(
    (c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_TAGGED = re.compile(r"spdx-license-identifier\s*:[ \t]*", re.IGNORECASE)
_EXPRESSION = re.compile(r"(?:[()]|[a-z0-9][a-z0-9.+:-]*|[ \t]|[\r\n]+[ \t]*[*#/;]*)+", re.IGNORECASE)
# How licence and exception ids are formed, family by family.
_KNOWN = re.compile(
    r"""(?:[al]?gpl-[0-9.]+(?:-only|-or-later|\+)?|gfdl-[0-9.]+[a-z-]*
    |mit(?:-[a-z0-9-]+)?|apache-[0-9.]+|bsd-[0-9]-clause(?:-[a-z-]+)?|0bsd|isc|zlib|unlicense|wtfpl|ncsa|x11|beerware
    |(?:mpl|epl|cddl|cpl|osl|afl|ecl|eupl|artistic|ofl|bsl|ms-pl|ms-rl|psf|python|ruby|php|zpl|w3c|openssl|postgresql
       |upl|mulanpsl|cecill|lppl|apsl|ipl|npl|qpl|sleepycat|vim|curl|ftl|libpng|hpnd|tcl|icu|json|intel|boost)(?:-[a-z0-9.-]+)?
    |cc0-[0-9.]+|cc-by(?:-nc|-sa|-nd)*-[0-9.]+(?:-[a-z]+)?|cc-pddc|pddl-[0-9.]+|odbl-[0-9.]+
    |(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+
    |[a-z0-9.-]+-exception(?:-[a-z0-9.-]+)?|llvm-exception|linux-syscall-note|openvpn-openssl-exception)\+?""",
    re.IGNORECASE | re.VERBOSE,
)
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*|\r\n|\r|\n", re.IGNORECASE)
_BINDS = {"or": 1, "and": 2, "with": 3}
_UPPER = (["OR"], ["AND"], ["WITH"])
"""Operators as SPDX writes them; only these continue an expression from the next line."""
_IDENTIFIED = 0.99


def postfix(tokens: list[str]) -> list[str]:
    """Tokens of an expression in postfix order; ValueError if they do not form one."""
    out: list[str] = []
    held: list[str] = []
    wants_name = True
    for token in tokens:
        low = token.lower()
        if low in _BINDS:
            if wants_name:
                raise ValueError(f"{token!r} without a left side")
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[low]:
                out.append(held.pop())
            held.append(low)
            wants_name = True
        elif token == "(":
            if not wants_name:
                raise ValueError("( after a name")
            held.append(token)
        elif token == ")":
            if wants_name:
                raise ValueError(") without a name")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("unbalanced )")
            held.pop()
        else:
            if not wants_name:
                break  # prose behind the expression
            out.append(token)
            wants_name = False
    if wants_name or "(" in held:
        raise ValueError("incomplete expression")
    return out + held[::-1]


def _written(expression: str) -> list[str]:
    """Tokens up to the first line break at which no operator and no bracket is open.

    A break just before an operator is passed over too. Comment marks at the beginning of
    a continued line are no tokens.
    """
    tokens = _TOKEN.findall(expression)
    out: list[str] = []
    depth = 0
    for k, token in enumerate(tokens):
        if token in ("\r\n", "\r", "\n"):
            if out and depth <= 0 and out[-1].lower() not in _BINDS and tokens[k + 1 : k + 2] not in _UPPER:
                break
            if not out:
                break  # a tag without an expression on its line
            continue
        depth += (token == "(") - (token == ")")
        out.append(token)
    return _without_prose(out)


def _without_prose(tokens: list[str]) -> list[str]:
    """Tokens before the first operator behind which a word stands that is no licence's id."""
    for k, token in enumerate(tokens):
        if token.lower() in _BINDS:
            behind = next((t for t in tokens[k + 1 :] if t != "("), None)
            if behind is not None and behind != ")" and behind.lower() not in _BINDS and not _KNOWN.fullmatch(behind):
                return tokens[:k]
    return tokens


def expressions(text: str) -> list[str]:
    """What may be an expression behind each tag, up to the next tag at most."""
    tags = [(m.start(), m.end()) for m in _TAGGED.finditer(text)]
    ends = [*[start for start, _ in tags], len(text)][1:]
    found = [_EXPRESSION.match(text, begin, end) for (_, begin), end in zip(tags, ends, strict=False)]
    return [m[0] for m in found if m]


def _names(tokens: list[str]) -> list[str]:
    """Licence names of a broken expression, up to a name or bracket that no operator joins."""
    out: list[str] = []
    ended = False
    for token in tokens:
        if token.lower() in _BINDS:
            ended = False
        elif token == ")":
            ended = True
        elif ended:
            break
        elif token != "(":
            out.append(token.lower())
            ended = True
    return out


def evaluate(expression: str) -> dict[str, float]:
    """Labels of an expression, with their confidence."""
    tokens = _written(expression)
    try:
        order = postfix(tokens)
    except ValueError:
        return dict.fromkeys(_names(tokens), _IDENTIFIED / 2)
    stack: list[dict[str, float]] = []
    for token in order:
        if token not in _BINDS:
            stack.append({token.lower(): _IDENTIFIED})
            continue
        right, left = stack.pop(), stack.pop()
        if token == "or":
            level = max([*left.values(), *right.values()])
        else:
            level = min([*left.values(), *right.values()])
        stack.append(dict.fromkeys([*left, *right], level))
    return stack[0]


def automaton(phrases: Mapping[str, object]) -> ahocorasick.Automaton:
    """Finds each phrase, between blanks, in words joined by blanks."""
    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


class Scanner:
    """Scans one text; built once per task."""

    def __init__(self, notices: Mapping[str, tuple[str, float]] = NOTICES):
        self.notices = notices
        self.machine = automaton({**BASE, **notices, TAG: None})

    def scan(self, text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = text.encode("utf-8", "replace").translate(_WORDS).split()
        joined = f" {b' '.join(words).decode('latin-1')} "
        starts: list[int] = []
        base: set[str] = set()
        labels: dict[str, float] = {}
        tagged = False
        for end, phrase in self.machine.iter(joined):
            if phrase in BASE:
                label = BASE[phrase]
                starts.append(end - len(phrase) - 1)
                base.add(label)
                labels[label] = max(labels.get(label, 0.0), BASE_CONFIDENCE[label])
            elif phrase == TAG:
                tagged = True
            else:
                label, confidence = self.notices[phrase]
                labels[label] = max(labels.get(label, 0.0), confidence)
        if tagged:
            for expression in expressions(text):
                for label, confidence in evaluate(expression).items():
                    labels[label] = max(labels.get(label, 0.0), confidence)
        doubt = 1.0
        for label in sorted(labels):
            doubt *= 1.0 - labels[label]
        first = joined.count(" ", 0, min(starts)) if starts else None
        last = joined.count(" ", 0, max(starts)) if starts else None
        return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - doubt


FIELDS = [
    StructField("n_words", LongType()), StructField("n_base", LongType()),
    StructField("first_word", LongType()), StructField("last_word", LongType()),
    StructField("base_labels", StringType()), StructField("labels", StringType()),
    StructField("score", DoubleType()),
]
_ARROW = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]


def scan_licences(docs: DataFrame, notices: Mapping[str, tuple[str, float]] = NOTICES) -> DataFrame:
    """One row per document: doc_id and the fields of ``Scanner.scan``."""

    def work():
        scanner = Scanner(notices)

        def apply(texts: list[str]) -> list[pa.Array]:
            columns = zip(*map(scanner.scan, texts), strict=True)
            return [pa.array(c, kind) for c, kind in zip(columns, _ARROW, strict=True)]

        return apply

    return map_texts(docs, work, FIELDS)
