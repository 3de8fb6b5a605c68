import re

import pytest

from boardroll.llm import license_scan as scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None, "", "!!! ...", "Licensed under CC BY-NC 4.0.", "cc, by; CC\nBY cc by by cc",
    "GNU General Public\tLicense v3. General public license, general public licenses", "all rights reserved",
    "All-Rights_Reserved! é all rights reserved x", "x " * 20000 + "cc by " * 500, "ccby general public",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0",
    "spdx-license-identifier: mit\nnext line", "spdx license identifier: nothing here",
]


def slow(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in scan.BASE.items():
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_against_brute_force(documents):
    rows = {r.doc_id: r for r in scan.scan_licences(documents(*enumerate(TEXTS * 2))).collect()}
    for k, text in enumerate(TEXTS * 2):
        r = rows[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_adjacent_phrases_share_a_blank():
    assert scan.Scanner().scan("cc by cc by cc by")[1:4] == (3, 0, 4)


def test_postfix():
    assert scan.postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert scan.postfix(["(", "a", "or", "b", ")", "and", "c"]) == ["a", "b", "or", "c", "and"]
    for bad in (["and", "a"], ["a", "and"], ["(", "a"], ["a", ")"], ["(", ")"], []):
        with pytest.raises(ValueError):
            scan.postfix(bad)


def test_expressions():
    labels = scan.Scanner().scan(TEXTS[10])[5].split(",")
    assert labels == ["apache-2.0", "classpath-exception-2.0", "gpl-2.0-only", "mit"]
    assert scan.Scanner().scan(TEXTS[11])[5] == "mit"
    assert scan.evaluate("MIT and") == {"mit": pytest.approx(0.495)}


def test_empty_table(documents):
    assert scan.scan_licences(documents((1, "x")).where("false")).count() == 0


def test_expressions_over_lines():
    def labels(text):
        return scan.Scanner().scan(f"SPDX-License-Identifier: {text}")[5]

    assert labels("(MIT OR Apache-2.0\n OR BSD-3-Clause)\nmore prose") == "apache-2.0,bsd-3-clause,mit"
    assert labels("MIT OR\r\n# Apache-2.0\nnext line") == "apache-2.0,mit"
    assert labels("MIT\n * OR Apache-2.0 */") == "apache-2.0,mit"
    assert labels("MIT\nor else nothing") == "mit" and labels("\nprose here") == ""


def test_broken_expressions_give_all_names_up_to_the_break():
    half = pytest.approx(0.495)
    assert scan.evaluate("(MIT OR Apache-2.0") == {"mit": half, "apache-2.0": half}
    assert scan.evaluate("MIT OR Apache-2.0 AND") == {"mit": half, "apache-2.0": half}
    assert scan.evaluate("(MIT OR Apache-2.0 prose goes on") == {"mit": half, "apache-2.0": half}
    assert scan.evaluate("MIT AND OR GPL-2.0-only") == {"mit": half, "gpl-2.0-only": half}
    assert scan.evaluate("OR MIT") == {"mit": half}


def test_every_tag_counts():
    def labels(text):
        return scan.Scanner().scan(text)[5]

    tag = "SPDX-License-Identifier:"
    assert labels(f"{tag} MIT\n{tag} Apache-2.0") == "apache-2.0,mit"
    assert labels(f"{tag} MIT\n\nsome text here\n{tag} GPL-2.0-only") == "gpl-2.0-only,mit"
    assert labels(f"// {tag} MIT\r\n// {tag} ISC\n# {tag} Zlib") == "isc,mit,zlib"
    assert labels(f"{tag} MIT OR\n{tag} Apache-2.0") == "apache-2.0,mit"
    assert labels(f"{tag} MIT {tag} BSD-3-Clause") == "bsd-3-clause,mit"
    assert labels(f"{tag}\n{tag} MIT") == "mit" and labels(f"{tag} {tag}") == ""


def test_prose_behind_an_expression_is_no_licence():
    assert scan.evaluate("MIT and more prose") == {"mit": 0.99}
    assert scan.evaluate("MIT or whatever you like") == {"mit": 0.99}
    assert scan.evaluate("GPL-2.0-only WITH Linux-syscall-note and thanks") == dict.fromkeys(["gpl-2.0-only", "linux-syscall-note"], 0.99)
    assert scan.evaluate("MIT AND LicenseRef-Acme-1.0 OR DocumentRef-x:LicenseRef-y") == dict.fromkeys(
        ["mit", "licenseref-acme-1.0", "documentref-x:licenseref-y"], 0.99
    )
    assert scan.evaluate("house-licence AND MIT") == dict.fromkeys(["house-licence", "mit"], 0.99)
    assert scan.evaluate("MIT OR (Apache-2.0 WITH LLVM-exception)") == dict.fromkeys(["mit", "apache-2.0", "llvm-exception"], 0.99)
