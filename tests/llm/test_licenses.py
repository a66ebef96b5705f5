import os
import random

import numpy as np
import pytest

from folioforge.llm import licenses as L
from helpers import documents, long_text


def edit_match(words, template):
    """All stretches, by plain edit distance."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    return min(distance(template, words[i:j]) for i in range(len(words) + 1) for j in range(i, len(words) + 1))


def test_fewest_differences_of_any_stretch():
    r = random.Random(0)
    for _ in range(200):
        words, template = [[r.randint(0, 3) for _ in range(r.randint(0, 9))] for _ in range(2)]
        different, a, b = L.best_match(np.array(words, np.int64), np.array(template, np.int64))
        assert different == edit_match(words, template)
        assert 0 <= a <= b <= len(words)
        assert edit_match(words[a:b], template) == different


def notices(found):
    return [(f[0], f[5]) for f in found]


def test_every_template_is_found_whole_and_with_a_small_change():
    scanner = L.Scanner(L.TEMPLATES)
    for name, text in L.TEMPLATES.items():
        pad = "Lorem ipsum dolor sit amet. " * 20
        found = scanner.scan(pad + text.upper() + "\n" + pad)
        assert (name, 0) in notices(found), name
        a, b = next((f[1], f[2]) for f in found if f[0] == name)
        assert (pad + text.upper())[a:b].strip("./") == text.upper().strip("./")
        if len(scanner.words[name]) > 20:
            changed = text.replace(" the ", " thee ", 1)
            assert (name, 1) in notices(scanner.scan(pad + changed + pad)), name


def test_near_misses_are_not_licenses():
    scanner = L.Scanner(L.TEMPLATES)
    assert scanner.scan("Driving licence. The license plate of a car with copyright and MIT. Released early.") == []
    assert notices(scanner.scan("Licensed under CC BY-SA 4.0.")) == [("cc-by-sa-4.0-notice", 0)]


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_many_notices_in_one_text():
    scanner = L.Scanner(L.TEMPLATES)
    for name in ("apache-2.0-notice", "apache-2.0-header", "mit-notice", "mit-text"):
        for n in (5, 20, 40):
            r = random.Random(n)
            text, at = prose(r, 200), []
            for _ in range(n):
                at.append(len(text) + 1)
                text += " " + L.TEMPLATES[name] + " " + prose(r, 200)
            found = scanner.scan(text)
            assert notices(found) == [(name, 0)] * n, (name, n)
            assert [f[1] for f in found] == at
            assert all(f[3] > 0 for f in found), (name, n)


def test_a_notice_in_every_place_among_others():
    name = "cc0-1.0-notice"
    notice, scanner = L.TEMPLATES[name], L.Scanner({n: L.TEMPLATES[n] for n in (name, "mit-notice", "gpl-3.0-header")})
    lead = "copyright version 3 of the License, or (at your option) any later version of " * 3 + "w " * 20
    for gap in range(0, 150, 7):
        text = lead + "v " * gap + notice + " " + "v " * gap + notice
        at = [len(lead) + 2 * gap]
        at.append(at[0] + len(notice) + 1 + 2 * gap)
        assert [f[:3] for f in scanner.scan(text)] == [(name, x, x + len(notice) - 1) for x in at], gap


def test_what_stands_between_words_does_not_count():
    scanner = L.Scanner(L.TEMPLATES)
    for name in ("mit-full", "apache-2.0-header", "cc-by-4.0-notice"):
        for n in (1, 2, 60, 120, 500):
            for blank in (" ", "\n", "*"):
                text = "Lorem ipsum. " + L.TEMPLATES[name].replace(" ", blank * n) + " Dolor."
                assert notices(scanner.scan(text)) == [(name, 0)], (name, n)


def test_changes_of_any_word_within_the_tolerance():
    scanner = L.Scanner(L.TEMPLATES)
    for name, old, new, different in (
        ("gpl-warranty", "GNU General Public License", "GNU GPL", 3),
        ("zlib-text", "redistribute", "share", 1),
        ("cc0-1.0-notice", "copyright", "ownership", 1),
        ("isc-text", "Permission", "Leave", 1),
    ):
        found = scanner.scan("x " * 40 + L.TEMPLATES[name].replace(old, new) + " y" * 40)
        assert notices(found) == [(name, different)], name
    r = random.Random(8)
    for name, text in L.TEMPLATES.items():
        words = text.split()
        allowed = scanner.allowed[name]
        for _ in range(4):
            changed = list(words)
            for k in r.sample(range(len(words)), min(allowed, len(words) // 8)):
                # One word of letters each, or none.
                if len(L.words_of(changed[k])) == 1:
                    changed[k] = r.choice(["quux", "quux"])
            assert scanner.scan("x " * 30 + " ".join(changed) + " y" * 30), (name, changed)


def test_words_that_fold_or_stand_by_odd_signs():
    scanner = L.Scanner({"notice": "Free to share"})
    for text in ("FREE TO SHARE", "\u0345Free\u0345 to \u0345share\u0345", "\ud800free to share", "(free)to[share]"):
        assert notices(scanner.scan(text)) == [("notice", 0)], ascii(text)
    for text in ("freeto share", "_free to share", "free to shares", "\u03b9free to share"):
        assert scanner.scan(text) == [], ascii(text)
    assert L.Scanner({}).scan("Released under the MIT License.") == []
    assert L.Scanner({"empty": "..."}).scan("...") == []


def test_operator(spark):
    a, m = L.TEMPLATES["apache-2.0-notice"], L.TEMPLATES["mit-text"]
    rows = [(1, "é " + a + " x " + a), (2, None), (3, ""), (4, "clean"), (5, long_text(30_000) + " " + m + " " + long_text(30_000)), (6, m), (6, m), (None, a)]
    got = sorted((tuple(r) for r in L.scan_licenses(documents(spark, rows, extra=True)).collect()), key=repr)
    assert [(r[0], r[1], r[7]) for r in got] == sorted([(1, "apache-2.0-notice", True)] * 2 + [(5, "mit-text", True)] + [(6, "mit-text", True)] * 2 + [(None, "apache-2.0-notice", True)], key=repr)
    text = dict(rows)
    assert all(text[r[0]][r[2] : r[3]].split()[0] in ("Licensed", "Permission") for r in got)
    assert all(r[4] > 0 for r in got)
    assert L.scan_licenses(documents(spark, [])).collect() == []


def test_the_ranking_decides_how_much_is_confirmed(monkeypatch):
    scanner, ranked = L.Scanner(L.TEMPLATES), L.Scanner.reductions
    texts = ["v " * 50 + L.TEMPLATES[n].replace(" the ", " thee ", 2) + " w" * 50 for n in sorted(L.TEMPLATES)]
    found = [scanner.scan(x) for x in texts]
    assert ranked(scanner, L.words_of(L.TEMPLATES["isc-full"]))[0][1] == "isc-full"
    cost, scanner.confirmed = scanner.confirmed, 0
    # The worst first: the same notices, at a higher price.
    monkeypatch.setattr(L.Scanner, "reductions", lambda self, words: [(-s, n, a, b) for s, n, a, b in ranked(self, words)])
    again = [scanner.scan(x) for x in texts]
    assert [[(f[0], f[1], f[2], f[5]) for f in x] for x in found] == [[(f[0], f[1], f[2], f[5]) for f in x] for x in again]
    assert scanner.confirmed >= 1.15 * cost, (cost, scanner.confirmed)


def test_many_long_notices_without_a_gap_take_time_by_their_number():
    scanner = L.Scanner(L.TEMPLATES)
    counts = []
    for n in (10, 40):
        scanner.confirmed = 0
        assert notices(scanner.scan((L.TEMPLATES["mit-full"] + "\n") * n)) == [("mit-full", 0)] * n
        counts.append(scanner.confirmed)
    assert counts[1] <= 5 * counts[0]


def test_templates_without_cue_words_bring_their_own():
    own = {"own-notice": "Anyone may freely reuse these materials provided attribution remains intact", "mit-notice": L.TEMPLATES["mit-notice"]}
    scanner = L.Scanner(own)
    assert notices(scanner.scan("x " * 40 + own["own-notice"] + " y" * 40)) == [("own-notice", 0)]
    assert notices(scanner.scan("x " * 40 + own["own-notice"].replace("attribution", "naming") + " y" * 40)) == [("own-notice", 1)]
    assert scanner.scan("x " * 40 + "anyone remains here") == []


def brute_scan(text, templates):
    """Every stretch of every length against every template."""
    spans = [(m.start(), m.end(), m.group().lower()) for m in L.WORD.finditer(text)]
    words = [w for _, _, w in spans]
    hits = []
    for name, template in templates.items():
        t = L.words_of(template)
        allowed = int(L.TOLERANCE * len(t))
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + len(t) + allowed) + 1):
                if abs(j - i - len(t)) <= allowed:
                    row = list(range(j - i + 1))
                    for a, x in enumerate(t, 1):
                        row, old = [a], row
                        for b, y in enumerate(words[i:j], 1):
                            row.append(min(old[b] + 1, row[-1] + 1, old[b - 1] + (x != y)))
                    if row[-1] <= allowed:
                        hits.append((2 * row[-1] - len(t), row[-1], i, j, name, row[-1]))
    found = []
    for _, _, i, j, name, different in sorted(hits):
        if all(j <= a or b <= i for a, b, _, _ in found):
            found.append((i, j, name, different))
    return [(name, spans[i][0], spans[j - 1][1], different) for i, j, name, different in sorted(found)]


def test_operator_against_brute_force(spark):
    templates = {
        "a-header": "This program is licensed to you under the terms of the Alpha Agreement as published by Alpha",
        "b-header": "Use of this file is subject to the Beta License version two and to nothing else whatsoever here",
        "c-notice": "Copyright waived under Gamma rules",
    }
    r = random.Random(4)
    rows = []
    for i in range(60):
        text = prose(r, r.randint(0, 30))
        for _ in range(r.randint(0, 4)):
            words = r.choice(list(templates.values())).split()
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                k = r.randrange(len(words))
                words[k : k + 1] = r.choice([["odd"], [], [words[k], "more"]])
            text += " " + " ".join(words) + " " + prose(r, r.randint(1, 30))
        rows.append((i, text))
    got = {}
    for x in L.scan_licenses(documents(spark, rows), templates).collect():
        got.setdefault(x["doc_id"], []).append((x["license"], x["start"], x["end"], x["n_different"]))
    for i, text in rows:
        want = brute_scan(text, templates)
        found = sorted(got.get(i, []), key=lambda h: h[1])
        # The same notices with the same numbers of differences; of stretches that are equally near, either end may be taken.
        assert [(n, d) for n, _, _, d in found] == [(n, d) for n, _, _, d in want], text
        assert all(a < y and x < b for (_, a, b, _), (_, x, y, _) in zip(found, want, strict=True))


SYSTEM = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(SYSTEM), reason="no license texts on this machine")
def test_bodies_of_long_licenses(spark):
    bodies = L.read_templates(SYSTEM)
    r = random.Random(2)
    rows, want = [], []
    for i, (name, text) in enumerate((n, t) for n, t in sorted(bodies.items()) if n.startswith(("Apache-2.0", "GPL-3", "LGPL-2.1", "MPL-2.0"))):
        words = text.split(" ")
        plain = [k for k, w in enumerate(words) if w.isalpha()]
        for k in r.sample(plain, 9):
            words[k] = "quux"
        rows.append((i, prose(r, 300) + " " + " ".join(words) + " " + prose(r, 300)))
        want.append((i, name, 9))
    got = [(x["doc_id"], x["license"], x["n_different"]) for x in L.scan_licenses(documents(spark, rows), L.TEMPLATES | bodies).collect()]
    assert len(want) == 4 and sorted(got) == want


def test_templates_of_a_folder(tmp_path):
    (tmp_path / "a").write_text("Some terms of use")
    (tmp_path / "b").write_text("some TERMS\nof use.")
    (tmp_path / "c").write_bytes(b"other \xff terms")
    (tmp_path / "sub").mkdir()
    assert sorted(L.read_templates(str(tmp_path))) == ["b-body", "c-body"]
