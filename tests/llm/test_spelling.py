import random
import re
import zlib
from collections import Counter

from folioforge.llm import spelling as S
from helpers import documents, long_text


def brute(rows, letters=6, occurrences=5, ratio=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= occurrences}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    others = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(others[w]), words.get(form[w])))
    return sorted(out, key=repr)


def texts(seed=3, size=400):
    """Few roots and many variants by one letter, so that words have several neighbours and chains occur; equal letters side by side."""
    r = random.Random(seed)
    roots = ["lantern", "aaaaaaa", "bookkeeper", "Überfluß", "élévation", "lanterns", "missing", "ÀÈÌÒÙàèìòù"]
    forms = list(roots)
    for w in roots * 5:
        k, c = r.randrange(len(w)), r.choice("abé")
        forms.append(r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]]))
    weights = [200 if w in roots[:3] else 40 if w in roots else r.choice([1, 2, 8]) for w in forms]
    out = [(i, " ".join(r.choices(forms, weights, k=r.randint(0, 40)))) for i in range(size)]
    return [*out, (None, "lantern lantern " * 9), (3, None), (4, ""), (5, "x1y2_z-?"), (5, "LANTERN lantérn"), (5, "LANTERN lantérn")]


def test_against_brute_force(spark):
    rows = texts()
    got = sorted(map(tuple, S.spelling_report(documents(spark, rows, extra=True)).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[1] and r[1] != r[2] for r in got) and max(r[4] for r in got) > 3


def test_other_rules(spark):
    rows = [*texts(8, 60), (9, long_text(20_000))]
    got = S.spelling_report(documents(spark, rows), S.Spelling(letters=1, occurrences=1, ratio=2)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 1, 1, 2)


def test_empty(spark):
    df = documents(spark, [(1, "word")])
    assert S.spelling_report(df).collect() == [] == S.spelling_report(df.where("false")).collect()
