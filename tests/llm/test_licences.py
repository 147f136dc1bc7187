import random
import re

import numpy as np

from loamline.llm import licences as L
from loamline.llm import queries

INDEX = L.build_index()
CACHE = L.BoundedCache(L._hash)


def full_alignment(template, doc):
    """Unbanded local alignment: the most matched words of a best-scoring path."""
    n, m = len(template), len(doc)
    score = np.zeros((n + 1, m + 1), int)
    matched = np.zeros((n + 1, m + 1), int)
    best = (0, 0)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            same = template[i - 1] == doc[j - 1]
            options = [(0, 0), (score[i - 1, j - 1] + (2 if same else -1), matched[i - 1, j - 1] + same), (score[i - 1, j] - 1, matched[i - 1, j]), (score[i, j - 1] - 1, matched[i, j - 1])]
            score[i, j], matched[i, j] = max(options)
            best = max(best, (score[i, j], matched[i, j]))
    return best


def test_banded_equals_full_within_the_band():
    random.seed(5)
    for _ in range(60):
        template = [random.randrange(30) for _ in range(25)]
        copy = [w for w in template if random.random() > 0.1]
        for _ in range(2):
            copy.insert(random.randrange(len(copy)), 99)
        doc = [100 + random.randrange(5) for _ in range(12)] + copy + [100] * 12
        matched, first, end = L.align(template, doc, 12)
        assert matched == full_alignment(template, doc)[1] and 0 <= first < end <= len(doc)


def scan(text):
    return L.scan(text, INDEX, CACHE)


def test_whole_templates_and_edits():
    for name, text in L.TEMPLATES.items():
        found = {m[0]: m for m in scan("Some words come before. " + text + " And some after.")}
        assert found[name][3] == 1.0 and found[name][4] == 24
    words = L.TEMPLATES["mit"].split()
    words[10:12] = ["other"]
    words.insert(40, "inserted")
    found = {m[0]: m for m in scan(" ".join(words))}
    assert found["mit"][3] > 0.95


def test_copies_with_insertions_and_partial_copies():
    for name in ("mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0-header", "zlib"):
        words = L.TEMPLATES[name].split()
        for cut in (len(words) // 3, len(words) // 2):
            text = " ".join(["Before."] + words[:cut] + [f"inserted{i}" for i in range(31)] + words[cut:] + ["after"])
            (m,) = [m for m in scan(text) if m[0] == name]
            assert m[3] == 1.0 and not m[6] and text[m[4] : m[5]].split()[-1] == words[-1].rstrip(".") and m[4] == 8
        (m,) = [m for m in scan(" ".join(words[: len(words) // 2])) if m[0] == name]
        assert 0.4 < m[3] < 0.6 and m[6]
        middle = words[:30] + [f"other{i}" for i in range(len(words) - 55)] + words[-25:]  # a replaced middle
        (m,) = [m for m in scan(" ".join(middle)) if m[0] == name]
        assert m[1] >= 55
    found = {m[0]: m for m in scan(L.TEMPLATES["bsd-3-clause"])}
    assert found["bsd-3-clause"][3] == found["bsd-2-clause"][3] == 1.0
    assert [m[3] for m in scan((L.TEMPLATES["zlib"] + " ") * 3) if m[0] == "zlib"] == [1.0] * 3


def test_spans_are_character_places():
    text = "Näh 日本. Released under the MIT License. x\n\nreleased UNDER the mit, license!"
    found = scan(text)
    assert [text[m[4] : m[5]] for m in found] == ["Released under the MIT License", "released UNDER the mit, license"]
    assert scan("") == [] and scan(None) == [] and scan("MIT License") == []


def test_winnowing_guarantee():
    random.seed(1)
    for _ in range(50):
        a = np.array([random.randrange(50) for _ in range(60)], np.uint64)
        b = np.concatenate([np.array([random.randrange(60, 99) for _ in range(9)], np.uint64), a[20:25], np.array([random.randrange(60, 99) for _ in range(9)], np.uint64)])
        g, h = L.grams(a, 3), L.grams(b, 3)
        assert set(g[L.winnow(g, 3)].tolist()) & set(h[L.winnow(h, 3)].tolist())


def test_query_finds_every_notice(spark, sf, corpus):
    got = {}
    for r in queries.op4_licences(spark, sf).collect():
        got.setdefault((r.doc_id, r.template), []).append((r.start, r.end))
    for doc_id, text in corpus:
        for name in (n for n in L.TEMPLATES if n.endswith("notice")):
            at = [m.start() for m in re.finditer(re.escape(L.TEMPLATES[name]), text)]
            assert [s for s, _ in sorted(got.get((doc_id, name), []))] == at


def test_odd_rows(odd, none):
    assert L.scan_licences(odd).count() == 0 and L.scan_licences(none).count() == 0
    from pyspark.sql import functions as F

    out = L.scan_licences(odd.withColumn("text", F.concat("text", F.lit(" Released under the MIT License."))))
    assert out.count() == 9 and out.columns.count("template") == 1


def test_recall_of_edited_copies():
    """Copies with 3 and 5 of 100 words changed, lost or added, amid other words: at least 9 of 10 are reported at 0.8 coverage."""
    random.seed(12)
    long = [n for n, t in L.TEMPLATES.items() if len(t.split()) >= 30]
    for rate in (0.03, 0.05):
        found = total = 0
        for name in long:
            for _ in range(6):
                words = []
                for w in L.TEMPLATES[name].split():
                    r = random.random()
                    words += [] if r < rate / 3 else [w, "added"] if r < 2 * rate / 3 else ["changed"] if r < rate else [w]
                noise = [f"noise{random.randrange(500)}" for _ in range(80)]
                total += 1
                found += any(m[0] == name and m[3] >= 0.8 for m in scan(" ".join(noise[:40] + words + noise[40:])))
        assert found / total >= 0.9, (rate, found, total)
