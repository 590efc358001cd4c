from __future__ import annotations

import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import MEDIUM

from finloom.llm.license_scan import _WORD, TEMPLATES, Templates, load_templates, patience_align, scan_licenses, words_of
from finloom.llm.queries import op7_license_scan
from tests.llm.helpers import awkward, documents

WORDS = st.lists(st.sampled_from("abcdefgh"), max_size=14)


def longest(a, b) -> int:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_alignment_is_a_common_subsequence(a, b):
    pairs = patience_align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(pairs) <= longest(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), unique=True, max_size=30), st.data())
def test_alignment_of_unique_words_is_longest(words, data):
    a = [str(x) for x in words]
    b = [str(x) for x in data.draw(st.permutations(words))] if words else []
    assert len(patience_align(a, b)) == longest(a, b)


def test_every_template_finds_itself():
    known = Templates(TEMPLATES)
    for name, text in TEMPLATES:
        prose = "Words before it. "
        found = known.find(prose + text + " Words after.", 0.8)
        assert [(x[0], x[3], x[4]) for x in found] == [(name, len(words_of(text)), len(words_of(text)))]
        start, end = found[0][1:3]
        assert (prose + text)[start:end] == text.rstrip(".").rstrip("/")


def test_edits_repeats_and_noise():
    known = Templates(TEMPLATES)
    mit = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 200)
    words = mit.split()
    for i in range(5, len(words), 12):
        words[i] = "changed"
    assert [x[0] for x in known.find(" ".join(words), 0.8)] == ["MIT"]
    assert known.find(" ".join(words[: len(words) // 2]), 0.8) == []
    twice = f"{mit}\n\nReleased under the MIT License.\n\n{mit}\nLicensed under CC BY-NC 4.0."
    assert [x[0] for x in known.find(twice, 0.8)] == ["MIT", "MIT", "MIT", "CC-BY-NC-4.0"]
    assert known.find("a license to use the software of the license " * 200, 0.8) == []


def test_adjacent_repeats():
    known = Templates(TEMPLATES)
    for name, text in TEMPLATES:
        n = len(words_of(text))
        for times in (2, 3, 6):
            copies = [text] * times
            found = known.find("Words before. " + "\n".join(copies) + "\nWords after.", 0.8)
            assert [(x[0], x[3]) for x in found] == [(name, n)] * times
    short = "under the MIT License.\n" * 5
    assert [(x[0], x[3]) for x in known.find(short, 0.8)] == [("MIT", 4)] * 5
    mixed = "Released under the MIT License.\nunder the MIT License.\n" * 3
    assert [x[3] for x in known.find(mixed, 0.8)] == [5, 4] * 3


def _short() -> list[tuple[str, list[str]]]:
    return [(n, w) for n, t in TEMPLATES if len(w := words_of(t)) <= 20]


def _windows(own: list[str], template: list[str], coverage: float) -> list[tuple[int, int]]:
    """By brute force: the stretches of the template's length (and its slack) whose
    longest common subsequence with it covers enough of it."""
    out, size = [], len(template)
    wanted = Counter(template)
    for i in range(max(1, len(own) - size + 1)):
        part = own[i : i + size]
        if sum((Counter(part) & wanted).values()) >= coverage * size - 1e-9 and longest(part, template) >= coverage * size - 1e-9:
            out.append((i, i + len(part)))
    return out


def test_query(spark):
    """All finds of the query against brute force, both ways: every stretch that
    covers a short template overlaps a find, and every find of a short template
    overlaps such a stretch, with the right name, span and number of words."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()}
    rows = op7_license_scan(spark, MEDIUM).collect()
    assert len(rows) == len(texts)
    n_found = 0
    for r in rows:
        text = texts[r.doc_id] or ""
        own = words_of(text)
        places = [m.span() for m in _WORD.finditer(text)]
        finds = [x.split(":") for x in r.spans.split(",") if x]
        assert r.n_licenses == len(finds) and r.licenses == ",".join(sorted({x[0] for x in finds}))
        at = {a: i for i, (a, _) in enumerate(places)}
        ends = {b: i for i, (_, b) in enumerate(places)}
        spans = [(x[0], at[int(x[1])], ends[int(x[2])] + 1, int(x[3]), int(x[4])) for x in finds]
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
        covered = {(n, tuple(w)): _windows(own, w, 0.8) for n, w in _short()}
        for (name, words), stretches in covered.items():
            for a, b in stretches:
                assert any(c < b and a < d for _, c, d, _, _ in spans), (r.doc_id, name)
        for name, a, b, matched, size in spans:
            n_found += 1
            assert longest(own[a:b], next(w for n, t in TEMPLATES if n == name and len(w := words_of(t)) == size)) >= matched >= 0.8 * size - 1e-9
            if size <= 20:
                same = [s for (n, w), found in covered.items() if n == name and len(w) == size for s in found]
                assert any(c < b and a < d for c, d in same), (r.doc_id, name)
    assert n_found > 10


def test_planted_notices():
    """Random numbers of notices among random words: exactly those are found."""
    rng = random.Random(4)
    known = Templates(TEMPLATES)
    longest_of = {}
    for name, text in TEMPLATES:
        longest_of[name] = max(longest_of.get(name, ""), text, key=len)
    for _ in range(60):
        planted = [rng.choice(list(longest_of.items())) for _ in range(rng.randrange(5))]
        parts = [" ".join(rng.choices("alpha beta gamma delta eps".split(), k=rng.randrange(12)))]
        for _, text in planted:
            parts += [text, " ".join(rng.choices("alpha beta gamma delta eps".split(), k=rng.randrange(12)))]
        found = known.find(rng.choice(["\n", " ", "\n\n"]).join(parts), 0.8)
        assert [(x[0], x[3], x[4]) for x in found] == [(n, len(words_of(t)), len(words_of(t))) for n, t in planted]


def test_up_to_twenty_repeats():
    known = Templates(TEMPLATES)
    for times in (1, 4, 10, 20):
        for text in ("Licensed under CC BY 4.0. ", "Released under the MIT License.\n"):
            assert len(known.find(text * times, 0.8)) == times


def test_load_templates(tmp_path):
    (tmp_path / "Own-1.0").write_text("You may do with this text whatever you like, whenever you like.")
    (tmp_path / "Own").symlink_to(tmp_path / "Own-1.0")
    more = load_templates(str(tmp_path))
    assert [n for n, _ in more] == ["Own-1.0"]
    assert [x[0] for x in Templates(TEMPLATES + more).find("So: you may do with this text whatever you like, whenever you like!", 0.8)] == ["Own-1.0"]


def test_awkward_and_empty(spark):
    assert scan_licenses(awkward(spark)).count() == 11
    assert scan_licenses(documents(spark, [])).count() == 0


def test_many_notices_in_a_text():
    """Finds are as many as notices, in order, and never overlap."""
    known = Templates(TEMPLATES)
    text = "\n\n and then ".join(TEMPLATES[i % 2][1] for i in range(3_000))
    found = known.find(text, 0.8)
    assert [x[0] for x in found] == [TEMPLATES[i % 2][0] for i in range(3_000)]
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))
