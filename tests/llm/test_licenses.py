import random

from tabledocs.llm.licenses import TEMPLATES, LicenseOptions, aligned, license_notices, notices, words_of


def test_alignment():
    template = "a b c d e f".split()
    assert aligned(template, template) == [(k, k) for k in range(6)]
    assert aligned("x a b y d c e f z".split(), template) in ([(0, 1), (1, 2), (2, 5), (4, 6), (5, 7)], [(0, 1), (1, 2), (3, 4), (4, 6), (5, 7)])
    assert aligned([], template) == [] and aligned(template, []) == []
    assert aligned("q q a a q".split(), "a a".split()) == []
    assert aligned("x the a the y".split(), "x the b the y".split()) == [(0, 0), (1, 1), (3, 3), (4, 4)]


def test_rows(documents):
    notice = "Released under the MIT License."
    rows = [(1, f"text\n{notice}"), (2, f"{notice}\n{notice}\nmore"), (3, "the mit license under released"), (4, None), (5, ""), (None, notice.upper()), (1, f"text\n{notice}"), (6, "w " * 50_000)]
    got = [(r["doc_id"], r["license"], r["aligned"]) for r in license_notices(documents(*rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, "MIT", 5), (1, "MIT", 5), (2, "MIT", 5), (None, "MIT", 5)], key=str)
    assert license_notices(documents()).count() == 0
    assert license_notices(documents(*rows), LicenseOptions(templates=())).count() == 0


def test_given_lines_and_wrapped_notices():
    templates = [(name, words_of(text)) for name, text in TEMPLATES]

    def found(text):
        return sorted({name for name, *_ in notices(text, LicenseOptions(), templates)})

    gpl, cc = "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    assert [found(f"some text\n{x}\nmore") for x in (gpl, cc, apache, mit)] == [["GPL"], ["CC-BY-NC"], ["Apache-2.0"], ["MIT"]]
    assert found(gpl.replace("General", "Lesser General")) == ["LGPL"] and found(gpl.replace("General", "Affero General")) == ["AGPL"]
    assert [found(cc.replace("-NC", x)) for x in ("", "-SA", "-NC-ND")] == [["CC-BY"], ["CC-BY-SA"], ["CC-BY-NC-ND"]]
    long = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and\nassociated documentation files"
    assert found(f"{long}\nwords between\n{long}") == ["MIT"]
    wrapped = "Released under\nthe MIT License."
    assert found(f"{wrapped}\n{wrapped}") == ["MIT"] and found(f"{wrapped}\n{gpl}\n{wrapped}\n{cc}") == ["CC-BY-NC", "GPL", "MIT"]
    assert found("the license of this work is public and general") == []


def found_in(text):
    return notices(text, LicenseOptions(), [(name, words_of(t)) for name, t in TEMPLATES])


def test_names_tell_licenses_apart():
    """Words around the name do not make a notice, and a longer name is another license."""
    for text in (
        "Licensed under the Eclipse (or Mozilla) Public License, Version 2.0", "Released under the BSD / ISC / new license", "He licensed it under a CC deal by 4.0 percent",
        "released by the band under the label; the MIT press has a license", "Licensed under the GNU Free Documentation License, version 1.3", "Licensed under the General Public Library License, version",
    ):
        assert found_in(text) == [], text
    base = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    for more, name in (("", "CC-BY"), ("-NonCommercial", "CC-BY-NC"), ("-ShareAlike", "CC-BY-SA"), ("-NonCommercial-ShareAlike", "CC-BY-NC-SA"), ("-NoDerivatives", "CC-BY-ND"), ("-NonCommercial-NoDerivatives", "CC-BY-NC-ND")):
        assert {n[0] for n in found_in("words before. " + base.format(more) + " Words after it.")} == {name}


def test_places():
    mit = "Released under the MIT License."
    (row,) = found_in(f"a b {mit} c\n{mit}\nd e\nReleased under\nthe MIT License")
    assert row[:4] == ("MIT", 0, 5, 5) and row[4] == [(2, 7, 5), (8, 13, 5), (15, 20, 5)]


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_against_common_subsequences():
    """Aligned words are a common subsequence; with no word twice it is a longest one."""
    rng = random.Random(5)
    for _ in range(300):
        words = [f"w{k}" for k in range(12)]
        a, b = ([rng.choice(words) for _ in range(rng.randrange(14))] for _ in range(2))
        pairs = aligned(a, b)
        assert all(b[i] == a[j] for i, j in pairs) and all(x < y for p, q in zip(pairs, pairs[1:]) for x, y in zip(p, q))
        assert len(pairs) <= longest_common(a, b)
        once, other = rng.sample(words, rng.randrange(13)), rng.sample(words, rng.randrange(13))
        assert len(aligned(once, other)) == longest_common(once, other)
