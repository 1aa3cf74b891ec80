import random
import re
from collections import Counter

from tabledocs.llm.quality import cleaned, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def test_measures(documents):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\x0by\x0cz q r", "é" * 9, "w " * 30_000]
    for _ in range(150):
        vocabulary = [f"v{k}" for k in range(rng.choice([2, 5, 40]))]
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\r\n", "\x0b", " | ", "#. "]) for _ in range(rng.randint(1, 150))))
    rows = list(enumerate(texts))
    names = ("q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words", "q_base_failed")
    got = {r["doc_id"]: tuple(r[x] for x in names) for r in quality(documents(*rows)).collect()}
    assert got == {d: brute(t) for d, t in rows}


def prose(n, seed=1):
    rng = random.Random(seed)
    return ".\n".join(" ".join(f"w{rng.randrange(999)}" for _ in range(12)) for _ in range(n)) + "."


def test_lines_and_verdict(documents):
    good = prose(10)
    menu = "Home | News | Sport | Contact | More"
    shout = " ".join(f"LOUD{k}!!" for k in range(100))
    rows = [
        (1, good), (2, f"{menu}\n{good}\nAll rights reserved."), (3, "\n".join(f"a{k} | b{k} | c{k}" for k in range(60))), (4, shout),
        (5, " ".join(f"x{k}###" for k in range(90))), (6, "short."), (7, None), (8, good.replace("\n", " ")), (None, good), (1, good),
    ]
    frame = documents(*rows)
    got = {(r["doc_id"], r["text"]): (r["q_kept"], r["q_lines_removed"], r["q_text"]) for r in quality(frame).collect()}
    assert got[1, good] == (True, 0, good) and got[None, good][0]
    assert got[2, rows[1][1]] == (True, 2, good)
    assert [got[r][0] for r in rows[2:7]] == [False] * 5 and got[rows[7]][0]
    left = cleaned(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"], r["n_chars"]) for r in left.collect()) == sorted(
        (d or 0, t, len(t)) for d, t in [(1, good), (1, good), (2, good), (8, rows[7][1]), (None, good)]
    )
    assert quality(documents()).count() == 0 and cleaned(documents()).count() == 0
