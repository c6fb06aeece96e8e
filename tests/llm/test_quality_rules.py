import math
import random
import re
from collections import Counter

import pytest

from encore.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, lang string, kept string, n_words int"
WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, c in Counter(windows).items() if c > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


def hists(text):
    text = text or ""
    words = [w.lower() for w in WORDS.findall(text)]
    kinds = Counter()
    for c in text:
        kinds["space" if c in " \t\n\v\f\r" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "symbol" if c in "#*$%&|<>"
              else "beyond" if ord(c) > 127 else "low" if "a" <= c <= "z" else "punct" if 33 <= ord(c) < 127 else "low"] += 1
    count = Counter(words)
    chars = [kinds[k] for k in ("space", "upper", "digit", "symbol", "punct", "beyond", "low")]
    common = [count[w] for w in Q.WORDS]
    return chars, [*common, len(words) - sum(common)]


def distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    term = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0
    return math.sqrt(max(0, sum(term(a, b) + term(b, a) for a, b in zip(p, q, strict=True)) / 2))


def corpus():
    rng = random.Random(9)
    rows = [(0, None, "en"), (1, "", "en"), (2, " \n\t ", None), (3, "one two", "xx"), (4, "a b c d e a b c d e f", "en"),
            (5, "x\ny\nx\n\n\nx ", "en"), (6, "w " * 500, "en"), (7, "É" * 40 + " <b>|#", "fr")]
    for i in range(8, 60):
        lang = rng.choice(["en", "de", "fr", None])
        common = Q.COMMON_WORDS[lang or "es"]
        words = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdeü") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(5, 300))]
        if rng.random() < 0.2:
            words = [w.upper() + "!!" for w in words]
        elif rng.random() < 0.2:
            words = [w + "$%" for w in words]
        elif rng.random() < 0.3:
            words += words[:40]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", "  ", "\t"]) for w in words), lang))
    return rows


@pytest.mark.parametrize("min_reference", [500, 10**9])
def test_equals_brute_force(spark, min_reference):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in rows], SCHEMA)
    got = {r["doc_id"]: r for r in Q.quality_rules(frame, min_reference=min_reference).collect()}
    assert len(got) == len(rows)
    refs = {}
    for _, t, lang in rows:
        if not base(t)[5]:
            for key in (lang, "*"):
                for k, h in enumerate(hists(t)):
                    refs[key, k] = [a + b for a, b in zip(refs.get((key, k), [0] * len(h)), h, strict=True)]
    for i, t, lang in rows:
        r, want = got[i], base(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, (i, t)
        key = lang if sum(refs.get((lang, 0), [0])) >= min_reference else "*"
        far = [distance(h, refs[key, k]) if want[0] >= 30 else None for k, h in enumerate(hists(t))]
        for name, value in zip(("char_distance", "word_distance"), far, strict=True):
            assert r[name] == (None if value is None else pytest.approx(value, abs=1e-9))
        assert r["kept"] == (not want[5] and (far[0] or 0) <= 0.27 and (far[1] or 0) <= 0.6)


def test_empty_table(spark):
    assert Q.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a b", "en", "x", 1)], SCHEMA)
    for plan in (Q.text_counts(frame), Q.quality_rules(frame)):
        assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()
