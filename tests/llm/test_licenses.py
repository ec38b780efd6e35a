"""License scans against a plain version."""

import random
import re
from collections import Counter
from math import log, sqrt

from bazaarlens.llm import licenses as L
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
FILES = [
    (1, "repo/LICENSE", MIT), (2, "repo/a/code.txt", "plain text of no interest at all"),
    (3, "repo/a/b/COPYING.txt", GPL), (4, "repo/a/b/c/deep.txt", None), (5, "repo/a/b/own.txt", f"words before\n{MIT}\nwords after"),
    (6, "other/file.txt", "nothing here"), (7, None, "nothing here"), (8, "top.txt", ""), (9, "repo/LICENSE", MIT),
    (None, "repo/a/null.txt", "x"), (10, "third/notes.txt", f"see\n{GPL}"), (11, "third/x/y.txt", "no license"),
    (12, "fourth/readme.txt", "long story " * 50 + "\n" + GPL), (13, "fourth/z.txt", "no"), (14, "repobis/q.txt", "no"),
    (15, "fifth/long.txt", "word " * 300 + GPL + " word" * 300),
]


def test_inheritance_and_awkward_rows(spark):
    frame = spark.createDataFrame([(*f, "x") for f in FILES], "doc_id long, path string, text string, license string").repartition(3)
    got = {(r["doc_id"], r["path"]): (r["license"], r["origin"], r["inherited_from"]) for r in L.scan(frame).collect()}
    assert len(got) == len(FILES)
    want = {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "repo"), 3: ("GPL-3.0", "own", None),
        4: ("GPL-3.0", "inherited", "repo/a/b"), 5: ("MIT", "own", None), 6: (None, "none", None), 7: (None, "none", None),
        8: (None, "none", None), 9: ("MIT", "own", None), None: ("MIT", "inherited", "repo"), 10: ("GPL-3.0", "own", None),
        11: ("GPL-3.0", "inherited", "third"), 12: ("GPL-3.0", "own", None), 13: (None, "none", None), 14: (None, "none", None),
        15: ("GPL-3.0", "own", None),
    }
    for (i, path), value in got.items():
        assert value == want[i], (i, path, value)


def test_cosine_is_that_of_the_vectors():
    matcher = L.Matcher({"the": 90, "license": 5}, 100)
    passage = L.words_of("licensed under the apache license version 2.0 or so")
    idf = lambda w: log(101 / ({"the": 90, "license": 5}.get(w, 0) + 1)) + 1 if w in L.VOCABULARY else matcher.other
    template = L.words_of(L.TEMPLATES[0][1])
    dot = sum(idf(w) ** 2 for w in set(template) & set(passage))
    cosine = dot / sqrt(sum(idf(w) ** 2 for w in passage)) / sqrt(sum(idf(w) ** 2 for w in template))
    assert abs(matcher.best(passage)[0] - cosine) < 1e-9 and matcher.best(passage)[1] == "Apache-2.0"


def test_templates_find_themselves():
    matcher = L.Matcher({}, 1000)
    for name, text in L.TEMPLATES:
        assert matcher.scan(f"before\n{text}\nafter")[0] == name


def test_test_data(spark):
    known = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", MIT: "MIT", GPL: "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in RUNNERS["op4_license_scan"](spark, SMALL).collect():
        expected = {v for k, v in known.items() if k in texts[r["doc_id"]]}
        assert (r["origin"] == "own") == bool(expected) and (not expected or r["license"] in expected)


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_notice_with_other_words_on_its_line(spark):
    """With the document frequencies of sf0.1's order, and in a long line of a file."""
    notices = {MIT: "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", GPL: "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    matcher = L.Matcher({"the": 900, "license": 500, "under": 500, "licensed": 400, "version": 300, "mit": 150}, 10_000)
    for notice, name in notices.items():
        for n in (5, 28, 100, 400):
            others = [f"other{k}" for k in range(n)]
            for at in (0, n // 2, n):
                text = " ".join([*others[:at], notice, *others[at:]])
                assert matcher.scan(text)[:2] == (name, 1.0)
    assert matcher.scan("Copyright 2020 Some Name. " + MIT)[0] == "MIT"
    frame = spark.createDataFrame(FILES, "doc_id long, path string, text string")
    assert {(r["license"], r["origin"]) for r in L.scan(frame).collect() if r["doc_id"] == 15} == {("GPL-3.0", "own")}


def test_passages_against_all_windows():
    """The bounds leave out nothing that reaches the threshold."""
    rnd = random.Random(4)
    matcher = L.Matcher({"the": 90, "license": 5, "of": 80, "under": 20, "version": 9}, 100)
    for _ in range(150):
        words = L.words_of(rnd.choice(L.TEMPLATES)[1]) + [rnd.choice(L.VOCABULARY[:40] + [f"x{k}" for k in range(9)]) for _ in range(rnd.randint(0, 90))]
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = rnd.choice(["the", "x1", "y"])
        n, runs = len(words), {}
        for t, (name, template) in enumerate(L.TEMPLATES):
            size = len(L.words_of(template))
            spans = {(i, i + size) for i in range(n - size + 1)} | ({(0, n)} if n <= 80 else {(i, min(i + 40, n)) for i in range(0, n - 20, 20)})
            vector = {w: k * matcher.idf[w] for w, k in Counter(L.words_of(template)).items()}
            for a, b in spans:
                own = {w: k * matcher.idf.get(w, matcher.other) for w, k in Counter(words[a:b]).items()}
                length = lambda v: sqrt(sum(y * y for y in v.values()))
                number = re.search(r"-([0-9]+)[.]([0-9]+)$", name)
                wanted = {f"{number[1]}.{number[2]}", f"v{number[1]}.{number[2]}"} | ({number[1], f"v{number[1]}"} if number[2] == "0" else set()) if number else set(words)
                if not wanted & set(words[a:b]) or {"not", "never"} & set(words[max(a - 4, 0):b]) - set(vector):
                    continue
                runs[t, a, b] = sum(y * own.get(w, 0) for w, y in vector.items()) / length(own) / length(vector)
        got = {(t, a, b): c for t in matcher.possible(words) for a, b, c in matcher.passages(words, t)}
        want = {k: c for k, c in runs.items() if c >= L.THRESHOLD}
        assert got.keys() == want.keys() and all(abs(got[k] - c) < 1e-9 for k, c in want.items())
        assert matcher.scan(" ".join(words))[1] == round(max(want.values(), default=0.0), 6)


FREQUENT = {"the": 900, "license": 500, "under": 500, "licensed": 400, "version": 300, "mit": 150, "of": 950, "to": 950, "and": 950, "or": 800, "in": 950}


def test_headings_versions_and_negations():
    """What decides is the version, whatever the corpus holds, and a denied license is none."""
    probes = [
        ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n", "GPL-2.0"), ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", "GPL-3.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"), ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1", "LGPL-2.1"),
        ("Apache License\n Version 2.0, January 2004\n", "Apache-2.0"), ("We do not license under the MIT License.", None),
        ("We do not license under the MIT License. It is not for us.", None), ("This is not a draft. Released under the MIT License.", "MIT"),
        ("Never released under the MIT License!", None), ("Licensed under the GNU General Public License, version 1.", None),
        ("# Licensed under the Apache\n# License, Version 2.0.\n", "Apache-2.0"),
        ("/* Permission to use, copy, modify, and/or distribute this\n * software for any purpose with or without fee\n * is hereby granted */", "ISC"),
    ]
    for df in (FREQUENT, {}, {w: 100 for w in L.VOCABULARY}, {"2": 900, "3": 10}, {"3": 900, "2": 10}):
        matcher = L.Matcher(df, 1000)
        for text, name in probes:
            assert matcher.scan(text)[0] == name, (text, matcher.scan(text))


def test_wrapped_notices_score_as_on_one_line():
    matcher = L.Matcher(FREQUENT, 1000)
    for name, text in L.TEMPLATES:
        words = text.split(" ")
        for width in (2, 3, 7):
            wrapped = "\n".join(" * " + " ".join(words[k:k + width]) for k in range(0, len(words), width))
            assert matcher.scan(f"/*\n{wrapped}\n */ int main")[:2] == (name, 1.0)


def test_license_file_is_one_by_its_text():
    """The text of an MIT file, under another name, holds for its directory."""
    matcher = L.Matcher(FREQUENT, 1000)
    sentences = [t for name, t in L.TEMPLATES if name == "MIT"][2:]
    name, cosine, share = matcher.scan("MIT License\n\nCopyright (c) 2020 Some Name\n\n" + "\n".join(sentences))
    assert name == "MIT" and cosine == 1.0 and share >= L.FILE_SHARE


def test_very_long_text():
    matcher = L.Matcher(FREQUENT, 1000)
    prose = "the use of this software and the copies of it in all " * 20_000
    assert matcher.scan(prose)[0] is None
    assert matcher.scan(prose + "\n" + GPL + "\n" + prose)[:2] == ("GPL-3.0", 1.0)
