import math
import re
import textwrap
from collections import Counter

from quarry.llm import licenses
from quarry.llm.queries import op3_license_scan


def terms(text):
    return [t for t in (x.strip(".") for x in re.split(r"[^\w.]+|_", (text or "").lower())) if t]


def units(path, text):
    """All stretches of up to WINDOW lines between lines with template terms, longer paragraphs, a licence file as a whole."""
    known = {t for _, x in licenses.TEMPLATES for t in terms(x)}
    lines = [terms(x) for x in (text or "").split("\n")]
    own = [k for k, t in enumerate(lines) if set(t) & known]
    spans = {(i, j) for i in own for j in own if i <= j < i + licenses.WINDOW}
    gaps = [-1, *(k for k, t in enumerate(lines) if not t), len(lines)]
    spans |= {(a + 1, b - 1) for a, b in zip(gaps, gaps[1:]) if b - a - 1 > licenses.WINDOW}
    if re.match(licenses.FILE_NAME, path.rsplit("/", 1)[-1]):
        spans.add((0, len(lines) - 1))
    for i, j in sorted(spans):
        found = [t for line in lines[i : j + 1] for t in line]
        if len(set(found) & known) >= 2:
            yield found


def by_hand(files, threshold=0.75):
    """files: [(path, key, text)] -> {(path, key): (license, rounded similarity, found, licence_dir)}."""
    n = max(1, len(files))
    df = Counter(t for _, _, x in files for t in set(terms(x)))
    idf = lambda t: math.log((n + 1) / (max(1, df[t]) + 1)) + 1
    vectors = [{t: c * idf(t) for t, c in Counter(terms(x)).items()} for _, x in licenses.TEMPLATES]
    lengths = [math.sqrt(sum(v * v for v in w.values())) for w in vectors]
    own = {}
    for path, key, text in files:
        best = None
        for u in units(path, text):
            mine = {t: c * idf(t) for t, c in Counter(u).items()}
            norm = math.sqrt(sum(v * v for v in mine.values()))
            for k, (w, length) in enumerate(zip(vectors, lengths)):
                s = sum(v * w.get(t, 0) for t, v in mine.items()) / norm / length
                if round(s, 9) >= threshold and (best is None or (round(-s, 9), k) < best):
                    best = (round(-s, 9), k)
        if best:
            own[path, key] = (licenses.TEMPLATES[best[1]][0], -best[0])
    folder = lambda p: p.rsplit("/", 1)[0] if "/" in p else ""
    held = {}
    for (path, key), (name, s) in own.items():
        if re.match(licenses.FILE_NAME, path.rsplit("/", 1)[-1]):
            held.setdefault(folder(path), []).append((-s, name))
    out = {}
    for path, key, _ in files:
        if (path, key) in own:
            out[path, key] = (*own[path, key], "own", None)
            continue
        d = folder(path)
        while d not in held and d:
            d = folder(d)
        out[path, key] = (min(held[d])[1], None, "inherited", d) if d in held else (None, None, "none", None)
    return out


def made(rows):
    return {(r.path, r[1]): (r.license, r.similarity and round(r.similarity, 6), r.found, r.licence_dir) for r in rows}


def rounded(want):
    return {k: (v[0], v[1] and round(v[1], 6), v[2], v[3]) for k, v in want.items()}


def test_headers_files_and_inheritance(spark):
    mit, apache = licenses.TEMPLATES[4][1], licenses.TEMPLATES[0][1]
    files = [("LICENSE", 1, "Copyright someone\n" + mit), ("a/COPYING", 2, apache.upper()), ("a/b/x.c", 3, "int main"),
             ("a/b/c/y.c", 4, "code here\n// " + licenses.TEMPLATES[5][1]), ("d/z.c", 5, None), ("top.c", 6, ""),
             ("ab/w.c", 7, "the of and to this work is under"), ("d/e/LICENCE.txt", 8, "nothing to see " * 20), ("d/e/f.c", 9, "x " * 30000),
             ("d/g.c", 10, "# Released under the MIT licence\r\n")]
    files += [(f"src/m{k}/f.c", 100 + k, "plain words of the text number " + str(k)) for k in range(40)]
    frame = spark.createDataFrame([(*f, 0, "x") for f in files], "path string, row_key long, text string, similarity int, dir string")
    got = made(licenses.scan(frame).collect())
    assert got == rounded(by_hand(files))
    assert got["a/b/x.c", 3][:1] == ("Apache-2.0",) and got["d/z.c", 5][0] == "MIT" and got["a/b/c/y.c", 4][2] == "own"


def test_whole_table(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = op3_license_scan(spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert made(rows) == rounded(by_hand([(r.path, r.doc_id, docs[r.doc_id]) for r in rows]))


def test_repeated_null_and_empty(spark):
    line = licenses.TEMPLATES[2][1]
    shape = "path string, row_key long, text string"
    rows = [(None, 1, line), ("a/x", 2, line), ("a/x", 2, line), ("a/y", None, None)]
    got = licenses.scan(spark.createDataFrame(rows, shape)).collect()
    assert sorted(str(r.license) for r in got) == ["MIT", "MIT", "MIT", "None"]
    assert licenses.scan(spark.createDataFrame([], shape)).count() == 0


def test_rows_without_a_key_and_texts_of_one_key(spark):
    line = licenses.TEMPLATES[2][1]
    rows = [("a/x", 5, line), ("a/x", None, line), ("b/y", 7, line), ("b/y", 7, "int main"), ("c/z", None, None), ("c/z", None, line)]
    got = licenses.scan(spark.createDataFrame(rows, "path string, row_key long, text string")).collect()
    assert sorted((r.path, str(r.row_key), str(r.license), r.found) for r in got) == sorted([
        ("a/x", "5", "MIT", "own"), ("a/x", "None", "MIT", "own"), ("b/y", "7", "MIT", "own"), ("b/y", "7", "None", "none"),
        ("c/z", "None", "None", "none"), ("c/z", "None", "MIT", "own")])


def test_wrapped_headers_and_full_texts(spark):
    def wrapped(text, mark, width=72):
        return "\n".join(mark + x for x in textwrap.wrap(text, width))

    gpl, bsd, mit = licenses.TEMPLATES[6][1], licenses.TEMPLATES[10][1], licenses.TEMPLATES[17][1]
    files = [("a/g.c", 1, "int x;\n/*\n * Copyright 2020 Someone\n" + wrapped(gpl, " * ") + "\n */\nint main;"),
             ("b/b.py", 2, "#!/usr/bin/python\n" + wrapped(bsd, "# ") + "\n# 1. Redistributions keep the notice\nimport os"),
             ("c/narrow.sh", 3, "echo\n" + wrapped(gpl, "# ", 36)),
             ("d/LICENSE", 4, "The MIT License\n\nCopyright (c) 2020 Someone\n\n" + wrapped(mit, "")), ("d/e/f.c", 5, "int main"),
             ("h/gap.c", 6, "// Licensed under the\n//\n// MIT License.")]
    files += [(f"src/m{k}/f.c", 100 + k, "plain words of the text number " + str(k)) for k in range(40)]
    rows = licenses.scan(spark.createDataFrame(files, "path string, row_key long, text string")).collect()
    assert made(rows) == rounded(by_hand(files))
    got = {r.row_key: (r.license, r.found) for r in rows if r.license}
    assert got == {1: ("GPL-3.0", "own"), 2: ("BSD-3-Clause", "own"), 3: ("GPL-3.0", "own"), 4: ("MIT", "own"),
                   5: ("MIT", "inherited"), 6: ("MIT", "own")}


def test_common_words_weigh_by_their_own_frequency(spark):
    """The cosine of a line whose other words are in every file, by the frequencies of all terms."""
    line = "All code of our team project is licensed under the MIT License."
    files = [("a.c", 0, line)] + [(f"{k}.c", k, "all code of our team project is") for k in range(1, 400)]
    n = len(files)
    df = Counter(t for _, _, x in files for t in set(terms(x)))
    idf = lambda t: math.log((n + 1) / (max(1, df[t]) + 1)) + 1
    unit = {t: c * idf(t) for t, c in Counter(terms(line)).items()}
    best = 0
    for _, x in licenses.TEMPLATES:
        w = {t: c * idf(t) for t, c in Counter(terms(x)).items()}
        lengths = math.sqrt(sum(v * v for v in w.values()) * sum(v * v for v in unit.values()))
        best = max(best, sum(v * w.get(t, 0) for t, v in unit.items()) / lengths)
    (row,) = licenses.scan(spark.createDataFrame(files, "path string, row_key long, text string")).where("row_key = 0").collect()
    assert best > 0.75 and row.license == "MIT" and abs(row.similarity - best) < 1e-6


def test_texts_and_terms_are_not_shuffled(spark, sf_small, monkeypatch):
    """The scan's files come without an exchange, and only sums by term are shuffled for the frequencies."""
    seen = []
    frequencies = licenses.frequencies
    monkeypatch.setattr(licenses, "frequencies", lambda files, wanted: seen.append((files, wanted)) or frequencies(files, wanted))
    broadcast = sorted(map(str, op3_license_scan(spark, sf_small).collect()))
    (files, wanted), = seen
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    plan = frequencies(files, wanted)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):].splitlines()[1]
    assert "partial_count" in below
    monkeypatch.setattr(licenses, "MOST_ROWS", 0)
    assert sorted(map(str, op3_license_scan(spark, sf_small).collect())) == broadcast


def test_licence_files_are_the_first_of_their_folder(spark, tmp_path):
    rows = [(i, "ab"[i % 2] if i % 50 else None, "x") for i in (3, 7, 199, 200, 250, 407, 4001, 4002, 4100, 4203)] + [(None, "a", "x")]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    least = lambda size: {min(d for d, t, _ in rows if d is not None and (t, d // size) == g)
                          for g in {(t, d // size) for d, t, _ in rows if d is not None and t}}
    want = set()
    for d, t, _ in rows:
        top, leaf = t and d in least(4000), t and d in least(200)
        parts = [t, d if d is None else d // 4000, None if top else d if d is None else d // 200]
        want.add(("/".join([str(p) for p in parts if p is not None] + ["LICENSE" if top or leaf else f"{'' if d is None else d}.txt"]), d))
    assert {(r.path, r.doc_id) for r in op3_license_scan(spark, str(tmp_path)).collect()} == want
