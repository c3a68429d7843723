"""Quality rules against a brute-force count and the SQL form."""

import random
import re

from jobmart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, marked = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            marked.update(i + k for i in at for k in range(8))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n, rep = len(words), len(marked)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, rep, n < 20 or 100 * rep > 30 * n


def texts():
    r = random.Random(1)
    out = {i: " ".join(r.choice(("the", "a", "b#", "of", "x|", "longer")) + r.choice(("", "\n", "\t", "\r\n")) for _ in range(r.choice((0, 5, 20, 60, 300)))) for i in range(60)}
    block = " ".join(f"w{i}" for i in range(8))
    out |= {100: None, 101: "", 102: block, 103: f"{block} {block}", 104: f"{block} {block} {block} tail", 105: "\x0b\x0c \n\n", 106: "é ü 漢字 " * 30, 107: "same line\n" * 30}
    return out


def test_counts_equal_brute_force(spark, docs):
    t = texts()
    rows = quality.quality_report(docs([(i, x, "s") for i, x in t.items()], extra=", n_words bigint, _d bigint, quality bigint")).collect()
    assert len(rows) == len(t)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_clean_text_is_kept_in_four_languages(spark, docs):
    clean = {1: "The house stands on the hill and the road leads to it through a forest of old trees that nobody cut.",
             2: "Das Haus steht auf dem Berg und die Straße führt zu ihm durch einen Wald, den niemand je gefällt hat, sagt man im Dorf.",
             3: "La maison est sur la colline et la route qui mène à elle passe dans une forêt que personne ne coupe dans le pays.",
             4: "La casa está en la colina y el camino que lleva a ella pasa por un bosque que nadie corta en todo el valle desde hace años."}
    junk = {5: "### *** $$$ " * 30, 6: "one two three four five six seven eight nine " * 20}
    df = docs([(i, t, "s") for i, t in {**clean, **junk}.items()], extra=", _q bigint, _p bigint, n_words bigint")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4]


def test_empty_table_repeated_rows_and_long_text(spark, docs):
    assert quality.quality_report(docs([])).count() == 0 and quality.keep_good(docs([])).count() == 0
    long = " ".join(f"word{i} the" for i in range(60_000))
    rows = quality.quality_report(docs([(1, long, "s"), (1, long, "s"), (None, long, None)])).collect()
    assert [(r.n_words, r.n_repeat_words, r.kept) for r in rows] == [(120_000, 0, True)] * 3


def test_no_python_and_no_shuffle(spark, docs):
    plan = quality.keep_good(docs([(1, "x", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
