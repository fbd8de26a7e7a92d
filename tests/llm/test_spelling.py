import random
import re
import zlib
from collections import Counter

import pytest
from cases import TEXTS, UPPER, documents, rows_of
from pyspark.sql import functions as F

from replyloom.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, every=31, least=7, times=2):
    """Word counts by a plain loop over every run."""
    found = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= times}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def grouped(words):
    """(word, form, root, n, n_near, form_n) by comparing all pairs."""
    forms, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = len(near)
    rows = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n, out[w], words.get(forms[w])))
    return sorted(rows, key=repr)


def table(df):
    return rows_of(df.select("word", "form", "root", "n", "n_near", "form_n"))


def test_counts_of_awkward_texts(spark):
    got = {r.word: r.n for r in S.corpus_words(documents(spark), min_length=1, min_count=1).collect()}
    assert got == counted(TEXTS, least=1, times=1)
    kept = {r.word: r.n for r in S.corpus_words(documents(spark)).collect()}
    assert kept == counted(TEXTS)


@pytest.mark.parametrize("seed", range(3))
def test_all_pairs_of_one_edit_are_found(spark, seed):
    random.seed(seed)
    words = {}
    for _ in range(60):
        w = "".join(random.choice("abé") for _ in range(random.randrange(1, 14)))
        words[w] = random.choice([1, 2, 3, 10, 30, 100, 1000])
        for _ in range(3):
            i = random.randrange(len(w) + 1)
            kind = random.randrange(3)
            v = w[:i] + random.choice("abéß") + w[i + (kind > 0) :] if kind < 2 else w[:i] + w[i + 1 :]
            if v:
                words[v] = random.choice([1, 2, 3, 10, 30, 100, 1000])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert table(S.variant_groups(frame)) == grouped(words)


def test_forms_of_texts_with_slips(spark):
    random.seed(5)
    vocabulary = ["paragraph", "différence", "Übergang", "schooling", "schoolings", "ÄHNLICHKEIT"]
    texts = [(i, " ".join(random.choices(vocabulary, k=400))) for i in range(60)]
    got = table(S.spelling_variants(documents(spark, texts)))
    assert got == grouped(counted(texts))
    assert any(form is not None for _, form, *_ in got)


def test_ties_and_chains(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaaac": 10, "aaaaabb": 100, "aaaabbb": 1000, "zzzzzzz": 5}
    got = {r.word: r for r in S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["aaaaaaa"].form == "aaaaaab" and got["aaaaaaa"].root == "aaaabbb"
    assert got["zzzzzzz"].form is None and got["zzzzzzz"].root == "zzzzzzz" and got["zzzzzzz"].n_near == 0
    assert table(S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long"))) == grouped(words)


def test_a_common_beginning_makes_few_candidates(spark):
    """A third of all words share one half; what meets under a key stays near the number of words."""
    words = [("besonders" + "".join(chr(97 + (i // 26**k) % 26) for k in range(9)), 2) for i in range(0, 26**4, 31)]
    frame = spark.createDataFrame(words, "word string, n long")
    keys = frame.select(F.explode(S._keys(F.col("word"), F.length("word"))).alias("at"))
    met = keys.groupBy("at").count().select(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert met < 100 * len(words)
    some = words[:: len(words) // 300]
    got = {frozenset((r.a, r.b)) for r in S.near_pairs(spark.createDataFrame(some, "word string, n long")).collect()}
    texts = [w for w, _ in some]
    assert got == {frozenset((a, b)) for i, a in enumerate(texts) for b in texts[i + 1 :] if one_edit(a, b)}


def test_empty_table(spark):
    assert S.spelling_variants(documents(spark, [])).collect() == []
    assert S.spelling_variants(documents(spark, [(1, None), (2, "")])).collect() == []
