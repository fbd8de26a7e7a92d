"""Small tables with everything that is awkward, and plain versions of the operators."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, "plain words in a line\nplain words in a line\n \nother"),
    (2, None),
    (3, ""),
    (4, " \t\n\v\f\r"),
    (5, LONG),
    (6, f"before {PASSAGE.upper()}, after. é😀 straße #$% ||"),
    (6, f"before {PASSAGE.upper()}, after. é😀 straße #$% ||"),
    (None, "a row without a key " * 20),
    (7, "a b c a b c a b c x"),
    (8, "one two"),
    (9, "Zwei"),
    (10, PASSAGE + " " + PASSAGE),
    (11, "x" * 300_000),
    (12, " "),
    (13, "a b c"),
]
CLASHING = "n_words long, found string, score double, fp long, u long, items string, secrets string, toxic int, component_id long"


def documents(spark, rows=TEXTS):
    """The texts with columns named like the operators' own."""
    full = [(k, t, "en", "src", 1, 5, "x", 0.5, 3, 4, "i", "s", 1, 9) for k, t in rows]
    return spark.createDataFrame(
        full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    ).repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_key(rows):
    return sorted(rows, key=repr)


def words(text):
    return WORD.findall(text or "")


def base_measures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {g for g, n in _counts(windows).items() if n > 1}
    covered = {i + k for i, g in enumerate(windows) if g in many for k in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def _counts(items):
    out = {}
    for x in items:
        out[x] = out.get(x, 0) + 1
    return out


def simhash(text):
    w = words((text or "").translate(UPPER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node of each component, by a plain walk; ``linked(a, b)`` says what is joined."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def contamination(text, items):
    """(n_words, n_hit, sorted item ids) by comparing every window with every place."""
    w = ALNUM.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for item, t in items:
        b = ALNUM.findall((t or "").translate(UPPER))
        m = min(10, len(b))
        windows = {tuple(b[i : i + m]) for i in range(len(b) - m + 1)} if m else set()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i : i + m]) in windows:
                hit.update(range(i, i + m))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
