import math
import random
import re

import duckdb
from cases import documents, rows_of
from pyspark.sql import functions as F

from replyloom.llm import queries
from replyloom.llm import secret_scan as S
from replyloom.llm.oracle import ORACLE

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SEED, TOKEN, MIXED = "Q7MZ2KPX4WTN6VRJ3HSYGB5D", "qZtLwXcVbNmKpRfGhJdSaYuE", "q8Zt1Lw0Xc7Vb3Nm5Kp9"
CASES = [
    (SEED, True),
    ("AAAAAAAAAABBBBBBBBBB1111", False),
    (TOKEN, True),
    ("Donaudampfschifffahrtsgesellschaft", False),
    ("ONLYCAPITALLETTERSINAROWQZ", False),
    (f"docs/example/{MIXED}", True),
    (f"{MIXED}_placeholder", True),
    (f"xxxxxxxx-{TOKEN}", True),
    (f"0123456789/{SEED}/abcdefgh", True),
    ("q8Zt1Lw0Xc7Vb3exampleNm5Kp9", False),
    ("exampleexamplexample8Zt1Lw0Xc7Vb3Nm5", False),
    ("xxxxxxxxxxxx8Zt1Lw0Xc7Vb3Nm5Kp", False),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", False),
    ("550e8400-e29b-41d4-a716-446655440000", False),
]


def plain(candidate):
    """Every window counted anew; those that overlap a match of an allowed pattern do not count."""
    taken = [m.span(1) for p in S.ALLOWED for m in re.finditer(f"(?=({p}))", candidate)]
    for i in range(len(candidate) - 19):
        if any(b < i + 20 and e > i for b, e in taken):
            continue
        w = candidate[i : i + 20]
        bits = -sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w))
        digits, lower, upper = (len(re.findall(p, w)) for p in ("[0-9]", "[a-z]", "[A-Z]"))
        if (
            re.fullmatch("[0-9a-fA-F]+", w) and 1 <= digits <= 19 and bits >= 3.0
            or digits + lower == 20 and 4 <= digits <= 16 and bits >= 3.6
            or digits and lower and upper and bits >= 3.7
            or digits + upper == 20 and 1 <= digits <= 19 and bits >= 3.3
            or lower + upper == 20 and 4 <= upper <= 16 and bits >= 3.5
        ):
            return True
    return False


def found(spark, tokens):
    rows = S.secret_scan(documents(spark, list(enumerate(tokens)))).select("doc_id", S.as_text(F.col("secrets"), [3]))
    spans = dict(rows_of(rows))
    return [spans[i] != "" for i in range(len(tokens))]


def test_classes_and_allowed_matches(spark):
    assert found(spark, [t for t, _ in CASES]) == [plain(t) for t, _ in CASES]
    assert [(t, plain(t)) for t, _ in CASES] == CASES


def test_random_tokens_equal_plain_windows(spark):
    random.seed(5)
    parts = ["example", "/", "-", "placeholder", "xxxxxxxxx", "0123456789", "abcdefgh", "Example"]
    tokens = []
    for i in range(300):
        some = ["".join(random.choices(random.choice([BASE32, LETTERS, "abcdef0123456789"]), k=random.randrange(8, 30))) for _ in range(3)]
        tokens.append("".join(x for s in some for x in (s, random.choice(parts))))
    mine, want = found(spark, tokens), [plain(t) for t in tokens]
    assert mine == want and 50 < sum(want) < 300


def test_the_sql_knows_all_classes_and_allowed_windows(spark, tmp_path):
    random.seed(6)
    parts = ["example", "/", " ", "placeholder", "xxxxxxxxx", "0123456789", "\n", "token=", "AKIA", "\U0001f600"]
    texts = [t for t, _ in CASES]
    for i in range(200):
        some = ["".join(random.choices(random.choice([BASE32, LETTERS, "abcdef0123456789"]), k=random.randrange(8, 30))) for _ in range(4)]
        texts.append("".join(x for s in some for x in (s, random.choice(parts))))
    documents(spark, [*enumerate(texts), (998, None), (999, "")]).select("doc_id", "text").toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    mine = queries.op2_secret_scan(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(mine.columns)} FROM ({ORACLE['op2_secret_scan']})").fetchall()
    assert rows_of(mine) == sorted(want, key=repr)
    assert sum(r[4] for r in want) > 100


def test_redaction_takes_the_new_classes(spark):
    text = f"seed {SEED} token {TOKEN} docs/example/{MIXED} end"
    assert S.redact_secrets(documents(spark, [(1, text)])).first().text == "seed [secret] token [secret] [secret] end"
