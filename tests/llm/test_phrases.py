import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from quizlake.llm import phrases as C
from tests.llm.helpers import AWKWARD, SF01, awkward, lower


def brute(rows, top, least):
    out = []
    for lang in sorted({(r[1] or "und") for r in rows}):
        f, n = Counter(), 0
        for text, own in rows:
            if (own or "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, 6):
                    f.update(zip(*[w[i:] for i in range(k)]))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 100 * f[p[i:i + k]]:
                        dropped.add(p[i:i + k])
        found = []
        for p, a in cand.items():
            if p not in dropped:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((" ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *x) for i, x in enumerate(found[:top])]
    return out


def texts(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{int(30 * rng.random() ** 2)}" for _ in range(40)] + ["The", "É", "x_1", "ß"]
    fixed = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 6))] for _ in range(12)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += rng.choice(fixed) if rng.random() < 0.5 else [rng.choice(vocabulary)]
        out.append(("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", " - "]) for w in words),
                    rng.choice(["en", "en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("seed,top,least,share", [(1, 15, 4, 0.05), (2, 40, 3, 0.3), (3, 2000, 3, 0.1), (4, 5, 6, 1.0)])
def test_equals_brute_force(spark, seed, top, least, share):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    got = sorted(map(tuple, C.collocations(docs, top, least, share).collect()))
    assert got == sorted(brute(rows, top, least)) and got


def test_later_waves_open_only_what_can_matter(spark, monkeypatch):
    seen = []
    limits = C._limits
    monkeypatch.setattr(C, "_limits", lambda s, d: seen.append(dict(d)) or limits(s, d))
    rows = [(t, "en") for t, _ in texts(5, 600)] + [("zebra finch ! " * 40, "en"), ("rare thing . " * 30, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = list(map(tuple, C.collocations(docs, 2, 20, 0.05).collect()))
    assert sorted(got) == sorted(brute(rows, 2, 20))
    f = Counter(w for t, _ in rows for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", lower(t)))
    assert seen[-1]["en"] < max(f.values())  # the most frequent words stayed closed


def test_counts_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits in the cuts; the score does not."""
    one = spark.createDataFrame([(1, "en", 2, 3_000_000_000_000, 11, 12)],
                                "key long, lang string, size int, a long, left1 long, right1 long")
    one = one.withColumns({c: F.lit(0).cast("long") for c in C.PARTS if c not in one.columns})
    counts = spark.createDataFrame([(11, 4_000_000_000_000), (12, 5_000_000_000_000)], "key long, n long")
    totals = spark.createDataFrame([("en", 90_000_000_000_000)], "lang string, n long")
    r = C.scored(one, counts, totals).first()
    assert r.score == 1000 * r.a * r.n // (r.l * r.r) == 13_500


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = [(r[1], r[2]) for r in AWKWARD]
    got = sorted(map(tuple, C.collocations(docs, 50, 2, 0.2).collect()))
    assert got == sorted(brute(rows, 50, 2))
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(docs.where("text is null")).count() == 0


def test_query_equals_sql(spark):
    got = sorted(map(tuple, C.op11_phrase_collocations(spark, SF01).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF01}/documents.parquet'")
    assert got == sorted(con.execute(C.OP11_SQL).fetchall()) and len(got) > 10
