import re
from collections import Counter

import numpy as np

from marlstone.llm import quality
from marlstone.llm.quality import base_statistics, judge

from .helpers import clashing, documents, edge_texts, real_texts


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(tri)
    rep = {j for i, t in enumerate(tri) if n[t] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(rep)


def test_base_statistics():
    for _, t in real_texts() + edge_texts() + [(0, "a b c a b c a\n\na b\na b\n \n#"), (0, "a a a a")]:
        assert base_statistics(t or "")[:5] == brute(t)


def test_judgement(spark):
    rows = real_texts(sf="/root/testdata/sf0.01")
    out = {r.doc_id: r for r in judge(documents(spark, rows), ["doc_id"]).collect()}
    assert len(out) == len(rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for d, t in rows:
        r, (n, _, symbols, _, rep) = out[d], brute(t)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.kept and r.base_failed)
    good = [out[d].kept for d in out if labels.get(d) == 1 and not out[d].base_failed]
    bad = [out[d].kept for d in out if labels.get(d) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_edges(spark):
    out = judge(clashing(documents(spark, edge_texts())), ["doc_id"]).collect()
    assert len(out) == len(edge_texts())
    assert all(not r.kept for r in out if r.doc_id in (1, 2, 3))
    assert judge(documents(spark, []), ["doc_id"]).collect() == []


def whole(df):
    return df


def covariance(r):
    w = np.array([[getattr(r, f"w{i}{j}") if j <= i else 0.0 for j in range(4)] for i in range(4)])
    return np.linalg.inv(w.T @ w)


def test_estimate_resists_outliers(spark, monkeypatch):
    monkeypatch.setattr(quality, "FLOOR", (1e-3,) * 4)
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([1, 2, 3, 4], np.diag([1, 4, 9, 16]) + 0.5, 800)
    far = rng.normal(60, 1, (200, 4))
    df = spark.createDataFrame([("g", *map(float, x)) for x in np.vstack([clean, far])], "grp string, x0 double, x1 double, x2 double, x3 double")
    r = quality.determined(df, whole).first()
    assert np.allclose([r.m0, r.m1, r.m2, r.m3], [1, 2, 3, 4], atol=0.5)
    assert np.allclose(np.sqrt(np.diag(covariance(r))), np.sqrt(np.diag(np.cov(clean.T))), rtol=0.25)
    starts = quality.starts(df, whole).collect()
    assert sorted(x.start for x in starts) == [0, 1, 2]
    assert r.logdet <= min(x.logdet for x in quality.concentrated(df, quality.starts(df, whole), whole).collect())


def floored(c):
    """c with the documented floors: spreads first, then the least variance of a direction in units of the floors."""
    f = np.diag(quality.FLOOR)
    c = c + np.diag(np.maximum(np.square(quality.FLOOR) - np.diag(c), 0.0))
    values, axes = np.linalg.eigh(np.linalg.inv(f) @ c @ np.linalg.inv(f))
    return f @ axes @ np.diag(np.maximum(values, quality.NARROW)) @ axes.T @ f


def squared(x, m, c):
    return np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)


def step(x, m, c, factor=quality.CONSISTENT_COVERAGE):
    d = squared(x, m, c)
    near = x[d <= np.sort(d)[int(np.ceil(quality.COVERAGE * len(x))) - 1]]
    return near.mean(axis=0), floored(np.cov(near.T, bias=True) * factor)


def random_mcd(x, rng, tries=60):
    """Random subsets of five rows as starts, two steps each, the best five of them to the end."""
    found = []
    for _ in range(tries):
        some = x[rng.choice(len(x), 5, replace=False)]
        s = some.mean(axis=0), floored(np.cov(some.T, bias=True))
        for _ in range(2):
            s = step(x, *s)
        found.append(s)
    best = sorted(found, key=lambda s: np.linalg.slogdet(s[1])[1])[:5]
    for _ in range(30):
        best = [min(s, step(x, *s), key=lambda s: np.linalg.slogdet(s[1])[1]) for s in best]
    m, c = min(best, key=lambda s: np.linalg.slogdet(s[1])[1])
    near = x[squared(x, m, c) <= quality.CHI_WEIGHT]
    return near.mean(axis=0), floored(np.cov(near.T, bias=True) * quality.CONSISTENT_WEIGHT), np.linalg.slogdet(c)[1]


def test_verdicts_agree_with_random_starts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r.doc_id: r for r in judge(docs, ["doc_id"]).collect()}
    vectors, names = {}, {}
    for r in docs.collect():
        n, chars, symbols, dup, rep = brute(r.text)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (r.text or "").split("\n"))
        if not (n < 50 or 100 * rep > 50 * n):
            angle = lambda a, b: np.arcsin(np.sqrt(min(1, a / max(b, 1))))
            vectors[r.doc_id] = [np.log(max(chars, 1) / max(n, 1)), np.log1p(1000 * symbols / max(chars, 1)), angle(dup, lines), angle(rep, n)]
            names[r.doc_id] = [(r.lang, r.source), r.lang, None]
    size = Counter((i, n) for names_of in names.values() for i, n in enumerate(names_of))
    own = {d: next((i, n) for i, n in enumerate(names_of) if size[i, n] >= quality.LEAST or i == 2) for d, names_of in names.items()}
    rng = np.random.default_rng(5)
    differing = rejected = 0
    for i, group in set(own.values()):
        x = np.array([vectors[d] for d in vectors if names[d][i] == group])
        m, c, _ = random_mcd(x, rng)
        for d in (d for d in own if own[d] == (i, group)):
            far = squared(np.array([vectors[d]]), m, c)[0] > quality.CUTOFF
            rejected += far
            differing += out[d].kept == far
    assert rejected >= 20 and differing <= 0.05 * rejected
    assert all(not out[d].kept for d in out if d not in own)


def test_rows_on_a_line_have_a_determinant(spark):
    rows = [("line", float(i % 2), 10.0 * (i % 2), float(i % 2), float(i % 2)) for i in range(300)] + [("point", 1.0, 2.0, 3.0, 4.0)] * 200
    df = spark.createDataFrame(rows, "grp string, x0 double, x1 double, x2 double, x3 double")
    out = {r.grp: r for r in quality.determined(df, whole).collect()}
    assert set(out) == {"line", "point"} and all(np.isfinite(r.logdet) for r in out.values())
    assert np.allclose(np.sqrt(np.diag(covariance(out["point"]))), quality.FLOOR)
