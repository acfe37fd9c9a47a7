"""Operators 11 to 13 against plain versions, and on nulls, empties, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from periodlens.llm import chunk_recipes, periodic_runs, queries, source_divergence
from tests.llm.brute import SPACE_WORDS, ascii_lower

DOCS = "doc_id long, text string, lang string, source string"
ODD = [None, "", " \n\t ", "one", " ", "é", "a b", "ab " * 7, "x " * 5, "x " * 6]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- 11: runs ---------------------------------------------------------------------------------

def plain_runs(w):
    """Each period by itself: stretches of equal words q apart, without those of a smaller period."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, i + n - d)) for d in range(1, q)):
                out.add((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = SPACE_WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 5), st.integers(0, 9), st.lists(st.integers(0, 2), max_size=20))
def test_runs_equal_the_plain_ones(head, period, copies, tail):
    w = head + head[-period:] * copies + tail
    assert periodic_runs.runs_of(w) == plain_runs(w)
    assert periodic_runs.text_runs([str(x) for x in w]) == plain_runs(w)


def test_stretches_are_joined_without_touching_each_other():
    w = list("aaaaaaaa") + [str(i) for i in range(30)] + list("ababababab") + list("cdcdcdcdcd") + ["z"] + list("aaaaaaa")
    assert periodic_runs.text_runs(w) == plain_runs(w)
    assert len(plain_runs(w)) == 4


def test_suffix_tree_holds_all_common_extensions():
    rng = random.Random(2)
    import numpy as np
    for _ in range(40):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 25))]
        t, n = periodic_runs.SuffixTree(s), len(s)
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        got = t.common(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        for (i, j), k in zip(pairs, got):
            x, y = s[i:], s[j:]
            assert k == next((m for m, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        order = sorted(range(n + 1), key=lambda i: s[i:])
        assert [t.ranks()[i] for i in order] == list(range(n + 1))
        order = sorted(range(n + 1), key=lambda i: [-x for x in s[i:]])
        assert [t.ranks(falling=True)[i] for i in order] == list(range(n + 1))


def texts_with_runs(seed=4, n=150):
    rng, out = random.Random(seed), []
    for _ in range(n):
        w = [rng.choice("abcdefghijkl") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            if w:
                a = rng.randrange(len(w))
                w[a:a] = w[a:a + rng.randrange(1, 7)] * rng.randrange(2, 9)
        out.append(" \n".join(w))
    return out + ODD


def test_runs_of_documents(spark, monkeypatch):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts_with_runs())] + [(3, "a " * 9, None, None), (3, "a " * 9, None, None)]
    monkeypatch.setattr(queries, "read_table", lambda *_: spark.createDataFrame(rows, DOCS).repartition(3))
    got = queries.op11_periodic_runs(spark, "").collect()
    assert sorted(tuple(r) for r in got) == sorted([(d, *plain_row(d, t)) for d, t, _, _ in rows], key=str) or \
        Counter(tuple(r) for r in got) == Counter((d, *plain_row(d, t)) for d, t, _, _ in rows)
    assert sum(r["n_runs"] for r in got) > 100
    monkeypatch.setattr(queries, "read_table", lambda *_: spark.createDataFrame([], DOCS))
    assert queries.op11_periodic_runs(spark, "").count() == 0


def test_runs_keep_other_columns_and_refuse_clashes(spark):
    df = spark.createDataFrame([(None, "go go go go go go stop", "x")], "`odd name` long, text string, keep string")
    r = periodic_runs.find_runs(df).first()
    assert (r["odd name"], r["keep"], r["n_words"], r["collapsed"]) == (None, "x", 7, "go stop")
    assert [tuple(x) for x in r["runs"]] == [(0, 6, 1)]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df.withColumn("RUNS", F.lit(1)))
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, copies=2)
    long = "w x y " * 30_000
    r = periodic_runs.find_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 90_000, 3)] and r["collapsed"] == "w x y"


# --- 12: recipes --------------------------------------------------------------------------------

def plain_groups(rows):
    by = defaultdict(list)
    for d, t in rows:
        t = t or ""
        by[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), d is None, d))
    out = Counter()
    for norm, members in by.items():
        best = min(members)
        for k, m in enumerate(sorted(members)):
            out[(m[2], best[2], len(members), k == 0, sha(norm))] += 1
    return out


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeéfghi 中文\n") for _ in range(rng.randrange(0, 6000))) for _ in range(40)]
    out = [t for t in base for _ in range(rng.randrange(1, 4))]
    out += [t.replace(" ", " \t") for t in base[:10]] + [t + "x" for t in base[:10]] + ["y" + t for t in base[:10]]
    out += [base[0]] * 30 + [base[1] + base[2], base[2] + base[1], base[1] + " " + base[2]]
    return list(enumerate(out)) + [(None, base[3]), (None, base[3]), (7, base[4]), (7, base[4])] + [(900 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("bits", [64, 5])
def test_exact_groups(spark, copies, bits):
    """Five-bit hashes collide all the time: then only the verified numbers tell chunks apart."""
    df = spark.createDataFrame(copies, "doc_id long, text string").withColumn("recipe", F.lit("clash")).withColumn("kept", F.lit(0))
    got = chunk_recipes.exact_groups(df.repartition(4), bits=bits, least=16, most=64)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_groups(copies)


def test_exact_groups_of_nothing_and_of_long_texts(spark):
    schema = "doc_id long, text string"
    assert chunk_recipes.exact_groups(spark.createDataFrame([], schema)).count() == 0
    long = "".join(random.Random(1).choices("abcdefgh", k=400_000))
    rows = [(2, long), (1, long + " "), (3, long[:-1]), (4, long[1:])]
    got = {r["doc_id"]: r for r in chunk_recipes.exact_groups(spark.createDataFrame(rows, schema)).collect()}
    assert [got[d]["keep_id"] for d in (1, 2, 3, 4)] == [1, 1, 3, 4] and [got[d]["kept"] for d in (1, 2)] == [True, False]


def test_chunks_are_set_by_content(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    df = spark.createDataFrame([(text,), ("something before" + text,)], "t string")
    a, b = [r[0] for r in df.select(chunk_recipes.chunks(F.col("t"))).collect()]
    assert "".join(a) == text and "".join(b) == "something before" + text
    assert len(set(a) & set(b)) >= len(a) - 5 and 500 < len(text) / len(a) < 3000
    assert all(len(c) >= 256 for c in a[:-1]) and max(map(len, a)) <= 4096


# --- 13: divergence ---------------------------------------------------------------------------------

def plain_audit(rows, min_docs, top=50):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        t = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))
        count[lang, source].update(t)
        docs[lang].update(set(t))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for x, s in groups if x == lang]

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + (10**9 * (n[t] + 5)) // (total + 5 * len(kept)) for t in kept}
        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out |= {(lang, s, part, o, -v, k) for k, (v, _, o) in enumerate(items, 1)}
    return out


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(12)
    words = [f"{a}{b}" for a in "bcdfgklmnÉé中" for b in ("a", "E", "io", "𝔘", "u")]
    rows = []
    for i in range(400):
        w = rng.choices(words, weights=[1 + (k * (i % 7)) % 11 for k in range(len(words))], k=rng.randrange(0, 25))
        rows.append((i, rng.choice([" ", ", ", "1"]).join(w), rng.choice(["en", "en", "de", None, "", "xx"]), rng.choice(["s1", "s2", "é", "z", None])))
    return rows + [(500, None, "en", "silent"), (501, "!!", "lonely", "only"), (502, "", "lonely", "other"), (502, "", "lonely", "other")]


@pytest.mark.parametrize("bits,top", [(64, 50), (3, 50), (64, 2)])
def test_divergence(spark, sourced, bits, top):
    """Three-bit digests collide all the time: all terms are split by their strings."""
    df = spark.createDataFrame(sourced, DOCS).withColumn("h", F.lit(1)).withColumn("rank", F.lit("x")).repartition(4)
    got = source_divergence.audit(df, min_docs=12, top=top, bits=bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_audit(sourced, 12, top)
    assert {r[2] for r in rows} == {"pair", "term"}


def test_divergence_of_little(spark):
    assert source_divergence.audit(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "word " * 1000, "en", "a"), (2, None, "en", "b")]
    got = {tuple(r) for r in source_divergence.audit(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)} == plain_audit(rows, 30)
    assert {tuple(r) for r in source_divergence.audit(spark.createDataFrame(rows, DOCS), min_docs=1).collect()} == plain_audit(rows, 1)
