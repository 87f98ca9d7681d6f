import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from spanlab.llm import fingerprints, near_dedup
from spanlab.llm.links import components

from .conftest import SF, docs_of


def sets_of(texts, k):
    out = {}
    for i, t in texts:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute_groups(texts, k, percent=80):
    sets = sets_of(texts, k)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    inv, both = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            inv[x].append(i)
    for ids in inv.values():
        for a in range(len(ids)):
            for b in range(a):
                both[ids[b], ids[a]] += 1
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def compare(df, texts, k):
    got = {r.doc_id: r for r in near_dedup.near_groups(df, shingle=k).collect()}
    for i, (n, comp) in brute_groups(texts, k).items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, comp, comp == i)


def test_documents_against_brute_force(spark):
    texts = [(r[0], r[1]) for r in docs_of()]
    compare(near_dedup_docs(spark), texts, 4)


def near_dedup_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_large_groups_near_the_threshold(make):
    """Copies, a large group of edited copies around similarity 0.8, and chains."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, rows = [word() for _ in range(60)], []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = word()
        rows.append(" ".join(w))
    rows += [" ".join(base)] * 40
    chain = [word() for _ in range(80)]
    for _ in range(12):
        chain[rng.randrange(80)] = word()
        rows.append(" ".join(chain))
    rows += ["a b c", "a b c", "A  B\nC", "", None, " "]
    order = list(range(len(rows)))
    rng.shuffle(order)
    texts = [(i, rows[k]) for i, k in enumerate(order)]
    compare(make(texts), texts, 4)


def test_superminhash_estimates_with_less_variance():
    rng = np.random.default_rng(0)
    est = []
    for _ in range(300):
        a = rng.integers(0, 2**63, 100, dtype=np.uint64)
        b = a.copy()
        b[:11] = rng.integers(0, 2**63, 11, dtype=np.uint64)
        s = near_dedup.superminhash([np.unique(a), np.unique(b)])
        est.append((s[0] == s[1]).mean())
    j = 89 / 111
    assert abs(np.mean(est) - j) < 0.01
    assert np.std(est) < (j * (1 - j) / 128) ** 0.5
    one = near_dedup.superminhash([np.array([5], np.uint64), np.zeros(0, np.uint64)])
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(128)) and (one[1] == ~np.uint64(0)).all()


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r.comp for r in components(edges).collect()} == {0}


def test_groups_odd_and_empty(odd, make):
    got = near_dedup.near_groups(odd).collect()
    assert len(got) == odd.count()
    assert all(r.n_shingles == 0 and r.kept for r in got if r.doc_id in (1, 2, 3, 7))
    assert all(r.kept for r in got if r.doc_id is None)
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert near_dedup.near_groups(make([])).count() == 0
    assert near_dedup.deduplicated(odd).columns == odd.columns


def test_edited_fingerprints(spark):
    got = {r.doc_id: r for r in fingerprints.query(spark, SF).collect()}
    docs = docs_of()
    sets = sets_of([(r[0], r[1]) for r in docs], 5)
    for k, (i, t, *_) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)]
        t, q = t or "", len(t or "") // 4
        e = t[:len(t) - q] + (nxt[1] or "")[:q]
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        own = sets_of([(0, e)], 5)[0]
        for value, other in ((x.near_edited, own), (x.near_next, sets[nxt[0]])):
            j = len(sets[i] & other) / max(1, len(sets[i] | other))
            assert abs(value - j) < 0.25


def test_fingerprints_of_equal_texts_and_likeness(make, odd):
    rows = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(make([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, ""), (4, None)])).collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 512 and rows[3] == rows[4] == ""
    df = fingerprints.edited(odd)
    assert df.count() == odd.count()
    assert df.select(F.max(F.abs(fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")) - F.col("near_edited")))).first()[0] == 0
    assert fingerprints.edited(make([])).count() == 0
    single = fingerprints.edited(make([(7, "a b c d e f g h")])).first()
    assert single.near_next == 1.0


def test_fingerprint_links(make):
    text = " ".join(f"w{i}" for i in range(80))
    links = fingerprints.near_links(make([(1, text), (2, text + " more"), (3, "quite another text " * 5)])).collect()
    assert [(min(r.x, r.y), max(r.x, r.y)) for r in links] == [(1, 2)]
