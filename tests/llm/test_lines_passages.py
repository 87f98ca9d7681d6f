import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from spanlab.llm import passage_dedup
from spanlab.llm.line_dedup import CuckooFilter, LineIndex

from .conftest import SF, docs_of

WS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute_lines(rows, min_docs=5):
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key_of(x)) >= 40:
                holders[key_of(x)].add(i)
    drop = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return {i: [x for x in (t or "").split("\n") if drop.get(key_of(x), i) == i] for i, t in rows}


def compare(index, df, rows):
    want = brute_lines(rows)
    got = {r.doc_id: r for r in index.clean(df).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert (got[i].text or "") == "\n".join(want[i])


def line(k):
    return f"Line number {k} which is long enough to count É"


def made(seed=0, n=60):
    rng = random.Random(seed)
    return [(i, "\n".join(rng.choice([line(rng.randrange(12)), "  " + line(rng.randrange(12)).upper().replace("É", "É") + "\t", "short", line(1000 + i)]) for _ in range(rng.randint(1, 9)))) for i in range(n)]


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    f = CuckooFilter.for_keys(len(h))
    f.insert(h)
    assert f.contains(h).all()
    assert f.contains(rng.integers(0, 2**63, 50_000, dtype=np.uint64)).mean() < 0.002
    f.remove(h[:10_000])
    assert f.contains(h[10_000:]).all() and f.contains(h[:10_000]).mean() < 0.01
    assert CuckooFilter.load(f.dump()).contains(h[10_000:]).all()


def test_lines_against_brute_force(spark, make):
    rows = made() + [(100, None), (101, ""), (102, "\n\n")]
    df = make(rows, extra=False)
    compare(LineIndex.build(df), df, rows)


def test_insert_and_delete_are_reversible(spark, make):
    rows = made(3, 80)
    old, new = [r for r in rows if r[0] % 3], [r for r in rows if r[0] % 3 == 0]
    df, more = make(old), make(new)
    first = LineIndex.build(df)
    both = first.insert(more)
    compare(both, make(rows, extra=False), rows)
    state = lambda x: sorted(map(tuple, x.refs.select("key", "n_docs", "max_doc").collect()))
    assert state(both) == state(LineIndex.build(make(rows)))
    back = both.delete(more.select("doc_id"))
    assert state(back) == state(first)
    compare(back, make(old, extra=False), old)
    live = {r.shard: r.table for r in back.filters.collect()}
    for r in back.refs.select("shard", "key").collect():
        assert CuckooFilter.load(bytes(live[r.shard])).contains(np.frombuffer(bytes(r.key)[:8], "<u8")).all()


def test_lines_without_screen(make, monkeypatch):
    from spanlab.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SCREEN_BYTES", -1)
    rows = made(5)
    df = make(rows, extra=False)
    compare(LineIndex.build(df), df, rows)


def test_lines_odd_and_empty(odd, make):
    out = LineIndex.build(odd).clean(odd)
    assert out.count() == odd.count() and out.columns[:len(odd.columns)] == odd.columns and out.columns[-1] == "n_dropped_"
    assert out.filter("doc_id is null and text is not null").first().text == "no id but some words here and there"
    empty = make([])
    assert LineIndex.build(empty).clean(empty).count() == 0


# --- passages ---

def brute_passages(texts, length=400):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(t), int(gone.sum()), len(passage_dedup.runs(gone)[0]), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def compare_passages(df, rows, **params):
    got = defaultdict(list)
    for r in passage_dedup.without_repeats(df, digest=True, **params).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    for (i, _), want in zip(rows, brute_passages([(t or "").encode() for _, t in rows])):
        assert want in got[i]


def passages(n=150):
    rng = random.Random(0)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))
    rows = []
    for k in range(n):
        a = rng.randrange(2500)
        rows.append((k, "".join(rng.choice("abc") for _ in range(rng.randrange(900))) + base[a:a + rng.randrange(900)] + "é" * rng.randrange(300) + base[a:a + 150]))
    return rows + [(1000, "a" * 3000), (1001, None), (1002, ""), (1003, "ab" * 1000), (1004, "x" * 400), (1005, "y" * 401), (1006, "z" * 399)]


def test_passages_against_brute_force(make):
    rows = passages()
    compare_passages(make(rows), rows)
    compare_passages(make(rows), rows, heavy=2)


def test_passages_of_documents(spark):
    rows = [(r[0], r[1]) for r in docs_of()]
    compare_passages(spark.read.parquet(f"{SF}/documents.parquet"), rows)


def test_merged_transforms_and_common_prefixes():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 40))) for _ in range(25)]
    c = passage_dedup.Contexts(texts, length=12, gram=2)
    shards = [c.shard(lo, min(lo + 4, 25)) for lo in range(0, 25, 4)]
    place, lcp = passage_dedup.merge_transforms(shards, c.rounds)
    block = np.cumsum(lcp < c.rounds)
    name = {}

    def symbols(p):
        t, at = c.owner[p], c.at[p]
        s = [int(c.name[c.first[t] + q]) for q in range(at, c.many[t], 2)][:6]
        return tuple(s)
    full = [(symbols(p), b, k) for p, b, k in zip(place, block, lcp) if p >= 0 and len(symbols(p)) == 6]
    assert [f[0] for f in full] == sorted(f[0] for f in full)
    for (s, b, _), (s2, b2, k2) in zip(full, full[1:]):
        assert (s == s2) == (b == b2)
        name[s] = b
    for (p, q, k) in zip(place, place[1:], lcp[1:]):
        if p >= 0 and q >= 0 and len(symbols(p)) == 6 and len(symbols(q)) == 6:
            a, b = symbols(p), symbols(q)
            assert k == next((i for i in range(6) if a[i] != b[i]), 6)


def test_passages_odd_and_empty(odd, make):
    out = passage_dedup.without_repeats(odd)
    assert out.count() == odd.count()
    by = {r.doc_id: r for r in out.filter("doc_id in (5, 6)").collect()}
    assert by[5].n_removed == by[5].n_bytes == by[6].n_removed and bytes(by[5].kept) == b""
    assert out.filter(F.col("doc_id") == 1).first().n_bytes == 0
    assert passage_dedup.without_repeats(make([])).count() == 0
