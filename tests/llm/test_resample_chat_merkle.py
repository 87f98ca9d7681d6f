"""Importance resampling, chat formatting and the Merkle manifest against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from spanlab.llm import chat, merkle, queries, resampling

from .conftest import SF


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- importance resampling -------------------------------------------------------------------------------------

def _features(text, low=1, high=1):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    return len(words), [" ".join(words[i:i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]


def _resample(docs, target, buckets=10_000, low=1, high=1, percent=10, least=20, seed=2024):
    """docs: (id, text) -> {row: (n, weight, score)}, drawn rows in order."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    feats = [_features(t, low, high) for _, t in docs]
    raw, aim = Counter(bucket(f) for _, fs in feats for f in fs), Counter(bucket(f) for t in target for f in _features(t, low, high)[1])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    out = []
    for (i, _), (n_words, fs) in zip(docs, feats):
        w = sum(math.floor(1000 * math.log((aim[bucket(f)] + 1) * (s_all + buckets) / ((raw[bucket(f)] + 1) * (t_all + buckets)))) for f in fs)
        h = int(_sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        out.append((i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, able[:percent * len(able) // 100]


def test_resampling_query_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    aim = [r[0] for r in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    want, drawn = _resample(docs, aim)
    rank = {r[0]: k for k, r in enumerate(drawn, 1)}
    got = sorted(tuple(r) for r in queries.queries()["op11_importance_resampling"](spark, SF).collect())
    assert [(*r[:4], rank.get(r[0])) for r in sorted(want)] == got
    assert drawn


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3)])
def test_resampling_odd_rows(spark, make, odd, low, high):
    aim = spark.createDataFrame([("other3 word1 word2",), (None,), ("",)], "text string")
    spec = resampling.Spec(low, high, 50)
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    want, drawn = _resample(docs, [r[0] for r in aim.collect()], 50, low, high, 50, 1, 7)
    got = resampling.resample(odd, aim, percent=50, min_words=1, seed=7, spec=spec).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted((r[:4] for r in want), key=key)
    assert [tuple(r[:4]) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [r[:4] for r in drawn]
    rows = resampling.drawn(odd, aim, percent=50, min_words=1, seed=7, spec=spec)
    assert rows.columns == odd.columns and rows.count() == len(drawn)


def test_resampling_pieces_and_empty_tables(spark, make, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 7)
    reader = resampling.Reader(resampling.Spec(1, 3, 1 << 30))
    text = "ab cd\x00ef  é中9 " * 5 + "x" * 50 + "\nlast-one"
    n, got = reader.read(text)
    words, feats = _features(text, 1, 3)
    assert n == words and sorted(got.tolist()) == sorted(zlib.crc32(f.encode()) % (1 << 30) for f in feats)
    none = make([])
    assert resampling.resample(none, none).count() == 0
    assert resampling.drawn(make([(1, "a b")]), none, min_words=1, percent=100).count() == 1


# --- chat formatting -------------------------------------------------------------------------------------------

MESSAGES = f"conv_id long, turn long, role string, parts array<{chat.PART}>, body string, segment string, found string, n string, start string"
EVIL = ["", "<", "<|", "<\\|", "a<\\\\|turn|>b<|end|>", "<<|says|><|", "\\### Assistant: </turn> ok", "x\n<|image|>", "<|next|>|", "é漢😀<", "\\<|", "<\\"]


def _part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def _messages(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], MESSAGES).repartition(3)


def test_chat_reads_back_every_text_and_part(spark):
    rows, want, loss = [], {}, {}
    for c in range(4):
        for t, e in enumerate(EVIL * 2):
            role = ["user", "assistant", "sys<|tem", "tool\n<"][(t + c) % 4]
            parts = [_part("text", e), _part("image", ref=f"i{t}", width=57, height=28), _part("text", e[::-1])] if t % 3 else [_part("text", e)]
            rows.append((c, t, role, parts))
            want.setdefault(c, []).append((role, [(p[0], p[1]) for p in parts]))
            if role == "assistant":
                loss.setdefault(c, []).append("".join(p[1] or "" for p in parts))
    out = chat.format_conversations(_messages(spark, rows))
    got = out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in got:
        assert [(t["role"], [(p["kind"], p["text"]) for p in t["parts"]]) for t in r["turns"]] == want[r["conv_id"]]
        assert list(r["loss"]) == loss[r["conv_id"]]
        raw = r["formatted"].encode()
        for s in r["loss_spans"]:
            assert r["formatted"][s["start"]:s["start"] + s["length"]] == raw[s["byte_start"]:s["byte_start"] + s["byte_length"]].decode()
        pictures = [(t, 1) for t in range(len(want[r["conv_id"]])) if t % 3]
        assert [(a["at"], a["turn"], a["part"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
            (k, t, p, f"i{t}", 3 * 1 + 2) for k, (t, p) in enumerate(pictures)]
        assert r["formatted"].count("<|image|>") == len(pictures)
        assert r["n_tokens_attached"] == 5 * len(pictures)


def test_chat_kinds_nulls_and_ties(spark):
    parts = [_part("image"), _part("audio", ref="a", seconds=1.5), _part("document", ref="d", pages=3), _part(None, "plain"), _part("poem", "odd"), _part("audio", seconds=-1.0)]
    rows = [(1, 0, "assistant", parts), (1, 0, "assistant", parts), (1, None, None, None), (None, 0, "user", []), (None, 0, None, [_part("text")])]
    got = {r["conv_id"]: r for r in chat.format_conversations(_messages(spark, rows)).collect()}
    one = "<|turn|>assistant<|says|><|image|><|next|><|audio|><|next|><|document|><|next|>plain<|next|>odd<|next|><|audio|><|end|>"
    assert got[1]["formatted"] == one * 2 + "<|turn|><|says|><|end|>"
    assert [a["tokens"] for a in got[1]["attachments"]] == [0, 38, 768, 0] * 2
    assert got[None]["formatted"] == "<|turn|><|says|><|end|><|turn|>user<|says|><|end|>"
    assert got[None]["loss_spans"] == [] and got[None]["attachments"] == []
    assert chat.format_conversations(_messages(spark, [])).count() == 0


def test_chat_query_equals_sql_and_stays_native(spark, capsys):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    df = queries.queries()["op12_chat_parts"](spark, SF)
    want = con.sql(f"select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from ({chat.ORACLE})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    df.explain()
    plan = capsys.readouterr().out
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# --- Merkle manifest -------------------------------------------------------------------------------------------

def _tree(nodes):
    """Levels of nodes from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        d = out[-1]
        out.append([_sha("".join(d[i:i + 2])) for i in range(0, len(d), 2)])
    return out


def _siblings(levels, i):
    out = []
    for d in levels[:-1]:
        out.append((d[i ^ 1] if (i ^ 1) < len(d) else None, i & 1))
        i >>= 1
    return out


def _manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    def leaf(r):
        return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = _tree([trees[g][-1][0] for g in order])
    out = []
    for gi, g in enumerate(order):
        for i, (_, _, lf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = _siblings(trees[g], i) + _siblings(top, gi)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            acc = leaf((r[0], r[1], r[2], r[3] + 1 if hit and r[3] is not None else r[3], r[4]))
            for sib, right in steps:
                acc = _sha(acc if sib is None else sib + acc if right else acc + sib)
            out.append((r[0], lf, trees[g][-1][0], top[-1][0], _sha("".join(s for s, _ in steps if s)), acc, acc == top[-1][0]))
    return out


def _key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def test_merkle_query_equals_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, source, lang, n_chars, text from '{SF}/documents.parquet'").fetchall()
    got = [tuple(r) for r in queries.queries()["op13_merkle_manifest"](spark, SF).collect()]
    assert sorted(got) == sorted(_manifest(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_merkle_rounds_ties_nulls_and_odd_ids(spark, bits):
    ids = [None, None, None, -1, -65536, -(1 << 63), (1 << 63) - 1, 0, 0, 0, 63, 64, 65, 65535, 65536, 65536, *range(100, 119)]
    rows = [(i, None if k % 3 else "s", [None, "", "de", "é"][k % 4] if k < 30 else "lone", None if k % 5 == 0 else k, None if k % 2 else f"t{k // 2}<>") for k, i in enumerate(ids)]
    rows += [(0, "a", "de", 1, "same"), (0, "a", "de", 1, "same"), (7, None, "z", 1, "only one here")]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, idx string, g string, path string")
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    claim = merkle.leaf_digest([F.col(c) if c != "n_chars" else F.col(c) + struck.cast("int") for c in merkle.HASHED])
    m = merkle.Manifest.build(df.repartition(4), carry={"claimed": claim}, block_bits=bits)
    got = merkle.checked(m, F.col("claimed")).select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted((tuple(r) for r in got), key=_key) == sorted(_manifest(rows), key=_key)


def test_merkle_empty_and_single(spark):
    schema = "doc_id long, source string, lang string, n_chars int, text string"
    m = merkle.Manifest.build(spark.createDataFrame([], schema))
    assert m.root() is None and merkle.checked(m).count() == 0
    m = merkle.Manifest.build(spark.createDataFrame([(3, None, None, None, "x" * 300_000)], schema))
    r = merkle.checked(m).first()
    assert r["leaf"] == r["root"] == m.root() and r["verified"] and r["proof_sha256"] == _sha("")


def test_merkle_dense_container(spark):
    rows = spark.range(70_000).filter("id % 11 != 3").select(F.col("id"), F.lit("=a").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    got = merkle.coordinates(rows)
    assert got.count() == rows.count()
    assert got.filter(F.col("idx") != F.col("id") - F.floor((F.col("id") + 7) / 11)).count() == 0
