import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from spanlab.llm import piece_codec, token_files
from spanlab.llm.common import scratch

from .conftest import SF, docs_of

WORD = public_tokenizers.path("word_bpe_49k.json")


def strange(n, seed=1):
    rng = random.Random(seed)
    letters = list("  \n\tabtheing▁.0é漢\U0001f600\x00$")
    for k in range(n):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        yield " " * rng.randint(0, 70) + s + " " * rng.randint(0, 40) if k % 3 == 0 else s


def test_codec_equals_library():
    c, sp = piece_codec.codec(piece_codec.model_path()), sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    for s in [*strange(4000), *(r[1] for r in docs_of()[:60])]:
        ids, want = np.frombuffer(c.encode(s), "<u4"), sp.encode(s, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert c.decode(ids) == sp.decode(want)
    rng = random.Random(3)
    for _ in range(1500):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
        assert c.decode(np.array(ids, np.int64)) == sp.decode(ids)


def test_codec_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    got = {r.doc_id: r for r in piece_codec.query(spark, SF).collect()}
    for i, t, *_ in docs_of():
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_codec_odd_and_empty(odd, make):
    rows = piece_codec.round_trip(odd, piece_codec.model_path()).collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == 2 for r in rows if r.doc_id in (1, 2))
    back = piece_codec.decoded(piece_codec.encoded(odd.filter("doc_id = 8"), piece_codec.model_path()), piece_codec.model_path()).collect()
    assert back[0].text == "é漢😀   \x00"
    assert piece_codec.round_trip(make([]), piece_codec.model_path()).count() == 0


def test_memo_equals_library():
    t, tok = token_files.Tokens(WORD), Tokenizer.from_file(WORD)
    rng = random.Random(2)
    letters = list("aTheéÉσΣßİ.,;!=>?'’_~^ǅ̸́9½ \n\t<|\x1c\x85")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) + rng.choice(["", "", "<|endoftext|> x"]) for _ in range(20000)]
    for ids, s in zip(t.batch(texts), texts):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(s, add_special_tokens=False).ids


def test_memo_equals_library_for_every_letter():
    """Letters that the tokenizer decomposes into letter and mark, or does not know, join the punctuation."""
    import sys

    import regex

    t, tok = token_files.Tokens(WORD), Tokenizer.from_file(WORD)
    letters = [chr(c) for c in range(sys.maxunicode + 1) if regex.match(r"\p{L}", chr(c))]
    texts = [c + p for p in ".,-" for c in letters] + ["\u091c\u095c,", "\u0958\u0915!", "\u05d0\ufb1d.", "\u09dc\u09dd;", "\u1100\u1161."]
    want = tok.encode_batch_fast(texts, add_special_tokens=False)
    bad = [s for ids, s, w in zip(t.batch(texts), texts, want) if np.frombuffer(ids, "<u4").tolist() != w.ids]
    assert not bad, (len(bad), bad[:10])


@pytest.mark.parametrize("bits", [False, True])
def test_plane_file(tmp_path, bits):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 2**32 if k % 5 == 0 else 50_000, n, dtype=np.uint32) for k, n in enumerate([0, 3, 200_000, 1, 65_536, 70_001, 0])]
    w = token_files.PlaneWriter(f"file://{tmp_path}/a.bpz", bits)
    for k, ids in enumerate(docs):
        w.add(None if k == 1 else k, ids.astype("<u4").tobytes())
    w.close()
    r = token_files.PlaneReader(f"file://{tmp_path}/a.bpz")
    assert r.doc_ids.to_pylist() == [0, None, 2, 3, 4, 5, 6]
    flat = np.concatenate(docs)
    assert [d for _, d in r.documents()] == [d.astype("<u4").tobytes() for d in docs]
    for lo, n in ((0, 10), (65_530, 20), (199_990, 100_000), (len(flat) - 5, 5), (7, 0)):
        assert (r.ids(lo, n) == flat[lo:lo + n]).all()


def test_files_query(spark):
    tok, start = Tokenizer.from_file(WORD), 0
    got = {r.doc_id: r for r in token_files.query(spark, SF).collect()}
    for i, t, *_ in docs_of():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_files_odd_and_empty(spark, odd, make):
    m = token_files.write_token_files(odd, WORD, 2, scratch(spark))
    rows = token_files.read_token_files(m).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == [(r.doc_id is not None, r.doc_id or 0) for r in sorted(rows, key=lambda r: r.start)]
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in rows)
    assert token_files.read_token_files(token_files.write_token_files(make([]), WORD, 2, scratch(spark)), digest=True).count() == 0
