"""SentencePiece encoding and decoding of merge-type (BPE) models.

Encoding is exact without replaying the merges of a whole text.  An Aho-Corasick automaton finds the longest piece
at every position; pieces are appended while each adjacent pair is compatible, that is, merging the pair's own
characters again gives exactly the pair; on a conflict the next shorter prefix piece is tried, and a position from
which nothing fits is marked in a bitfield so that it is never tried again.  Unknown characters are spelled in byte
pieces.  Pieces never cross from a character to a space mark, so a text is cut into units (a run of spaces and the
characters up to the next space) that are encoded apart and remembered in a bounded memo of each Python worker.

Defined results: null text counts as empty (begin and end ids only, decodes to ''); other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Units remembered by a worker; the memo is emptied when full (speed only).
MEMO_UNITS = 500_000


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.score = [sp.get_score(i) for i in range(len(self.pieces))]
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.byte_id: dict[int, int] = {}
        self.raw: list[bytes] = []  # what an id adds to the decoded bytes
        self.ids: dict[str, int] = {}
        self.trie = ahocorasick.Automaton()
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i):
                self.raw.append(b"")
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(p.replace(SPACE, " ").encode())
                self.ids[p] = i
                self.trie.add_word(p, (i, len(p)))
        self.trie.make_automaton()
        self.length = [len(p) for p in self.pieces]
        self.is_byte = [i in set(self.byte_id.values()) for i in range(len(self.pieces))]
        chars = "".join(re.escape(p) for p in self.ids if len(p) == 1)
        self._known = re.compile(f"[{chars}]+|[^{chars}]+", re.S)
        self._all_known = re.compile(f"[{chars}]+").fullmatch
        self._chars = {p for p in self.ids if len(p) == 1}
        self._fits: dict[int, bool] = {}
        self._shorter: dict[int, int] = {}
        self._alone: dict[int, bool] = {}
        self._memo = _Memo(self)

    # --- encoding ---

    def merged(self, s: str) -> list[str]:
        """Merging by its definition: join the adjacent pair with the highest score, the leftmost of equals."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Do two adjacent pieces stay as they are when their characters are merged again?"""
        key = a << 20 | b
        ok = self._fits.get(key)
        if ok is None:
            ok = self._fits[key] = self.merged(self.pieces[a] + self.pieces[b]) == [self.pieces[a], self.pieces[b]]
            if len(self._fits) > 2_000_000:
                self._fits.clear()
        return ok

    def alone(self, a: int) -> bool:
        ok = self._alone.get(a)
        if ok is None:
            ok = self._alone[a] = self.merged(self.pieces[a]) == [self.pieces[a]]
        return ok

    def shorter(self, a: int) -> int:
        """The longest piece that is a proper prefix of piece ``a``, or -1."""
        got = self._shorter.get(a)
        if got is None:
            p = self.pieces[a]
            got = self._shorter[a] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
        return got

    def encode_run(self, s: str) -> list[int]:
        """Backtracking over a run of characters that all are pieces."""
        longest = [-1] * (len(s) + 1)
        for end, (i, n) in self.trie.iter(s):
            longest[end - n + 1] = i  # later ends are longer
        length, known, shorter = self.length, self._fits.get, self._shorter.get
        failed = 0  # a bit for every position from which nothing fits
        out: list[int] = []
        pos, tok, last = 0, longest[0], -1
        while tok >= 0:
            while True:
                end = pos + length[tok]
                if not failed >> end & 1:
                    ok = known(last << 20 | tok) if last >= 0 else None
                    if ok is None:
                        ok = self.fits(last, tok) if last >= 0 else self.alone(tok)
                    if ok:
                        out.append(tok)
                        pos, last, tok = end, tok, longest[end]
                        break
                less = shorter(tok)
                tok = self.shorter(tok) if less is None else less
                if tok < 0:
                    failed |= 1 << pos
                    if last < 0:
                        raise ValueError(f"no encoding of {s!r}")
                    tok = out.pop()
                    pos -= length[tok]
                    last = out[-1] if out else -1
                    break
        return out

    def encode_unit(self, s: str) -> list[int]:
        if self._all_known(s):
            return self.encode_run(s)
        out: list[int] = []
        for run in self._known.findall(s):
            if run[0] in self._chars:
                out += self.encode_run(run)
            else:
                out += [self.byte_id[b] for b in run.encode()]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end ids, as little-endian unsigned 32-bit integers."""
        ends = self._memo.ends
        if not text:
            return ends[0] + ends[1]
        if "  " in text or text[0] == " " or SPACE in text or " \n" in text:
            units = re.findall(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*", SPACE + text.replace(" ", SPACE))
        else:  # units keep their words as keys: "\n" and what follows it has no space mark
            units = text.replace("\n", " \n").split(" ")
        return ends[0] + b"".join(map(self._memo.__getitem__, units)) + ends[1]

    # --- decoding ---

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids as the library gives it: control ids vanish, one leading space of the first piece goes, bytes
        that are no UTF-8 become U+FFFD."""
        raw = self.raw
        data = b"".join(map(raw.__getitem__, ids.tolist()))
        lead = next((i for i in ids[:8].tolist() if raw[i]), -1)
        if data[:1] == b" " and lead >= 0 and not self.is_byte[lead] and lead != self.unk:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _replace_bytes(data)


def _replace_bytes(data: bytes) -> str:
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i:i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


class _Memo(dict):
    """Unit -> ids in bytes.  Keys that begin with a space mark or a line break are the unit itself; others are
    words after a single space."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec
        self.ends = tuple(np.array([i], "<u4").tobytes() for i in (codec.bos, codec.eos))

    def __missing__(self, key: str) -> bytes:
        unit = key if key[:1] in (SPACE, "\n") else SPACE + key
        got = _packed(self.codec.encode_unit(unit))
        if len(self) >= MEMO_UNITS:
            self.clear()
        self[key] = got
        return got


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _rows(batches, path, make, names):
    c = codec(path)
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            part = b.slice(lo, 512)
            cols = make(c, part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=names)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text, with begin and end ids."""
    def run(batches):
        def make(c, texts):
            return [pa.array([np.frombuffer(c.encode(t or ""), "<u4").astype(np.int32) for t in texts], pa.list_(pa.int32()))]
        return _rows(batches, path, make, [id_col, "ids"])
    sel = docs.select(id_col, F.col(text_col))
    return sel.mapInArrow(run, f"`{id_col}` {sel.schema[0].dataType.simpleString()}, ids array<int>")


def decoded(ids: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every array of ids; null decodes to ''."""
    def run(batches):
        def make(c, rows):
            return [pa.array([c.decode(np.array(r or [], np.int64)) for r in rows], pa.string())]
        return _rows(batches, path, make, [id_col, "text"])
    sel = ids.select(id_col, F.col(ids_col))
    return sel.mapInArrow(run, f"`{id_col}` {sel.schema[0].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass over the texts."""
    def run(batches):
        def make(c, texts):
            n, a, d = [], [], []
            for t in texts:
                ids = c.encode(t or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                d.append(hashlib.sha256(c.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
        return _rows(batches, path, make, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
    sel = docs.select(id_col, F.col(text_col))
    return sel.mapInArrow(run, f"`{id_col}` {sel.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir):
    from .common import documents
    return round_trip(documents(spark, sf_dir), model_path())
