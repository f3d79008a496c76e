"""SentencePiece encoding and decoding (merge-type models), exact, by backtracking.

A merge-type (BPE) encoding is the only one whose adjacent pieces are all
compatible: merging the text of two neighbours again gives the same two
pieces.  So the text is read from left to right; an Aho-Corasick automaton of
the pieces finds the longest piece at a position, the next shorter ones follow,
a pair of pieces is checked once by merging it again (the answer is kept), and
a bitfield marks the positions from which no encoding goes on, so that each is
left once.

No piece holds a space mark after another character (checked when the model is
read; otherwise the whole text is one chunk), so merges never cross from a word
to the next space mark and each distinct chunk is encoded once per worker.

Cases: a null text is the empty text (only the end id); characters without a
piece become byte pieces; one chunk may be as long as the text; repeated rows
and ids are encoded each for itself; an empty table gives an empty table; other
columns are passed over by ``encode_documents`` and kept by ``with_round_trip``.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, prepared, texts

SPACE = "▁"
#: Chunks (of each half) and pairs remembered by one worker; beyond it the older half is forgotten.
REMEMBERED = 400_000
#: Places of the marks of chunks that came once: a sparing codec remembers only those that come again.
SEEN = 1 << 22


class Codec:
    """Encoder of one model file; ``decode`` is the library's own."""

    def __init__(self, model: str, sparing: bool = False):
        import ahocorasick
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.piece: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
                self.piece[sp.id_to_piece(i)] = i
        self.score = {p: sp.get_score(i) for p, i in self.piece.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_fallback = sp.is_byte(self.byte[0])
        self.text = {i: p for p, i in self.piece.items()}
        whole = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.piece)
        self.chunks = re.compile(r"(?s).+" if whole else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.alphabet = {c for p in self.piece for c in p}
        if not self.alphabet <= self.piece.keys():
            raise ValueError("a piece has a character that is no piece itself")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.piece.items():
            if len(p) == 1 or self.merged(p) == [p]:  # else no text ever merges into it
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        # of each piece its length, and the longest piece that it begins with (-1: none)
        self.size = {i: len(p) for p, i in self.piece.items()}
        self.shorter = {i: next((self.piece[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.automaton), -1)
                        for p, i in self.piece.items()}
        self.pairs: dict[int, bool] = {}
        # ids as four-byte numbers: a tuple of objects and its decimals would be several times as large
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SEEN if sparing else 0)
        self.decimal = [str(i) for i in range(sp.get_piece_size())]

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by plain merging: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        ok = self.pairs.get(a << 32 | b)
        if ok is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            x, y = self.text[a], self.text[b]
            ok = self.pairs[a << 32 | b] = self.merged(x + y) == [x, y]
        return ok

    def known_run(self, s: str) -> list[int]:
        """Pieces of a text all of whose characters are pieces."""
        n = len(s)
        size, shorter, pairs = self.size, self.shorter, self.pairs
        longest = [0] * n
        for end, i in self.automaton.iter(s):
            longest[end - size[i] + 1] = i  # ends ascend, so the longest stays
        out: list[int] = []
        alive = bytearray(b"\x01") * (n + 1)
        pos, last, i = 0, -1, longest[0]
        while True:
            while i >= 0:
                if alive[pos + size[i]]:
                    if last < 0:
                        break
                    ok = pairs.get(last << 32 | i)
                    if self.compatible(last, i) if ok is None else ok:
                        break
                i = shorter[i]
            if i < 0:  # nothing goes on from here: take the last piece back, try a shorter one
                alive[pos] = 0
                i = out.pop()
                pos -= size[i]
                last, i = out[-1] if out else -1, shorter[i]
                continue
            out.append(i)
            pos += size[i]
            if pos == n:
                return out
            last, i = i, longest[pos]

    def chunk(self, s: str) -> list[int]:
        if self.alphabet.issuperset(s):
            return self.known_run(s)
        out: list[int] = []
        run = 0
        for k, c in enumerate(s):
            if c not in self.alphabet:
                if k > run:
                    out += self.known_run(s[run:k])
                out += [self.byte[b] for b in c.encode()] if self.byte_fallback else [self.sp.unk_id()]
                run = k + 1
        return out + (self.known_run(s[run:]) if run < len(s) else [])

    def ids(self, text: str) -> array:
        """Ids with the end id."""
        parts: list[bytes] = []
        known, older, seen = self.known, self.older, self.seen
        for c in self.chunks(self.sp.normalize(text)):
            got = known.get(c)
            if got is None:
                got = older.get(c)
                if got is None:
                    got = array("i", self.chunk(c)).tobytes()
                if seen and not seen[at := hash(c) % SEEN]:
                    seen[at] = 1
                elif len(c) < 64:
                    if len(known) >= REMEMBERED:
                        self.older, self.known = older, known = known, {}
                        self.seen = seen = bytearray(len(seen))
                    known[c] = got
            parts.append(got)
        ids = array("i", b"".join(parts))
        ids.append(self.sp.eos_id())
        return ids

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids with the end id, and the same as decimals joined by one space."""
        ids = self.ids(text).tolist()
        return ids, " ".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


_CODECS: dict[tuple[str, bool], Codec] = {}


def codec(model: str, sparing: bool = False) -> Codec:
    """One codec per worker process and model file."""
    if (model, sparing) not in _CODECS:
        _CODECS[model, sparing] = Codec(model, sparing)
    return _CODECS[model, sparing]


def encode_documents(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text
    (and with ``with_ids`` the ids and the decoded text themselves)."""
    prepared(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches):
        c = codec(model)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                ids, decimals = c.encode(text.decode() if text is not None else "")
                back = c.decode(ids)
                row = (doc_id if doc_id == doc_id else None, len(ids), hashlib.sha256(decimals.encode()).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest())
                rows.append(row + (ids, back) if with_ids else row)
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return texts(docs).mapInPandas(run, schema)


def with_round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with the columns ``n_tokens``, ``token_ids`` (in the place of columns of these
    names) and a text that went through encoding and decoding; a null text stays null."""
    prepared(docs.sparkSession)

    @F.pandas_udf("n_tokens long, token_ids array<int>, text string")
    def trip(text: pd.Series) -> pd.DataFrame:
        c = codec(model, sparing=True)  # the worker holds memory of the stages before, too
        rows = []
        for t in text.tolist():
            ids = c.ids(t or "")
            rows.append((len(ids), np.frombuffer(ids, np.int32), None if t is None else c.decode(ids.tolist())))
        return pd.DataFrame(rows, columns=["n_tokens", "token_ids", "text"])

    got = docs.select(packed(docs), trip("text").alias("trip"))
    kept = [c for c in docs.columns if c not in ("n_tokens", "token_ids")]
    cols = [F.col("trip" if c == "text" else "doc")[c].alias(c) for c in kept]
    return got.select(*cols, F.col("trip")["n_tokens"].alias("n_tokens"), F.col("trip")["token_ids"].alias("token_ids"))
