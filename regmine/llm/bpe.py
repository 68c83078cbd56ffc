"""Byte-level BPE encoding and decoding (operator 1).

Encoder.  A pre-token is encoded without replaying merges.  An Aho-Corasick
automaton reports every token that occurs in its bytes, which gives the longest
token starting at each position; a backtracking walk takes the longest token
that is *compatible* with the token before it (BPE would keep both, checked by
undoing merges across the boundary and remembered in a pair table), else the
next shorter prefix token, else steps back.  A position that failed once is
never entered again, so the walk is linear in the length of the pre-token, and
the sequence found is the one BPE's merges give.

Decoder.  All token bytes lie in one blob; an offset table gives each token's
place, so a document is decoded by one gather.

Texts are cut before every space that a non-space follows (a boundary of the
pre-tokenizer in every case), and the ids of each chunk are remembered in a
memo that takes no more entries when full; it never changes a result.

Null and empty texts encode to no ids.  The text of a special token becomes its
id, as the library does by default.  Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa

from regmine.llm.common import texts_of

MEMO_CHUNKS = 800_000        # chunk -> ids entries kept per Python worker
MEMO_PAIRS = 1_000_000       # pair-compatibility entries kept per worker
MEMO_KEY_CHARS = 64          # longer chunks are encoded, not remembered
INT32 = np.dtype("<u4")

_LOADED: dict = {}


def load(path: str) -> "BytePairEncoding":
    """The encoder for a tokenizer file, one per Python process."""
    key = (path, os.path.getmtime(path))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = BytePairEncoding.from_file(path)
    return _LOADED[key]


def _byte_letters() -> dict:
    """Letter -> byte of the byte-level alphabet: printable Latin-1 bytes stand
    for themselves, the others for the letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    table.update({chr(256 + i): b for i, b in enumerate(rest)})
    return table


class BytePairEncoding:
    def __init__(self, tokens: list, merges: list, specials: dict, pattern: str):
        """tokens: bytes per id (merge order = id order); merges: (left id,
        right id, merged id); specials: text -> id."""
        import ahocorasick
        import regex
        self.pattern = regex.compile(pattern)
        self.specials = dict(specials)
        self.special_pattern = (regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") if specials else None)
        n = len(tokens)
        self.halves = [None] * n                # how a token was merged
        self.merged = {}                        # (left, right) -> merged id
        for rank, (a, b, c) in enumerate(merges):
            self.merged[a << 20 | b] = c
            if self.halves[c] is None:
                self.halves[c] = (a, b)
        self.byte_id = [None] * 256
        for i, t in enumerate(tokens):
            if len(t) == 1 and self.halves[i] is None and i not in specials.values():
                self.byte_id[t[0]] = i
        rank_of = {c: r for r, (_, _, c) in enumerate(merges)}
        self.rank = [rank_of.get(i, -1) for i in range(n)]
        self._pairs: dict = {}
        self.lengths = [len(t) for t in tokens]
        self.tokens = tokens
        special_ids = set(specials.values())
        # a token takes part only if its own bytes encode to it: both halves
        # do, and BPE does not cut across them in another way
        ok = [False] * n
        for i in sorted(range(n), key=lambda j: self.rank[j]):
            if i in special_ids:
                continue
            h = self.halves[i]
            ok[i] = h is None or (ok[h[0]] and ok[h[1]] and self._joins(h[0], h[1], i))
        self.word = {t.decode("latin-1"): i for i, t in enumerate(tokens) if ok[i]}
        auto = ahocorasick.Automaton()
        for text, i in self.word.items():
            auto.add_word(text, i)
        auto.make_automaton()
        self.automaton = auto
        self.shorter = [-1] * n                 # longest proper prefix token
        for text, i in self.word.items():
            for k in range(len(text) - 1, 0, -1):
                j = self.word.get(text[:k])
                if j is not None:
                    self.shorter[i] = j
                    break
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.decimal = [str(i).encode() for i in range(n)]
        self._after_space: dict = {}
        self._pre: dict = {}

    @classmethod
    def from_file(cls, path: str) -> "BytePairEncoding":
        """Read a tokenizers JSON file of the byte-level BPE kind."""
        import public_tokenizers
        spec = json.load(open(path, encoding="utf-8"))
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        tokens = [b""] * size
        for text, i in vocab.items():
            tokens[i] = bytes(letters[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        merges = []
        for m in spec["model"]["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        return cls(tokens, merges, special, public_tokenizers.PATTERN)

    # -- pair compatibility ------------------------------------------------
    def _joins(self, left: int, right: int, whole: int) -> bool:
        """True if BPE on the bytes of left+right reaches the merge of the two
        halves: no earlier merge crosses their boundary."""
        return self._no_cross(left, right, self.rank[whole])

    def _no_cross(self, left: int, right: int, before: int) -> bool:
        """No merge of rank < ``before`` joins a suffix token of ``left`` to a
        prefix token of ``right`` while both exist.  The later-made of the two
        boundary tokens is undone step by step; a crossing merge counts if it
        comes before the merge that made the token undone last."""
        rank, halves, merged = self.rank, self.halves, self.merged
        limit = before
        a, b = left, right
        while True:
            c = merged.get(a << 20 | b)
            # the merge must come before anything that would have consumed a or
            # b; at equal rank the leftmost occurrence wins
            if c is not None and rank[c] < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra >= rb:
                # equal ranks: the occurrence on the left merges first, so the
                # one on the right is undone first
                if ra == rb:
                    limit, b = rb + 1, halves[b][0]
                else:
                    limit, a = ra, halves[a][1]
            else:
                limit, b = rb + 1, halves[b][0]

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        got = self._pairs.get(key)
        if got is None:
            got = self._no_cross(a, b, 1 << 60)
            if len(self._pairs) < MEMO_PAIRS:
                self._pairs[key] = got
        return got

    # -- encoding ----------------------------------------------------------
    def encode_bytes(self, text: str) -> list:
        """Ids of one pre-token given as Latin-1 text of its bytes."""
        whole = self.word.get(text)
        if whole is not None:
            return [whole]
        # the automaton's longest matches, one after the other; most pre-tokens
        # end here because every neighbouring pair is compatible
        scan = self.automaton.iter_long
        pairs, out, last, at = self._pairs, [], -1, 0
        for _, token in scan(text):
            if last >= 0:
                ok = pairs.get(last << 20 | token)
                if ok is None:
                    ok = self.compatible(last, token)
                if not ok:
                    break
            out.append(token)
            last = token
            at += self.lengths[token]
        else:
            return out
        return self._backtrack(text, out, at)

    def _backtrack(self, text: str, out: list, pos: int) -> list:
        """Go on from ``out`` (compatible so far, ``pos`` bytes) by trying the
        longest token, then its shorter prefixes, then stepping back."""
        n, scan = len(text), self.automaton.iter_long
        shorter, lengths, compatible = self.shorter, self.lengths, self.compatible
        dead = bytearray(n + 1)
        token = next(scan(text, pos))[1]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = pos + lengths[token]
                if not dead[end] and (last < 0 or compatible(last, token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos = end
                if pos == n:
                    return out
                token = next(scan(text, pos))[1]
            else:                                # nothing fits here: step back
                dead[pos] = 1
                token = out.pop()
                pos -= lengths[token]
                token = shorter[token]

    def _encode_piece(self, text: str) -> bytes:
        """Ids (little-endian uint32 bytes) of text without special tokens."""
        pre, parts = self._pre, []
        for w in self.pattern.findall(text):
            got = pre.get(w)
            if got is None:
                raw = w.encode().decode("latin-1")
                got = np.array(self.encode_bytes(raw), dtype=INT32).tobytes()
                if len(pre) < MEMO_CHUNKS and len(w) <= MEMO_KEY_CHARS:
                    pre[w] = got
            parts.append(got)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def _encode_plain(self, text: str) -> bytes:
        """Cut before spaces that a non-space follows; memo per chunk."""
        chunks = text.split(" ")
        memo = self._after_space
        out = list(map(memo.get, chunks))
        out[0] = None
        if None in out:
            self._fill(chunks, out)
        return b"".join(out)

    def _fill(self, chunks: list, out: list) -> None:
        memo, n, i = self._after_space, len(chunks), 0
        while True:
            try:
                i = out.index(None, i)
            except ValueError:
                return
            # A space is a cut if a non-space follows it: the chunk after it is
            # not empty and does not begin with white space.
            j = i
            while j + 1 < n and (not chunks[j + 1] or chunks[j + 1][0].isspace()):
                j += 1
            k = i
            while k > 0 and (not chunks[k] or chunks[k][0].isspace()):
                k -= 1
            text = " ".join(chunks[k:j + 1])
            ids = self._encode_piece(text if k == 0 else " " + text)
            if k == j and k > 0 and len(memo) < MEMO_CHUNKS and len(text) <= MEMO_KEY_CHARS:
                memo[text] = ids
            out[k:j + 1] = [ids] + [b""] * (j - k)
            i = j + 1

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian uint32 bytes."""
        if not text:
            return b""
        if self.special_pattern is None or not any(s in text for s in self.specials):
            return self._encode_plain(text)
        parts = []
        for p in self.special_pattern.split(text):
            if p in self.specials:
                parts.append(np.array([self.specials[p]], dtype=INT32).tobytes())
            elif p:
                parts.append(self._encode_plain(p))
        return b"".join(parts)

    # -- decoding ----------------------------------------------------------
    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, gathered from the blob through the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        index = np.repeat(start - ends + size, size)
        index += np.arange(ends[-1])
        return self.blob[index].tobytes()

    def decode(self, ids) -> str:
        return self.decode_bytes(np.asarray(ids, dtype=np.int64)).decode("utf-8", "replace")


LONG_TEXT = 1 << 20          # characters; beyond it the linear-time encoder is used


def library_encoder(path: str):
    """text -> ids (uint32 array) by the tiktoken library on the same
    vocabulary, for operators that need ids but are not about encoding; very
    long texts go to the encoder above, whose time is linear in any case."""
    import tiktoken
    own = load(path)
    special = set(own.specials.values())
    lib = tiktoken.Encoding("ids", pat_str=own.pattern.pattern, special_tokens=own.specials,
                            mergeable_ranks={t: i for i, t in enumerate(own.tokens) if i not in special})

    def ids(text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return np.frombuffer(own.encode(text), dtype=INT32)
        return lib.encode_to_numpy(text, allowed_special="all")

    return ids


def encode_documents(docs, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False):
    """Encode and decode every text of ``docs``.

    Returns one row per input row: the id column, ``n_tokens``, ``ids_sha256``
    (decimal ids joined by commas), ``decoded_sha256`` (decoded text, UTF-8)
    and, on request, ``ids`` array<int>.  Null texts count as empty; other
    columns of ``docs`` are not read.  One narrow pass: no shuffle.
    """
    from pyspark.sql import functions as F
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
              + (", ids array<int>" if with_ids else ""))

    def run(batches):
        bpe = load(tokenizer_path)
        dec = bpe.decimal
        for batch in batches:
            n, a, b, kept = [], [], [], []
            for text in texts_of(batch.column(1)):
                ids = np.frombuffer(bpe.encode(text), dtype=INT32)
                n.append(len(ids))
                a.append(hashlib.sha256(b",".join([dec[i] for i in ids.tolist()])).hexdigest())
                back = bpe.decode_bytes(ids).decode("utf-8", "replace").encode()
                b.append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)


def decode_documents(encoded, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids"):
    """Decode an array<int> column back to text: (id, text).  Null ids give an
    empty text; ids outside the vocabulary raise."""
    from pyspark.sql import functions as F
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe = load(tokenizer_path)
        for batch in batches:
            texts = [bpe.decode(v.as_py() or []) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return src.mapInArrow(run, f"doc_id {id_type}, text string")
