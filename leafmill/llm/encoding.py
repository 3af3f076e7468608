"""Corpus encoding with a public byte-level BPE vocabulary.

Method: a bounded-lookahead streaming transducer. For the prefix of a piece that ends at each byte there is exactly one last token,
found from the last tokens of earlier prefixes by a test on neighbouring tokens (two tokens may stand side by side if the merge list,
applied to their joint bytes, gives just these two). The links from prefix to prefix form a tree; a token is emitted once all
prefixes that can still matter (those of the last ``lookahead`` bytes) agree on it, so memory doesn't grow with the text. The
lookahead is computed from the merge list: it is the longest token, and a piece also ends early at every byte pair
that no token spans, where no merge can ever reach across. Decoding is a byte-to-text state machine that holds at most three
bytes of an unfinished character.

Defined ids: null and empty texts have the empty list; white space is encoded as it is; special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import spread

#: The public pattern that splits text before the merges (a fixed value of the vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Most pieces whose ids a Python worker keeps; the table starts afresh beyond it.
CACHE_PIECES = 400_000
#: Pieces longer than this many characters aren't kept.
CACHE_LENGTH = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes byte pieces incrementally; see the module's description."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.lookahead = max(map(len, ranks))
        self.joins = bytearray(65536)
        for token in ranks:
            for a, b in zip(token, token[1:]):
                self.joins[a << 8 | b] = 1
        #: Lengths of the tokens that end in a given byte pair, longest first: the only candidates at a position.
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 1:
                lengths.setdefault(token[-2:], set()).add(len(token))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.tokens = {i: t for t, i in ranks.items()}
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one."""
        if token not in self._splits:
            whole = self.tokens[token]
            parts = list(struct.unpack(f"{len(whole)}c", whole))
            found = None
            while len(parts) > 2:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    r = self.ranks.get(parts[i] + parts[i + 1])
                    if r is not None and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                found = self.ranks[parts[0]], self.ranks[parts[1]]
            self._splits[token] = found
        return self._splits[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merge list leaves these two tokens side by side: undo merges from the latest on, and see
        whether any earlier merge would have reached across the border."""
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        a, b, limit, answer = left, right, 1 << 30, True
        while True:
            joint = self.ranks.get(self.tokens[a] + self.tokens[b])
            if joint is not None and joint < limit:
                answer = False
                break
            parts = self.split(a if a > b else b)
            if parts is None:  # single bytes have the lowest ids, so both are
                break
            if a > b:
                limit, a = a, parts[1]
            else:  # of equal merges the left one comes first
                limit, b = b + 1, parts[0]
        if len(self._pairs) > 2_000_000:
            self._pairs.clear()
        self._pairs[key] = answer
        return answer

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Ids of a stream of bytes of one piece, each as soon as it is stable."""
        ranks, window, joins = self.ranks, self.lookahead, self.joins
        buf = bytearray()
        last: list[int] = []  # id of the last token of the prefix that ends after each byte of buf
        for byte in data:
            if buf and not joins[buf[-1] << 8 | byte]:
                yield from self._back(buf, last, len(buf))
                buf.clear()
                last.clear()
            buf.append(byte)
            end = len(buf)
            chosen = -1
            if end > 1:
                for n in self.lengths.get(bytes(buf[-2:]), ()):
                    if n > end:
                        continue
                    token = ranks.get(bytes(buf[end - n :]))
                    if token is not None and (n == end or self.neighbours(last[end - n - 1], token)):
                        chosen = token
                        break
            last.append(chosen if chosen >= 0 else ranks[bytes(buf[-1:])])
            if end >= 4 * window and end % window == 0:
                stable = self._stable(last, end)
                if stable:
                    yield from self._back(buf, last, stable)
                    del buf[:stable]
                    del last[:stable]
        yield from self._back(buf, last, len(buf))

    def _stable(self, last: list[int], end: int) -> int:
        """The furthest border on which all prefixes of the last ``lookahead`` bytes agree."""
        heads = {end - k for k in range(self.lookahead)}
        while len(heads) > 1:
            top = max(heads)
            heads.discard(top)
            heads.add(top - len(self.tokens[last[top - 1]]) if top else 0)
        return heads.pop()

    def _back(self, buf: bytearray, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        out.reverse()
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        return list(self.stream(piece))


class _Pieces(dict):
    """Packed ids by piece, filled by the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.units: dict[bytes, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        t, raw = self.transducer, piece.encode("utf-8", "surrogatepass")
        packed = b""
        if (whole := t.ranks.get(raw)) is not None:
            packed = struct.pack("<i", whole)
        else:
            joins, start, parts, units = t.joins, 0, [], self.units
            for i in range(1, len(raw) + 1):
                if i == len(raw) or not joins[raw[i - 1] << 8 | raw[i]]:
                    unit = raw[start:i]
                    got = units.get(unit)
                    if got is None:
                        ids = t.encode_piece(unit)
                        got = struct.pack(f"<{len(ids)}i", *ids)
                        if len(unit) <= CACHE_LENGTH:
                            if len(units) >= CACHE_PIECES:
                                units.clear()
                            units[unit] = got
                    parts.append(got)
                    start = i
            packed = b"".join(parts)
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Text to packed little-endian int32 ids."""

    def __init__(self, path: str):
        self.transducer = Transducer(load_ranks(path))
        self.pieces = _Pieces(self.transducer)
        self.find = regex.compile(SPLIT).findall

    def packed(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<i4").tolist() if text else []


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_texts(df: DataFrame, id_col: str, text_col: str, vocabulary: str | None = None, out_col: str = "ids") -> DataFrame:
    """(id_col, out_col): the ids of each text. One row per input row; null and empty texts have the empty list."""
    path = vocabulary or default_vocabulary()
    schema = T.StructType([df.schema[id_col], T.StructField(out_col, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            step = 256  # keeps the ids of few texts in memory at once
            for lo in range(0, batch.num_rows, step):
                parts = [enc.packed(t) if t else b"" for t in texts.slice(lo, step).to_pylist()]
                offsets = np.zeros(len(parts) + 1, dtype=np.int32)
                np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, step), lists], names=[id_col, out_col])

    return spread(df.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text_col: str, keep: list[str], vocabulary: str | None = None, out_col: str = "n_tokens") -> DataFrame:
    """The ``keep`` columns and the number of ids of each text (0 for null and empty texts)."""
    path = vocabulary or default_vocabulary()
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out_col, T.LongType(), False)])

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            sizes = [len(enc.packed(t)) // 4 if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(sizes, pa.int64())], names=[*keep, out_col])

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


class Utf8Machine:
    """Incremental byte-to-text decoder: keeps at most three bytes of an unfinished character; a byte that can't belong to
    a character becomes U+FFFD."""

    def __init__(self):
        self.need = self.value = self.size = 0
        self.low, self.high = 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.value = self.value << 6 | b & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.value))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.value = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.value = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.need, self.value = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        rest, self.need = ("�" if self.need else ""), 0
        return rest


def decode_ids(df: DataFrame, id_col: str, ids_col: str, vocabulary: str | None = None, out_col: str = "text") -> DataFrame:
    """(id_col, out_col): the text of each list of ids; null for null lists, ids outside the vocabulary are left out."""
    path = vocabulary or default_vocabulary()
    schema = T.StructType([df.schema[id_col], T.StructField(out_col, T.StringType())])

    def run(batches):
        tokens = encoder(path).transducer.tokens
        plain = {i: t.decode("ascii") for i, t in tokens.items() if max(t) < 0x80}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # keeps the ids of few texts in memory at once
                texts = []
                for ids in batch.column(1).slice(lo, 256).to_pylist():
                    if ids is None:
                        texts.append(None)
                        continue
                    machine, out = Utf8Machine(), []
                    for i in ids:
                        if not machine.need and i in plain:
                            out.append(plain[i])
                        elif i in tokens:
                            out.append(machine.feed(tokens[i]))
                    texts.append("".join(out) + machine.end())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array(texts, pa.string())], names=[id_col, out_col])

    return df.select(id_col, ids_col).mapInArrow(run, schema)
