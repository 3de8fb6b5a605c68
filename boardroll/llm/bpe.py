"""Byte-level BPE: encoding by rounds over padded matrices, and decoding.

A text is cut into pieces by a pattern; pieces are encoded separately. New pieces of a
batch are laid, by length, into padded matrices of byte tokens. In each round every row
merges its leftmost pair of lowest rank, found by a hashed pair lookup; the row is closed
up over the merged place, and rows without a mergeable pair leave the matrix. A task
remembers the pieces it has met, so a frequent word is encoded once.

Defined results: a null text is the empty text and has no tokens; a null id stays null;
repeated rows give repeated rows; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from boardroll.llm.common import map_texts, share

NONE = np.int32(2**31 - 1)
_FREE = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 1 << 21
_MOST_TOKENS = 2_000_000
_KEPT_PIECES = 300_000

# For texts of these characters only, the common pattern of byte-level vocabularies cuts as
# this one does, in which every class is spelled out and the commonest branch comes first.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN_TEXT = re.compile(r"[\x00-\x1b -\x7fÀ-ÖØ-öø-ɏ]*")
_PLAIN_CUT = re.compile(
    rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\t-\r 0-9{_LETTERS}]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_COMMON_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _put(out: list[bytes], rows: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
    """Finished rows, as bytes cut from one buffer."""
    raw, stride = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
    for k, (row, length) in enumerate(zip(rows.tolist(), n.tolist(), strict=True)):
        out[row] = raw[k * stride : k * stride + 4 * length]


class PairTable:
    """Ranks of all pairs of tokens that join into a token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        size = 1 << max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.last = np.int64(size - 1)
        self.keys = np.full(size, _FREE, np.uint64)
        self.ranks = np.full(size, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == _FREE
            _, first = np.unique(slots[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``NONE``; a negative token (padding) joins with nothing."""
        keys = left.astype(np.uint64) << np.uint64(32) | (right.astype(np.uint64) & np.uint64(2**32 - 1))
        out = np.full(keys.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        flat, keys = out.ravel(), keys.ravel()[at]
        slots = self._slots(keys)
        while len(at):
            met = self.keys[slots]
            same = met == keys
            flat[at[same]] = self.ranks[slots[same]]
            on = ~same & (met != _FREE)
            at, keys, slots = at[on], keys[on], (slots[on] + 1) & self.last
        return flat.reshape(out.shape)


class Codec:
    """Encoder and decoder for one vocabulary; small enough to broadcast (checked)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, longest_row: int = 512):
        if len(ranks) > _MOST_TOKENS:
            raise ValueError(f"vocabulary of {len(ranks)} tokens; at most {_MOST_TOKENS}")
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for bytes {missing[:5]}")
        self.ranks, self.pattern, self.longest_row = ranks, pattern, longest_row
        self.pairs = PairTable(ranks)
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(raw) > self.longest_row:
                out[piece] = np.array(self._merge_long(raw), "<u4").tobytes()
            else:
                by_width.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for bits, held in by_width.items():
            rows = max(1, _CELLS >> bits)
            for at in range(0, len(held), rows):
                part = held[at : at + rows]
                for (piece, _), ids in zip(part, self._merge_rows([raw for _, raw in part], 1 << bits), strict=True):
                    out[piece] = ids
        return out

    def _merge_rows(self, raws: list[bytes], width: int) -> list[bytes]:
        n = np.array([len(r) for r in raws])
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(len(raws), width)
        columns = np.arange(width)
        ids = np.where(columns < n[:, None], self.first[flat], np.int32(-1))
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(raws)), [b""] * len(raws)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                _put(out, rows[done], ids[done], n[done])
                on = ~done
                rows, ids, ranks, n, at, best = rows[on], ids[on], ranks[on], n[on], at[on], best[on]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            ids[each, at] = best
            n = n - 1
            width = int(n.max())
            take = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, take + (take > at[:, None]), axis=1)
            take = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, take + (take >= at[:, None]), axis=1)
            if ranks.shape[1] == 0:
                _put(out, rows, ids, n)
                break
            for place in (at - 1, at):  # only the two pairs beside the merged token are new
                ok = (place >= 0) & (place < ranks.shape[1])
                r, p = each[ok], place[ok]
                ranks[r, p] = self.pairs.find(ids[r, p], ids[r, p + 1])
            ids, ranks = ids[:, : max(width, 1)], ranks[:, : max(width - 1, 1)]
        return out

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same merges for one long piece, by a heap over (rank, place): n log n."""
        ids = self.first[np.frombuffer(raw, np.uint8)]
        ranks = self.pairs.find(ids[:-1], ids[1:])
        heap = [(int(r), k) for k, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        tokens = ids.tolist()
        spans: list[bytes | None] = [raw[k : k + 1] for k in range(len(raw))]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
        current = {k: r for r, k in heap}
        while heap:
            rank, k = heapq.heappop(heap)
            if current.get(k) != rank:
                continue
            other = after[k]
            spans[k], spans[other], tokens[k] = spans[k] + spans[other], None, rank
            current.pop(other, None)
            after[k] = after[other]
            if after[k] < len(raw):
                before[after[k]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else len(raw)
                if left < 0:
                    continue
                fresh = self.ranks.get(spans[left] + spans[right]) if right < len(raw) else None
                if fresh is None:
                    current.pop(left, None)
                elif current.get(left) != fresh:
                    current[left] = fresh
                    heapq.heappush(heap, (fresh, left))
        return [t for t, s in zip(tokens, spans, strict=True) if s is not None]

    def encoder(self) -> Callable[[list[str]], list[bytes]]:
        """A function from texts to their ids that remembers pieces between calls."""
        known: dict[str, bytes] = {}
        cut = regex.compile(self.pattern).findall
        plain = _PLAIN_TEXT.fullmatch if self.pattern == _COMMON_PATTERN else lambda text: None

        def encode(texts: list[str]) -> list[bytes]:
            pieces = [_PLAIN_CUT.findall(t) if plain(t) else cut(t) for t in texts]
            fresh = set().union(*pieces) - known.keys()
            if len(known) > _KEPT_PIECES and fresh:
                known.clear()
                fresh = set().union(*pieces)
            known.update(self.encode_pieces(fresh))
            return [b"".join(map(known.__getitem__, p)) for p in pieces]

        return encode

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, in order."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _spread(docs: DataFrame, codec: Codec, fields: list[StructField], row: Callable) -> DataFrame:
    shared = share(docs, codec)

    def work():
        own = shared()
        encode = own.encoder()

        def apply(texts: list[str]) -> list[pa.Array]:
            return row(own, encode(texts))

        return apply

    return map_texts(docs, work, fields)


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """Token ids of every whole text: doc_id, ids (array of int)."""

    def row(_: Codec, encoded: list[bytes]) -> list[pa.Array]:
        return [pa.array([np.frombuffer(x, "<i4") for x in encoded], pa.list_(pa.int32()))]

    return _spread(docs, codec, [StructField("ids", ArrayType(IntegerType()))], row)


def decode(encoded: DataFrame, codec: Codec) -> DataFrame:
    """Bytes of every row of ids: doc_id, decoded (binary); null ids decode to nothing."""
    shared = share(encoded, codec)

    def run(batches):
        own = shared()
        for batch in batches:
            raw = [own.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, codec: Codec) -> DataFrame:
    """Encode every whole text and decode its ids again, returning counts and digests.

    doc_id, n_tokens, ids_sha256 and decoded_sha256 (lowercase hex). Ids and bytes stay
    inside the task; only the digests leave it.
    """

    def row(own: Codec, encoded: list[bytes]) -> list[pa.Array]:
        return [
            pa.array([len(x) // 4 for x in encoded], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in encoded]),
            pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in encoded]),
        ]

    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _spread(docs, codec, fields, row)


